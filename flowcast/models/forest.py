"""Random forest over hourly feature rows, with recursive multi-step prediction."""

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from flowcast.functions.calendar import plus
from flowcast.functions.numeric import clip_below
from flowcast.operators.features import FEATURES, LAGS, MEANS
from flowcast.session import shuffle_partitions
from flowcast.sources.staging import scratch_path

# The published model's settings.
TREES, DEPTH, SEED = 100, 10, 42
BINS, MAX_NODES = 128, 4_000_000


def assemble(df, features=FEATURES, out="features"):
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


def fit_forest(train, target, features=FEATURES, trees=TREES, depth=DEPTH, seed=SEED, bins=BINS, bootstrap=True):
    """Forest on all rows of ``train``; every split may use every feature.

    ``bins`` is how many split points a feature is cut to. The forest may have at most ``MAX_NODES`` nodes, so that
    its trees can be sent to the executors.
    """
    if trees * 2 ** (depth + 1) > MAX_NODES:
        raise ValueError(f"{trees} trees of depth {depth} may have more than {MAX_NODES} nodes")
    forest = RandomForestRegressor(
        labelCol=target, featuresCol="features", predictionCol="_raw", numTrees=trees,
        maxDepth=depth, seed=seed, featureSubsetStrategy="all", maxBins=bins, bootstrap=bootstrap,
    )
    return forest.fit(assemble(train.select(*features, target), features))


def predict_forest(model, df, features=FEATURES, out="predicted"):
    """Add the prediction, never below 0."""
    scored = model.transform(assemble(df, features))
    return scored.select(*df.columns, clip_below("_raw").alias(out))


def importance_table(spark, model, features=FEATURES):
    """(feature, importance), one row per feature."""
    rows = [(name, float(v)) for name, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double")


def forest_nodes(spark, model):
    """The fitted trees as flat arrays, at most trees * 2^(depth+1) nodes in all."""
    path = scratch_path(spark, "forest")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", F.col("nodeData.id").alias("id"), F.col("nodeData.prediction").alias("value"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    ).toPandas().sort_values(["treeID", "id"], ignore_index=True)
    root = nodes.groupby("treeID").id.idxmin().to_numpy()
    base = nodes.treeID.map(dict(zip(sorted(nodes.treeID.unique()), root))).to_numpy()
    leaf = (nodes.left < 0).to_numpy()
    if len(nodes) != model.totalNumNodes or len(root) != model.getNumTrees:
        raise RuntimeError("the stored forest is not laid out as expected")
    own = np.arange(len(nodes))
    return {
        "root": root.astype(np.int32),
        "left": np.where(leaf, own, nodes.left.to_numpy() + base).astype(np.int32),
        "right": np.where(leaf, own, nodes.right.to_numpy() + base).astype(np.int32),
        "feature": np.where(leaf, 0, nodes.feature.to_numpy()).astype(np.int32),
        "threshold": np.where(leaf, np.inf, nodes.threshold.fillna(0.0).to_numpy()),
        "value": nodes.value.to_numpy(dtype=float),
        "depth": int(model.getMaxDepth()),
    }


def recent_values(grid, keys, ts, y, depth=168):
    """One row per series: its last ``depth`` values in time order and how many."""
    if keys:
        ends = grid.groupBy(*[F.col(k).alias("_" + k) for k in keys]).agg(F.max(ts).alias("_last"))
        same = [F.col(k).eqNullSafe(F.col("_" + k)) for k in keys]
        rows = grid.join(ends, same).filter(F.col(ts) > plus("_last", hours=-depth))
    else:
        last = grid.agg(F.max(ts)).scalar()
        rows = grid.filter(F.col(ts) > plus(last, hours=-depth))
    # At most ``depth`` rows per series remain to be collected.
    packed = F.array_sort(F.collect_list(F.struct(ts, F.col(y).cast("double").alias("v"))))
    out = rows.groupBy(*keys).agg(F.max(ts).alias("last_ts"), packed.alias("_rows"))
    return out.select(*keys, "last_ts", F.transform("_rows", lambda r: r["v"]).alias("history"))


def _recursion(nodes, horizon, lags, means, columns):
    """mapInPandas function: a batch of series, stepped together in time."""
    memory = max([*lags, *means])

    def run(batches):
        import numpy as np
        import pandas as pd

        trees = nodes.value
        root, depth = trees["root"], trees["depth"]

        def score(x):
            rows = np.arange(len(x))[:, None]
            at = np.broadcast_to(root, (len(x), len(root)))
            for _ in range(depth):
                goes_left = x[rows, trees["feature"][at]] <= trees["threshold"][at]
                at = np.where(goes_left, trees["left"][at], trees["right"][at])
            return np.maximum(trees["value"][at].mean(axis=1), 0.0)

        for batch in batches:
            count = len(batch)
            known = np.array([len(h) for h in batch.history])
            line = np.zeros((count, memory + horizon))
            for i, values in enumerate(batch.history):
                if known[i]:
                    line[i, memory - known[i]:memory] = values
            start = pd.DatetimeIndex(batch.last_ts)
            for i in range(horizon):
                now, pos = start + pd.Timedelta(hours=i + 1), memory + i
                calendar = [now.hour, now.dayofweek, now.dayofyear, now.month, now.year,
                            now.isocalendar().week, now.dayofweek >= 5, now.quarter]
                x = np.empty((count, len(calendar) + len(lags) + len(means)))
                for j, part in enumerate(calendar):
                    x[:, j] = np.asarray(part, dtype=float)
                for j, k in enumerate(lags, len(calendar)):
                    x[:, j] = line[:, pos - k]
                for j, k in enumerate(means, len(calendar) + len(lags)):
                    mean = line[:, pos - k:pos].sum(axis=1) / k
                    x[:, j] = np.where(known + i >= k, mean, 0.0)
                line[:, pos] = score(x[:, columns])
            yield batch.drop(columns=["history"]).assign(path=list(line[:, memory:]))

    return run


def forecast_forest(spark, model, grid, keys, ts, y, horizon=168, out="predicted", nodes=None,
                    features=FEATURES):
    """Recursive forecast: each prediction is the lag of later steps.

    One row per series goes to the workers, which step whole batches of series in
    time together; the trees are broadcast, their size fixed by count and depth.
    ``features`` are those the model was fitted to.
    Rolling means and lags run over actual and predicted values at every step.
    """
    keys = list(keys)
    trees = spark.sparkContext.broadcast(nodes or forest_nodes(spark, model))
    series = recent_values(grid, keys, ts, y, max([*LAGS.values(), *MEANS.values()]))
    # by number: series are small before they are stepped, and must stay spread
    tasks = shuffle_partitions(spark)
    series = series.repartition(tasks, *keys) if keys else series
    columns = [FEATURES.index(name) for name in features]
    run = _recursion(trees, horizon, list(LAGS.values()), list(MEANS.values()), columns)
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in series.schema.fields
             if f.name != "history"]
    paths = series.mapInPandas(run, ", ".join([*types, "path array<double>"]))
    rows = paths.select(*keys, "last_ts", F.posexplode("path").alias("_i", out))
    return rows.select(*keys, plus("last_ts", hours=F.col("_i") + 1).alias(ts), out)
