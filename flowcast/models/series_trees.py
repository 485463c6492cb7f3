"""Regression trees for many series in one job, and direct forecasts without recursion.

Trees grow level by level, as in distributed boosting libraries: every level is one aggregation of
(series, tree, node, feature, bin) sums over all rows of all series at once, and one window that picks each node's best
split. A hot series is pre-aggregated in every task before the shuffle, so it costs no more rows than a small one.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowcast.functions.calendar import plus
from flowcast.operators.windows import by_series
from flowcast.sources.staging import stage

BINS, MAX_DEPTH, RESAMPLES = 32, 12, 10


def _same(keys, left, right):
    return [left[k].eqNullSafe(right["_" + k]) for k in keys]


def feature_bounds(df, keys, features):
    """One row per series: smallest and largest value of each feature as an array of structs."""
    pair = [F.struct(F.min(F.col(f).cast("double")).alias("lo"), F.max(F.col(f).cast("double")).alias("hi")) for f in features]
    return df.groupBy(*[F.col(k).alias("_" + k) for k in keys]).agg(F.array(*pair).alias("_bounds"))


def bin_of(value, bound, bins):
    """Bin of equal width, 0 to ``bins`` - 1; beyond the bounds the outermost, NULL and NaN the first."""
    value = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    width = bound["hi"] - bound["lo"]
    place = F.floor((value - bound["lo"]) * bins / F.when(width > 0, width))
    return F.greatest(F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)), F.lit(0)).cast("int")


def _draws(tree, *parts):
    """How often a row is drawn into a tree: Poisson with mean 1 from a hash of the row, so a lost task draws alike."""
    u = (F.pmod(F.xxhash64(tree, *parts), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    step, total, out = 0.36787944117144233, 0.0, F.lit(0)    # exp(-1), the share that is never drawn
    for k in range(RESAMPLES):
        total += step
        out = out + (u > total).cast("int")
        step /= k + 1
    return out


def _node(depth, cut_at, binned):
    """Number of the node a row is in after ``depth`` levels (children 2n and 2n + 1); it stays in a node without a split.

    A fold over the levels: written out, the expression would grow with the power of the depth.
    """
    def down(node, _):
        cut = cut_at(node)
        return F.when(cut.isNull(), node).otherwise(2 * node + (F.get(binned, cut["feature"]) > cut["bin"]).cast("int"))

    return F.aggregate(F.array_repeat(F.lit(0), depth), F.lit(1), down)


def _binned(df, keys, features, bounds, bins):
    names = [F.col(k) for k in keys]
    cells = [bin_of(F.col(f), F.get("_bounds", F.lit(i)), bins) for i, f in enumerate(features)]
    return df.join(bounds, _same(keys, df, bounds)).withColumn("_bins", F.array(*cells)), names


def _best_splits(hist, keys, least):
    """Each node's split of largest decrease of squared error; ties to the first feature, then the lowest bin."""
    node = [*keys, "_tree", "_node"]
    line = Window.partitionBy(*node, "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*node, "feature")
    sums = hist.select(
        *node, "feature", "bin", F.sum("m").over(line).alias("ml"), F.sum("t").over(line).alias("tl"),
        F.sum("m").over(whole).alias("m"), F.sum("t").over(whole).alias("t"))
    mr, tr = F.col("m") - F.col("ml"), F.col("t") - F.col("tl")
    cuts = sums.filter((F.col("ml") >= least) & (mr >= least)).select(
        *node, "feature", "bin", (F.col("tl") * F.col("tl") / F.col("ml") + tr * tr / mr).alias("gain"),
        (F.col("t") * F.col("t") / F.col("m")).alias("unsplit"))
    cuts = cuts.filter(F.col("gain") > F.col("unsplit"))
    order = Window.partitionBy(*node).orderBy(F.desc("gain"), "feature", "bin")
    return cuts.withColumn("_r", F.row_number().over(order)).filter("_r = 1").select(*node, "feature", "bin")


def fit_trees(df, keys, target, features, depth=2, trees=1, bins=BINS, least=1):
    """A tree ensemble per series: one row per series with ``bounds``, and one per (series, tree, node).

    Returns (bounds, nodes); nodes hold ``feature`` and ``bin`` (NULL in leaves), the number of rows ``m`` and their mean
    ``value``. One tree takes every row once; of several, each draws rows with replacement, by a hash of the row's features
    and target, so repeated rows are drawn together. Rows with a NULL target take no part. ``least`` rows stay on both sides.
    """
    if not keys:
        raise ValueError("give a constant column as key for one ensemble over all rows")
    if not 0 < depth <= MAX_DEPTH:
        raise ValueError(f"depth must be from 1 to {MAX_DEPTH}, is {depth}")
    keys, features = list(keys), list(features)
    y = F.nanvl(F.col(target).cast("double"), F.lit(None).cast("double")).alias("_y")
    rows = df.select(*keys, *features, y).filter("_y IS NOT NULL")
    bounds = stage(feature_bounds(rows, keys, features), "tree-bounds")
    rows, names = _binned(rows, keys, features, bounds, bins)
    if trees > 1:
        rows = rows.withColumn("_tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        rows = rows.withColumn("_w", _draws(F.col("_tree"), "_y", *features)).filter("_w > 0")
    else:
        rows = rows.withColumns({"_tree": F.lit(0), "_w": F.lit(1)})
    # equal cells of a series are one row from here on: later levels read sums, not hours
    cell = rows.groupBy(*names, "_tree", "_bins").agg(
        F.sum(F.col("_w").cast("long")).alias("_m"), F.sum(F.col("_w") * F.col("_y")).alias("_t"))
    cell = stage(cell, "tree-cells")
    levels = []
    for level in range(depth):
        placed = _place(cell, keys, levels, level)
        if level:  # only nodes that were split have rows one level down
            placed = placed.filter(F.col("_node") >= (1 << level))
        hist = placed.select(*keys, "_tree", "_node", "_m", "_t", F.posexplode("_bins").alias("feature", "bin")).groupBy(
            *keys, "_tree", "_node", "feature", "bin").agg(F.sum("_m").alias("m"), F.sum("_t").alias("t"))
        levels.append(stage(_best_splits(hist, keys, least), "tree-level"))
    leaf = _place(cell, keys, levels, depth)
    # every row counts in all nodes on its way down
    way = F.expr(f"transform(sequence(0, {depth}), i -> shiftright(_node, i))")
    nodes = leaf.select(*keys, "_tree", "_m", "_t", F.explode(F.filter(way, lambda n: n > 0)).alias("_node")).groupBy(
        *keys, "_tree", "_node").agg(F.sum("_m").alias("m"), (F.sum("_t") / F.sum("_m")).alias("value"))
    cuts = _union(levels).toDF(*["_" + k for k in keys], "_t2", "_n2", "feature", "bin")
    on = [*_same(keys, nodes, cuts), nodes["_tree"] == cuts["_t2"], nodes["_node"] == cuts["_n2"]]
    found = nodes.join(cuts, on, "left").select(
        *keys, F.col("_tree").alias("tree"), F.col("_node").alias("node"), "feature", "bin", "m", "value")
    return bounds, stage(found, "tree-nodes")


def _union(levels):
    out = levels[0]
    for other in levels[1:]:
        out = out.unionByName(other)
    return out


def _place(cell, keys, levels, depth):
    """The rows with the node they are in; splits travel as one map per (series, tree)."""
    if not levels:
        return cell.withColumn("_node", F.lit(1))
    entry = F.struct("_node", F.struct("feature", "bin"))
    maps = _union(levels).groupBy(*[F.col(k).alias("_" + k) for k in keys], F.col("_tree").alias("_t2")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("_splits"))   # at most 2^depth entries
    on = [*_same(keys, cell, maps), cell["_tree"] == maps["_t2"]]
    joined = cell.join(maps, on, "left").drop("_t2", *["_" + k for k in keys])
    return joined.withColumn("_node", _node(depth, lambda node: F.element_at("_splits", node), F.col("_bins"))).drop("_splits")


def thresholds(bounds, nodes, keys, features, bins=BINS):
    """The nodes with the feature's name and the value at which it is split (below it: left)."""
    keys = list(keys)
    joined = nodes.join(bounds, _same(keys, nodes, bounds))
    bound = F.get("_bounds", F.col("feature"))
    at = bound["lo"] + (F.col("bin") + 1) * (bound["hi"] - bound["lo"]) / bins
    name = F.get(F.array(*[F.lit(f) for f in features]), F.col("feature"))
    return joined.select(*keys, "tree", "node", name.alias("feature"), at.alias("threshold"), "m", "value")


def predict_trees(df, bounds, nodes, keys, features, depth=2, bins=BINS, out="predicted"):
    """Add the mean of the trees' leaves, never below 0; NULL for a series that was not fitted.

    The trees of a series travel as one row, of at most trees * 2^(depth + 1) nodes.
    """
    keys, columns = list(keys), df.columns
    cut = F.when(F.col("feature").isNotNull(), F.struct("feature", "bin"))
    tree = nodes.groupBy(*[F.col(k).alias("_" + k) for k in keys], "tree").agg(
        F.map_from_entries(F.collect_list(F.struct("node", F.struct(cut.alias("cut"), "value")))).alias("_tree"))
    forest = tree.groupBy(*["_" + k for k in keys]).agg(F.collect_list(F.struct("tree", "_tree")).alias("_forest"))
    both = forest.join(bounds.select(*[F.col("_" + k).alias("_b" + k) for k in keys], "_bounds"),
                       [F.col("_" + k).eqNullSafe(F.col("_b" + k)) for k in keys]).drop(*["_b" + k for k in keys])
    cells = [bin_of(F.col(f), F.get("_bounds", F.lit(i)), bins) for i, f in enumerate(features)]
    joined = df.join(both, _same(keys, df, both), "left").withColumn("_bins", F.array(*cells))

    def leaf(entry):
        node = _node(depth, lambda n: F.element_at(entry["_tree"], n)["cut"], F.col("_bins"))
        return F.element_at(entry["_tree"], node)["value"]

    order = F.array_sort("_forest", lambda a, b: a["tree"] - b["tree"])
    total = F.aggregate(F.transform(order, leaf), F.lit(0.0), lambda s, v: s + v)
    mean = F.greatest(total / F.size("_forest"), F.lit(0.0))
    return joined.select(*[df[c] for c in columns], F.when(F.col("_forest").isNotNull(), mean).alias(out))


def horizon_pairs(df, keys, ts, y, horizons, out="target"):
    """(row, horizon) pairs: each row once per horizon with the value that many rows later, NULL beyond the end.

    One window for all horizons and a bounded explode; nothing is joined, and memory is linear in the number of horizons.
    """
    order = by_series(keys, ts)
    ahead = [F.struct(F.lit(h).alias("h"), F.lead(y, h).over(order).cast("double").alias("v")) for h in horizons]
    rows = df.withColumn("_pair", F.array(*ahead))
    return rows.withColumn("_pair", F.explode("_pair")).select(
        *df.columns, F.col("_pair.h").alias("horizon"), F.col("_pair.v").alias(out))


def direct_forecast(df, keys, ts, y, features, horizons, depth=4, trees=1, bins=BINS, least=1, out="predicted"):
    """Forecasts of the given horizons (hours on a gap-free grid) without recursion.

    One ensemble per series is fitted to all (row, horizon) pairs, the horizon and the target's hour and weekday among its
    features, so no prediction is ever fed back. The last row of each series is then scored once per horizon.
    """
    keys, horizons = list(keys), sorted(set(horizons))
    if not horizons or horizons[0] < 1:
        raise ValueError("horizons must be whole numbers from 1")
    pairs = horizon_pairs(df.select(*keys, ts, y, *features), keys, ts, y, horizons, "_target")
    pairs = stage(_at_target(pairs, ts), "pairs")
    used = [*features, "horizon", "target_hour", "target_weekday"]
    bounds, nodes = fit_trees(pairs, keys, "_target", used, depth, trees, bins, least)
    last = pairs.groupBy(*[F.col(k).alias("_" + k) for k in keys]).agg(F.max(ts).alias("_last"))
    ends = pairs.join(last, [*_same(keys, pairs, last), pairs[ts] == last["_last"]]).select(*pairs.columns)
    scored = predict_trees(ends, bounds, nodes, keys, used, depth, bins, out)
    return scored.select(*keys, F.col("_at").alias(ts), "horizon", out)


def _at_target(pairs, ts):
    at = plus(ts, hours=F.col("horizon"))
    rows = pairs.withColumn("_at", at)
    return rows.withColumns({"target_hour": F.hour("_at"), "target_weekday": F.weekday("_at")})
