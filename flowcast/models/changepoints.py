"""Piecewise linear trend per series: hinges at fixed places, an L1 penalty, coordinate descent on sums of products."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowcast.functions.calendar import plus
from flowcast.functions.numeric import clip_below

RANGE = 0.8


def places(changepoints):
    """Changepoints at equal distances over the first 80 percent of the period, which runs from 0 to 1."""
    return [RANGE * j / (changepoints + 1) for j in range(1, changepoints + 1)]


def _descent(changepoints, penalty, sweeps):
    at = np.array([0.0, *places(changepoints)])

    @F.pandas_udf("array<double>")
    def solve(parts: pd.Series) -> pd.Series:
        import numpy as np
        import pandas as pd

        size, p = len(parts), changepoints + 2
        sums = np.zeros((size, changepoints + 1, 5))     # per segment: n, t, t*t, y, t*y
        for i, rows in enumerate(parts):
            for r in rows:
                sums[i, r["segment"]] = r["c"], r["t"], r["tt"], r["y"], r["ty"]
        behind = sums[:, ::-1].cumsum(axis=1)[:, ::-1]    # from each segment to the last
        g, b = np.zeros((size, p, p)), np.zeros((size, p))
        g[:, 0, 0] = behind[:, 0, 0]
        b[:, 0] = behind[:, 0, 3]
        for j in range(changepoints + 1):                 # hinge j: max(t - at[j], 0); hinge 0 is t itself
            n, t, tt, y, ty = behind[:, j].T
            g[:, 0, j + 1] = g[:, j + 1, 0] = t - at[j] * n
            b[:, j + 1] = ty - at[j] * y
            for k in range(j + 1):
                g[:, j + 1, k + 1] = g[:, k + 1, j + 1] = tt - (at[j] + at[k]) * t + at[j] * at[k] * n
        x = np.zeros((size, p))
        shrink = penalty * behind[:, 0, 0]
        for _ in range(sweeps):
            for j in range(p):
                pull = b[:, j] - (g[:, j] * x).sum(axis=1) + g[:, j, j] * x[:, j]
                if j > 1:
                    pull = np.sign(pull) * np.maximum(np.abs(pull) - shrink, 0)
                x[:, j] = np.divide(pull, g[:, j, j], out=np.zeros(size), where=g[:, j, j] > 1e-12)
        return pd.Series(list(x))

    return solve


def fit_changepoints(grid, keys, ts, y, changepoints=10, penalty=0.001, sweeps=100):
    """One row per gap-free series: ``coef`` holds level, slope, and the change of slope at each of ``places``.

    Changes of slope are penalised by ``penalty`` a row and unit, so most are 0. A series is first reduced to five
    sums for each of its segments; all products of hinges follow from these, whatever its length.
    """
    keys = list(keys)
    order, series = Window.partitionBy(*keys).orderBy(ts), Window.partitionBy(*keys)
    rows = grid.select(*keys, ts, F.col(y).cast("double").alias("_y"), (F.row_number().over(order) - 1).alias("_i"),
                       F.count(F.lit(1)).over(series).alias("_n"))
    rows = rows.withColumn("_t", F.col("_i") / F.greatest(F.col("_n") - 1, F.lit(1)))
    segment = sum((F.when(F.col("_t") >= c, 1).otherwise(0) for c in places(changepoints)), F.lit(0))
    sums = rows.groupBy(*keys, segment.alias("segment")).agg(
        F.max(ts).alias("_last"), F.max("_n").alias("_n"), F.count("_y").cast("double").alias("c"), F.sum("_t").alias("t"),
        F.sum(F.col("_t") * F.col("_t")).alias("tt"), F.sum("_y").alias("y"), F.sum(F.col("_t") * F.col("_y")).alias("ty"))
    fitted = sums.groupBy(*keys).agg(
        F.max("_last").alias("last_ts"), F.max("_n").alias("n"),
        F.collect_list(F.struct("segment", "c", "t", "tt", "y", "ty")).alias("_parts"))
    return fitted.select(*keys, "last_ts", "n", _descent(changepoints, penalty, sweeps)("_parts").alias("coef"))


def forecast_changepoints(fitted, keys, ts, horizon=168, out="predicted"):
    """``horizon`` steps ahead per series along the last slope."""
    rows = fitted.select(*keys, "n", "coef", "last_ts", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_i"))
    t = (F.col("n") - 1 + F.col("_i")) / F.greatest(F.col("n") - 1, F.lit(1))
    size = F.size("coef") - 2
    bends = F.transform(F.slice("coef", F.lit(3), size), lambda c, j: c * (t - F.lit(RANGE) * (j + 1) / (size + 1)))
    value = F.get("coef", F.lit(0)) + F.get("coef", F.lit(1)) * t + F.aggregate(bends, F.lit(0.0), lambda a, x: a + x)
    return rows.select(*keys, plus("last_ts", hours=F.col("_i")).alias(ts), clip_below(value).alias(out))
