"""Moving-average terms, orders of differencing, and forecast intervals, for all series at once.

Each fit is one or two aggregations to sums of products and a vectorised solve, one row per series.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowcast.functions.calendar import plus
from flowcast.functions.numeric import clip_below
from flowcast.models.linear import SEASON, _least_squares_solver, gram_array

KPSS_LEVEL, STRENGTH = 0.463, 0.64
NORMAL_95 = 1.959963984540054


def same_series(left, right, keys, how="inner"):
    """``left`` with the columns of its series' row in ``right``; a NULL key is a series too."""
    added = [c for c in right.columns if c not in keys]
    if not keys:
        return left.select("*", *[right.select(c).scalar().alias(c) for c in added])
    other = right.select(*[F.col(k).alias("_r_" + k) for k in keys], *added)
    on = [F.col(k).eqNullSafe(F.col("_r_" + k)) for k in keys]
    return left.join(other, on, how).drop(*["_r_" + k for k in keys])


def _fit(rows, keys, terms, target, where, also=()):
    """One row per series: least squares of ``target`` on an intercept and ``terms`` over the rows ``where`` holds."""
    names = ["1D", *terms, target]
    sums = rows.groupBy(*keys).agg(gram_array(names, where).alias("_gram"), F.count_if(F.expr(where)).alias("_rows"), *also)
    coef = _least_squares_solver(len(names))("_gram")
    return sums.withColumn("coef", F.when(F.col("_rows") > len(terms) + 1, coef)).drop("_gram")


def fit_arma(grid, keys, ts, y, p=2, q=2, long=12):
    """Autoregression of order ``p`` with ``q`` moving-average terms per gap-free series, by two least squares passes.

    A long autoregression first gives the shocks; their lags are then regressors beside the lags of the series
    (Hannan-Rissanen). One row per series: ``last_ts``, rows used, ``coef`` (intercept, lags, shocks) and the newest
    values and shocks, newest first. A series too short for it gets its mean and no other term.
    """
    keys = list(keys)
    order = Window.partitionBy(*keys).orderBy(ts)
    deep = max(long, p)
    rows = grid.select(*keys, ts, F.col(y).cast("double").alias("_y"))
    rows = rows.select("*", *[F.lag("_y", k).over(order).alias(f"_y{k}") for k in range(1, deep + 1)])
    lags = [f"_y{k}" for k in range(1, long + 1)]
    first = _fit(rows, keys, lags, "_y", f"_y{deep} IS NOT NULL").select(*keys, F.col("coef").alias("_long"))
    known = " + ".join(["_long[0]", *[f"_long[{k}] * _y{k}" for k in range(1, long + 1)]])
    shocks = same_series(rows, first, keys).withColumn("_e", F.expr(f"CASE WHEN _y{deep} IS NOT NULL THEN _y - ({known}) END"))
    shocks = shocks.select(
        *keys, ts, "_y", "_e", *[f"_y{k}" for k in range(1, p + 1)],
        *[F.lag("_e", j).over(order).alias(f"_e{j}") for j in range(1, q + 1)],
        F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(ts).desc())).alias("_back"))
    terms = [f"_y{k}" for k in range(1, p + 1)] + [f"_e{j}" for j in range(1, q + 1)]
    whole = f"_e{q} IS NOT NULL" if q else "_e IS NOT NULL"
    newest = F.collect_list(F.when(F.col("_back") <= max(p, q, 1), F.struct("_back", "_y", "_e")))
    fitted = _fit(shocks, keys, terms, "_y", whole, [
        F.max(ts).alias("last_ts"), F.avg("_y").alias("_level"), F.array_sort(newest).alias("_newest")])
    plain = F.concat(F.array(F.coalesce("_level", F.lit(0.0))), F.array_repeat(F.lit(0.0), p + q))

    def padded(name, size):
        held = F.transform(F.slice("_newest", 1, size), lambda r: F.coalesce(r[name], F.lit(0.0))) if size else F.array().cast("array<double>")
        return F.concat(held, F.array_repeat(F.lit(0.0), F.lit(size) - F.size(held)))

    return fitted.select(
        *keys, "last_ts", F.col("_rows").alias("n"), F.lit(p).alias("p"), F.lit(q).alias("q"),
        F.coalesce("coef", plain).alias("coef"), padded("_y", p).alias("history"), padded("_e", q).alias("shocks"))


def _recursion(horizon):
    @F.pandas_udf("array<double>")
    def run(coef: pd.Series, history: pd.Series, shocks: pd.Series) -> pd.Series:
        import numpy as np
        import pandas as pd

        c, y, e = (np.array([list(v) for v in s], float) for s in (coef, history, shocks))
        p, q = y.shape[1], e.shape[1]
        out = np.empty((len(c), horizon))
        for h in range(horizon):      # all series of the batch one step on; future shocks are 0
            out[:, h] = c[:, 0] + (c[:, 1:1 + p] * y).sum(axis=1) + (c[:, 1 + p:] * e).sum(axis=1)
            if p:
                y = np.hstack([out[:, h:h + 1], y[:, :-1]])
            if q:
                e = np.hstack([np.zeros((len(c), 1)), e[:, :-1]])
        return pd.Series(list(out))

    return run


def forecast_arma(fitted, keys, ts, horizon=168, out="predicted"):
    """``horizon`` steps ahead per series, constant work a step."""
    steps = _recursion(horizon)("coef", "history", "shocks")
    rows = fitted.select(*keys, "last_ts", F.posexplode(steps).alias("_i", "_p"))
    return rows.select(*keys, plus("last_ts", hours=F.col("_i") + 1).alias(ts), clip_below("_p").alias(out))


def kpss(rows, keys, ts, z, most=12):
    """KPSS statistic of level stationarity per series; NULL values of ``z`` take no part.

    Partial sums of the deviations from the mean, over the long-run variance with Bartlett weights up to lag
    4 * (n / 100) ** (1/4), ``most`` at the utmost. A constant series has no variance and statistic 0.
    """
    series, order = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy(ts)
    rows = rows.where(F.col(z).isNotNull()).select(*keys, ts, (F.col(z) - F.avg(z).over(series)).alias("_d"))
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select(*keys, "_d", F.sum("_d").over(running).alias("_s"),
                       *[F.lag("_d", j).over(order).alias(f"_d{j}") for j in range(1, most + 1)])
    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col("_s") * F.col("_s")).alias("_ss"), F.sum(F.col("_d") * F.col("_d")).alias("_g0"),
        *[F.coalesce(F.sum(F.col("_d") * F.col(f"_d{j}")), F.lit(0.0)).alias(f"_g{j}") for j in range(1, most + 1)])
    lags = F.least(F.lit(most), F.floor(4 * F.pow(F.col("_n") / 100, F.lit(0.25))))
    variance = F.col("_g0")
    for j in range(1, most + 1):
        variance = variance + F.when(lags >= j, 2 * (1 - F.lit(j) / (lags + 1)) * F.col(f"_g{j}")).otherwise(0.0)
    # Divided by n twice: once for the variance, once for the statistic.
    return sums.select(*keys, F.when(variance > 1e-9 * F.col("_n"), F.col("_ss") / (F.col("_n") * variance)).otherwise(0.0).alias("kpss"))


def seasonal_strength(rows, keys, ts, y, season=SEASON):
    """1 - var(rest) / var(rest and season) per series, after a centred moving mean; 0 where nothing varies."""
    series, order = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy(ts)
    half = season // 2
    wide = order.rowsBetween(-half, half)
    ends = (F.lag(y, half).over(order) + F.lead(y, half).over(order)) / 2
    inner = F.sum(y).over(order.rowsBetween(-half + 1, half - 1))
    trend = F.when(F.count(y).over(wide) == season + 1, (inner + ends) / season) if season % 2 == 0 else F.when(
        F.count(y).over(wide) == season, F.avg(y).over(wide))
    rows = rows.select(*keys, (F.col(y) - trend).alias("_r"), ((F.row_number().over(order) - 1) % season).alias("_phase"))
    rows = rows.where(F.col("_r").isNotNull())
    phase = Window.partitionBy(*keys, "_phase")
    rows = rows.select(*keys, "_r", (F.col("_r") - F.avg("_r").over(phase)).alias("_rest"))
    all_, rest = F.var_pop("_r"), F.var_pop("_rest")
    return rows.groupBy(*keys).agg(F.when(all_ > 1e-12, F.greatest(F.lit(0.0), 1 - rest / all_)).otherwise(0.0).alias("strength"))


def difference_orders(grid, keys, ts, y, season=SEASON, most_lags=12):
    """How often to difference each gap-free series: one row with its seasonal strength, statistics, ``seasonal_d`` and ``d``.

    A series of strength above 0.64 is differenced over the season once. What remains is differenced until the KPSS
    statistic no longer rejects a constant level at 5 percent, twice at the utmost.
    """
    keys = list(keys)
    order = Window.partitionBy(*keys).orderBy(ts)
    rows = grid.select(*keys, ts, F.col(y).cast("double").alias("_y"))
    every = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    strong = seasonal_strength(rows, keys, ts, "_y", season)
    out = _beside(every, strong, keys, "strength").withColumn("seasonal_d", (F.col("strength") > STRENGTH).cast("int"))
    rows = same_series(rows, out.select(*keys, "seasonal_d"), keys)
    plain = F.col("_y") - F.when(F.col("seasonal_d") == 1, F.lag("_y", season).over(order)).otherwise(0.0)
    rows = rows.withColumn("_z0", plain)
    rows = rows.withColumn("_z1", F.col("_z0") - F.lag("_z0", 1).over(order))
    for d in (0, 1):
        test = kpss(rows, keys, ts, f"_z{d}", most_lags).withColumnRenamed("kpss", f"kpss_{d}")
        out = _beside(out, test, keys, f"kpss_{d}")
    d = F.when(F.col("kpss_0") <= KPSS_LEVEL, 0).when(F.col("kpss_1") <= KPSS_LEVEL, 1).otherwise(2)
    return out.withColumn("d", d)


def _beside(left, right, keys, name):
    """A column of ``right`` beside ``left``, 0 where the series has none."""
    return same_series(left, right, keys, "left").withColumn(name, F.coalesce(name, F.lit(0.0)))


def _psi(horizon):
    @F.pandas_udf("array<double>")
    def run(weights: pd.Series) -> pd.Series:
        import numpy as np
        import pandas as pd

        w = np.array([list(v) for v in weights], float)
        psi = np.zeros((len(w), horizon))
        psi[:, 0] = 1.0
        for h in range(1, horizon):
            back = min(h, w.shape[1])
            psi[:, h] = (w[:, :back] * psi[:, h - back:h][:, ::-1]).sum(axis=1)
        return pd.Series(list(np.sqrt(np.cumsum(psi * psi, axis=1))))

    return run


def forecast_intervals(fitted, forecast, keys, ts, horizon=168, quantile=NORMAL_95, out="predicted"):
    """A forecast of ``fit_autoregression``'s models with the bounds ``lower`` and ``upper`` of each step.

    The error of step h has the variance sigma2 * (psi_0 ** 2 + ... + psi_{h-1} ** 2); the psi weights follow from the lag
    polynomial by recursion, differencing included, and sigma2 is the fit's mean squared residual.
    """
    terms = F.col("lag_order") + F.col("n_seasonal") + 2
    sigma = F.sqrt(F.exp((F.col("aic") - 2 * terms) / F.col("n")))
    spread = fitted.select(*keys, "last_ts", sigma.alias("_sigma"), F.posexplode(_psi(horizon)("weights")).alias("_i", "_psi"))
    spread = spread.select(*[F.col(k).alias("_r_" + k) for k in keys], plus("last_ts", hours=F.col("_i") + 1).alias("_ts"),
                           (F.lit(quantile) * F.col("_sigma") * F.col("_psi")).alias("_wide"))
    on = [F.col(k).eqNullSafe(F.col("_r_" + k)) for k in keys] + [F.col(ts) == F.col("_ts")]
    return forecast.join(spread, on).select(
        *forecast.columns, clip_below(F.col(out) - F.col("_wide")).alias("lower"), (F.col(out) + F.col("_wide")).alias("upper"))
