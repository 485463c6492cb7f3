"""One linear model per series: autoregression and Fourier regression.

All series are fitted at once. Spark reduces each series to sums of products in one
aggregation; a vectorised helper solves the small systems, one row per series; and
the forecast is built by SQL expressions again.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowcast.functions.calendar import plus
from flowcast.functions.numeric import clip_below, filled

SEASON = 24


def _pairs(names):
    """Upper triangle of the pairs of ``names``, row by row."""
    return [(a, b) for i, a in enumerate(names) for b in names[i:]]


def gram_array(names, where=None):
    """Sums of products over the columns ``names`` as one array, upper triangle.

    One SQL expression: building hundreds of column objects would take longer than
    small fits do.
    """
    sums = [f"{a} * {b}" for a, b in _pairs(names)]
    if where:
        sums = [f"CASE WHEN {where} THEN {product} END" for product in sums]
    return F.expr("array(" + ", ".join(f"sum({product})" for product in sums) + ")")


def gram_sums(df, keys, variables):
    """One row per series: {alias: column} variables to named sums ``a_b`` and ``n``."""
    names = list(variables)
    rows = df.select(*keys, *[c.cast("double").alias(a) for a, c in variables.items()])
    sums = [F.expr(f"sum(`{a}` * `{b}`)").alias(f"{a}_{b}") for a, b in _pairs(names)]
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), *sums)


def ar1_coefficients(grid, keys, ts, y):
    """Slope and intercept of each value on the one before it."""
    order = Window.partitionBy(*keys).orderBy(ts)
    pairs = grid.select(*keys, F.col(y).cast("double").alias("_y"),
                        F.lag(y).over(order).cast("double").alias("_x"))
    return pairs.filter(F.col("_x").isNotNull()).groupBy(*keys).agg(
        F.regr_slope("_y", "_x").alias("slope"),
        F.regr_intercept("_y", "_x").alias("intercept"),
        F.count("*").alias("n"),
    )


def _autoregression_solver(lags, short, seasonal, depth):
    """Pandas UDF: sums of products to the best lag set and its recursion weights."""
    lags, depth = list(lags), int(depth)
    width = len(lags) + 2
    upper = np.triu_indices(width)
    # Candidate lag sets: the first p short lags, alone or with seasonal ones added.
    choices = [
        list(range(1, p + 1)) + [1 + lags.index(s) for s in seasonal[:q]]
        for q in range(len(seasonal) + 1) for p in range(1, short + 1)
    ]
    season = SEASON

    @F.pandas_udf("lag_order int, n_seasonal int, aic double, intercept double, "
                  "coef array<double>, weights array<double>")
    def solve(gram: pd.Series, d: pd.Series, sd: pd.Series, mean: pd.Series,
              level: pd.Series) -> pd.DataFrame:
        import numpy as np
        import pandas as pd

        count = len(gram)
        g = np.zeros((count, width, width))
        for i, sums in enumerate(gram):
            if sums is not None and not any(s is None for s in sums):
                g[i][upper] = np.nan_to_num(np.asarray(sums, dtype=float))
        g = g + np.transpose(np.triu(g, 1), (0, 2, 1))
        n, yy = g[:, 0, 0], g[:, -1, -1]
        best = np.full(count, np.inf)
        picked = np.full(count, -1)
        beta = np.zeros((count, width - 1))
        for c, choice in enumerate(choices):
            at = [0, *choice]
            a, b = g[:, at][:, :, at], g[:, at, -1]
            scale = np.sqrt(np.einsum("ijj->ij", a))
            scale[scale == 0] = 1.0
            a = a / scale[:, :, None] / scale[:, None, :]
            # A singular system, e.g. of a constant series, gets a small ridge.
            singular = ~(np.linalg.cond(a) < 1e12)
            a[singular] += 1e-8 * np.eye(len(at))
            x = np.linalg.solve(a, (b / scale)[:, :, None])[:, :, 0] / scale
            rss = np.maximum(yy - np.einsum("ij,ij->i", x, b), 1e-12 * yy + 1e-12)
            with np.errstate(divide="ignore", invalid="ignore"):
                aic = n * np.log(rss / n) + 2 * (len(at) + 1)
            aic = np.where(n > len(at) + 1, aic, np.inf)
            better = aic < best
            best[better], picked[better] = aic[better], c
            beta[better] = 0.0
            beta[np.ix_(better, at)] = x[better]
        # Lag polynomials of the whole batch, multiplied by the differences of each series' form.
        phi = beta[:, 1:]
        poly = np.zeros((count, depth + 1))
        poly[:, 0] = 1.0
        poly[:, lags] = -phi
        for order, step in ((d, 1), (sd, season)):
            times = order.to_numpy(dtype=float)
            for k in range(int(np.nanmax(times, initial=0.0))):
                rows = times > k
                poly[rows, step:] -= poly[rows, :-step].copy()
        sizes = np.array([[sum(k <= short for k in choice), sum(k > short for k in choice)]
                          for choice in choices])[picked]
        intercept = beta[:, 0] + mean.to_numpy(dtype=float) * (1.0 - phi.sum(axis=1))
        # Too few rows for any lag: the series' mean.
        none = picked < 0
        sizes[none], poly[none], phi[none] = 0, 0.0, 0.0
        intercept[none] = level.to_numpy(dtype=float)[none]
        return pd.DataFrame({
            "lag_order": sizes[:, 0], "n_seasonal": sizes[:, 1], "aic": np.where(none, np.nan, best),
            "intercept": intercept, "coef": list(phi), "weights": list(-poly[:, 1:])})

    return solve


def fit_autoregression(grid, keys, ts, y, short=5, seasonal=()):
    """Autoregression per gap-free series: one row with the fitted model each.

    Lags 1..``short`` plus any of ``seasonal`` (24, 48). Differencing, and seasonal
    differencing if seasonal lags are allowed, is chosen first by the smallest
    variance, then the lag set by AIC; all choices are compared on the same rows.
    ``history`` holds the last values, newest first, as many as the recursion needs.
    """
    keys, seasonal = list(keys), list(seasonal)
    lags = [*range(1, short + 1), *seasonal]
    depth = max(lags) + 1 + (SEASON if seasonal else 0)
    order = Window.partitionBy(*keys).orderBy(ts)
    series = Window.partitionBy(*keys)
    forms = [(d, s) for s in ((0, 1) if seasonal else (0,)) for d in (0, 1)]
    back = sorted({j + d + SEASON * s for j in [0, *lags] for d, s in forms})
    rows = grid.select(*keys, ts, F.col(y).cast("double").alias("_y0"))
    rows = rows.select(
        "*", F.max(ts).over(series).alias("_last"),
        *[F.lag("_y0", k).over(order).alias(f"_y{k}") for k in back if k],
    )
    complete = f"_y{back[-1]} IS NOT NULL"

    def value(j, d, s):
        """SQL of the series at lag j after d plain and s seasonal differencings."""
        def plain(k):
            return f"(_y{k} - _y{k + 1})" if d else f"_y{k}"
        return f"({plain(j)} - {plain(j + SEASON)})" if s else plain(j)

    # Differencing by smallest variance, over the rows that have every lag.
    spread = [F.var_pop(F.expr(f"CASE WHEN {complete} THEN {value(0, d, s)} END")).over(series)
              for d, s in forms]
    rows = rows.select("*", F.array(*[filled(v, 0.0) for v in spread]).alias("_var"))
    rows = rows.selectExpr("*", "array_position(_var, array_min(_var)) - 1 AS _form",
                           f"{complete} AS _ok")

    def chosen(j):
        cases = " ".join(f"WHEN {i} THEN {value(j, d, s)}" for i, (d, s) in enumerate(forms))
        return f"CASE _form {cases} END AS _z{j}"

    rows = rows.select(*keys, ts, "_y0", "_last", "_ok", "_form",
                       *[F.expr(chosen(j)) for j in [*lags, 0]])
    rows = rows.select("*", F.avg(F.expr("CASE WHEN _ok THEN _z0 END")).over(series).alias("_mean"))
    centred = ["1D", *[f"(_z{j} - _mean)" for j in [*lags, 0]]]
    recent = F.when(F.col(ts) > plus("_last", hours=-depth), F.struct(ts, F.col("_y0").alias("v")))
    # At most ``depth`` rows per series are collected.
    fitted = rows.groupBy(*keys).agg(
        F.max(ts).alias("last_ts"),
        gram_array(centred, "_ok").alias("_gram"),
        F.first("_form").alias("_form"),
        F.coalesce(F.first("_mean"), F.lit(0.0)).alias("_mean"),
        F.coalesce(F.avg("_y0"), F.lit(0.0)).alias("_level"),
        F.count_if("_ok").alias("n"),
        F.collect_list(recent).alias("_recent"),
    )
    solve = _autoregression_solver(lags, short, seasonal, depth)
    d = F.get(F.array(*[F.lit(d) for d, _ in forms]), F.col("_form"))
    s = F.get(F.array(*[F.lit(s) for _, s in forms]), F.col("_form"))
    fitted = fitted.withColumns({"d": d, "seasonal_d": s})
    fitted = fitted.withColumn("_m", solve("_gram", "d", "seasonal_d", "_mean", "_level"))
    newest = F.transform(F.reverse(F.array_sort("_recent")), lambda r: r["v"])
    padded = F.concat(newest, F.array_repeat(F.lit(0.0), F.lit(depth) - F.size(newest)))
    return fitted.select(*keys, "last_ts", "n", "d", "seasonal_d", "_m.*", padded.alias("history"))


def forecast_autoregression(fitted, keys, ts, horizon=168, out="predicted"):
    """``horizon`` steps ahead per series, each prediction feeding the next ones."""
    depth = F.size("weights")

    def step(newest_first, _):
        terms = F.zip_with(F.slice(newest_first, 1, depth), F.col("weights"), lambda v, w: v * w)
        total = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
        return F.concat(F.array(F.col("intercept") + total), newest_first)

    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col("history"), step)
    steps = F.reverse(F.slice(path, 1, horizon))
    rows = fitted.select(*keys, "last_ts", F.posexplode(steps).alias("_i", "_p"))
    return rows.select(*keys, plus("last_ts", hours=F.col("_i") + 1).alias(ts),
                       clip_below("_p").alias(out))


DAILY, WEEKLY = 4, 3


def harmonics(week_hour):
    """Daily and weekly sine and cosine terms of the hour of the week (Monday 0 = 0)."""
    terms = []
    for period, place, count in ((24, week_hour % 24, DAILY), (168, week_hour, WEEKLY)):
        for k in range(1, count + 1):
            angle = place * F.lit(2.0 * math.pi * k / period)
            terms += [F.sin(angle), F.cos(angle)]
    return terms


def hour_of_week(ts):
    return F.weekday(ts) * 24 + F.hour(ts)


def _least_squares_solver(width):
    upper = np.triu_indices(width)

    @F.pandas_udf("array<double>")
    def solve(gram: pd.Series) -> pd.Series:
        import numpy as np
        import pandas as pd

        g = np.zeros((len(gram), width, width))
        for i, sums in enumerate(gram):
            g[i][upper] = np.nan_to_num(np.asarray(sums, dtype=float))
        g = g + np.transpose(np.triu(g, 1), (0, 2, 1))
        a, b = g[:, :-1, :-1], g[:, :-1, -1]
        scale = np.sqrt(np.einsum("ijj->ij", a))
        scale[scale == 0] = 1.0
        a = a / scale[:, :, None] / scale[:, None, :]
        singular = ~(np.linalg.cond(a) < 1e12)
        a[singular] += 1e-8 * np.eye(width - 1)
        x = np.linalg.solve(a, (b / scale)[:, :, None])[:, :, 0] / scale
        return pd.Series(list(x))

    return solve


def fit_fourier(grid, keys, ts, y):
    """Additive trend and seasonality per gap-free series, by least squares.

    The harmonics depend on the hour of the week alone. Each series is first reduced to
    its 168 hours of the week with six sums each; the sums of products over all terms
    then cost the same however long the series is. Both steps use one partitioning.
    """
    keys = list(keys)
    order = Window.partitionBy(*keys).orderBy(ts)
    series = Window.partitionBy(*keys)
    rows = grid.select(
        *keys, ts, F.col(y).cast("double").alias("_y"), hour_of_week(ts).alias("_at"),
        (F.row_number().over(order) - 1).alias("_t"), F.count("*").over(series).alias("_n"),
    )
    rows = rows.withColumn("_x", F.col("_t") / F.greatest(F.col("_n") - 1, F.lit(1)))
    hours = rows.groupBy(*keys, "_at").agg(
        F.max(ts).alias("_last"), F.max("_n").alias("_n"), F.expr("CAST(count(*) AS double) AS _c"),
        F.expr("sum(_x) AS _sx"), F.expr("sum(_x * _x) AS _sxx"), F.expr("sum(_y) AS _sy"),
        F.expr("sum(_x * _y) AS _sxy"),
    )
    terms = harmonics(F.col("_at"))
    hours = hours.select("*", *[t.alias(f"_f{i}") for i, t in enumerate(terms)])
    names = ["1D", "x", *[f"_f{i}" for i in range(len(terms))], "y"]
    within = {"": "_c", "x": "_sx", "xx": "_sxx", "y": "_sy", "xy": "_sxy", "yy": "0D"}
    sums = []
    for a, b in _pairs(names):
        kind = "".join(v for v in (a, b) if v in ("x", "y"))
        factors = [v for v in (a, b) if v not in ("x", "y")]
        sums.append("sum(" + " * ".join([within[kind], *factors]) + ")")
    fitted = hours.groupBy(*keys).agg(
        F.max("_last").alias("last_ts"), F.max("_n").alias("n"),
        F.expr("array(" + ", ".join(sums) + ")").alias("_gram"),
    )
    solve = _least_squares_solver(len(names))
    return fitted.select(*keys, "last_ts", "n", solve("_gram").alias("coef"))


def forecast_fourier(fitted, keys, ts, horizon=168, out="predicted"):
    """``horizon`` steps ahead per series: a projection of calendar terms."""
    rows = fitted.select(
        *keys, "n", "coef", "last_ts",
        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_i"),
    ).withColumn(ts, plus("last_ts", hours=F.col("_i")))
    trend = (F.col("n") - 1 + F.col("_i")) / F.greatest(F.col("n") - 1, F.lit(1))
    terms = [F.lit(1.0), trend, *harmonics(hour_of_week(ts))]
    total = sum((F.get("coef", F.lit(i)) * term for i, term in enumerate(terms)), F.lit(0.0))
    return rows.select(*keys, ts, clip_below(total).alias(out))
