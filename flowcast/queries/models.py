"""Model fits, forecasts and report tables over ``events``.

The published holdout of 30 days does not fit the supplied 30 days of events; queries
hold out 7.
"""

from pyspark.sql import functions as F

from flowcast.models import arma as am
from flowcast.models import changepoints as cp
from flowcast.models import linear as ln
from flowcast.operators import features as ft
from flowcast.operators import windows as wn
from flowcast.plans import reports as rp
from flowcast.models import forest as fr
from flowcast.models import series_trees as st
from flowcast.operators.metrics import forecast_metrics
from flowcast.operators.splits import holdout_by_days
from flowcast.plans.forecast import compare_models, forecast_job, forecast_rows
from flowcast.queries import fit_sql
from flowcast.queries.registry import registrar
from flowcast.queries.series import BY_TYPE, SERIES, _lag, events, grid, staged_grid
from flowcast.sources.staging import stage

QUERIES, ORACLES, query = registrar()
KEYS = ["event_type"]

PAIRS = f"""WITH {BY_TYPE},
p AS (SELECT event_type, ts_hour, CAST(n AS DOUBLE) AS y, CAST(lag(n) OVER w AS DOUBLE) AS x FROM g {SERIES})"""


@query(f"""WITH {BY_TYPE}, p AS (SELECT event_type, CAST(n AS DOUBLE) AS y, CAST(lag(n, 1) OVER w AS DOUBLE) AS x1,
CAST(lag(n, 24) OVER w AS DOUBLE) AS x24 FROM g {SERIES})
SELECT event_type, count(*) AS n, sum(y * y) AS y_y, sum(y * x1) AS y_x1, sum(y * x24) AS y_x24,
sum(x1 * x1) AS x1_x1, sum(x1 * x24) AS x1_x24, sum(x24 * x24) AS x24_x24
FROM p WHERE x24 IS NOT NULL GROUP BY 1""")
def gram_sums(spark, sf):
    lagged = wn.add_lags(grid(spark, sf), KEYS, "ts_hour", "n", {"x1": 1, "x24": 24})
    rows = lagged.filter(F.col("x24").isNotNull())
    return ln.gram_sums(rows, KEYS, {"y": F.col("n"), "x1": F.col("x1"), "x24": F.col("x24")})


@query(PAIRS + """ SELECT event_type, round(regr_slope(y, x), 9) AS slope,
round(regr_intercept(y, x), 9) AS intercept, count(*) AS n FROM p WHERE x IS NOT NULL GROUP BY 1""")
def ar1_coefficients(spark, sf):
    out = ln.ar1_coefficients(grid(spark, sf), KEYS, "ts_hour", "n")
    return out.withColumns({c: F.round(c, 9) for c in ("slope", "intercept")})


@query(PAIRS.replace("WITH", "WITH RECURSIVE", 1) + """,
f AS (SELECT event_type, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, max(ts_hour) AS last,
  arg_max(y, ts_hour) AS y0 FROM p GROUP BY 1),
r AS (SELECT event_type, 0 AS h, y0 AS y FROM f UNION ALL
  SELECT r.event_type, h + 1, a + b * y FROM r JOIN f USING (event_type) WHERE h < 168)
SELECT event_type, last + to_hours(h) AS ts_hour, round(greatest(y, 0.0), 6) AS predicted
FROM r JOIN f USING (event_type) WHERE h > 0""")
def ar1_forecast(spark, sf):
    """The recursion of the autoregression with one plain lag, checkable in SQL."""
    rows = staged_grid(spark, sf)
    last = rows.groupBy(*KEYS).agg(
        F.max("ts_hour").alias("last_ts"),
        F.array(F.max_by("n", "ts_hour").cast("double")).alias("history"))
    fitted = ln.ar1_coefficients(rows, KEYS, "ts_hour", "n").join(last, KEYS)
    fitted = fitted.withColumn("weights", F.array("slope"))
    out = ln.forecast_autoregression(fitted, KEYS, "ts_hour")
    return out.withColumn("predicted", F.round("predicted", 6))


def _sql(*parts):
    return "WITH RECURSIVE " + ", ".join([BY_TYPE, *parts])


def _rounded(df):
    return df.withColumn("predicted", F.round("predicted", 6))


@query(_sql(fit_sql.autoregression("g"))
       + " SELECT event_type, ts_hour, round(predicted, 6) AS predicted FROM a_out")
def ar_forecast(spark, sf):
    fitted = ln.fit_autoregression(grid(spark, sf), KEYS, "ts_hour", "n")
    return _rounded(ln.forecast_autoregression(fitted, KEYS, "ts_hour"))


@query(_sql(fit_sql.autoregression("g", (24, 48)))
       + " SELECT event_type, ts_hour, round(predicted, 6) AS predicted FROM a_out")
def seasonal_ar_forecast(spark, sf):
    fitted = ln.fit_autoregression(grid(spark, sf), KEYS, "ts_hour", "n", seasonal=(24, 48))
    return _rounded(ln.forecast_autoregression(fitted, KEYS, "ts_hour"))


@query(_sql(fit_sql.fourier("g"))
       + " SELECT event_type, ts_hour, round(predicted, 6) AS predicted FROM f_out")
def fourier_forecast(spark, sf):
    fitted = ln.fit_fourier(grid(spark, sf), KEYS, "ts_hour", "n")
    return _rounded(ln.forecast_fourier(fitted, KEYS, "ts_hour"))


@query(_sql(fit_sql.arma("g")) + " SELECT event_type, ts_hour, round(predicted, 6) AS predicted FROM h_out")
def arma_forecast(spark, sf):
    """Two lags and two moving-average terms, a week ahead."""
    fitted = am.fit_arma(staged_grid(spark, sf), KEYS, "ts_hour", "n")
    return _rounded(am.forecast_arma(fitted, KEYS, "ts_hour"))


@query("WITH " + ", ".join([BY_TYPE, fit_sql.difference_orders("g")])
       + """ SELECT event_type, n, round(strength, 9) AS strength, seasonal_d, round(kpss_0, 9) AS kpss_0,
round(kpss_1, 9) AS kpss_1, d FROM o_out""")
def difference_order(spark, sf):
    """Seasonal strength, KPSS statistics, and the orders of differencing that follow."""
    out = am.difference_orders(staged_grid(spark, sf), KEYS, "ts_hour", "n")
    return out.withColumns({c: F.round(c, 9) for c in ("strength", "kpss_0", "kpss_1")})


@query(_sql(fit_sql.changepoints("g")) + " SELECT event_type, ts_hour, round(predicted, 6) AS predicted FROM c_out")
def changepoint_trend(spark, sf):
    """A week ahead along a trend with penalised changes of slope."""
    fitted = cp.fit_changepoints(grid(spark, sf), KEYS, "ts_hour", "n")
    return _rounded(cp.forecast_changepoints(fitted, KEYS, "ts_hour"))


@query(_sql(fit_sql.autoregression("g", (24, 48)), fit_sql.interval_widths((24, 48))) + """ SELECT o.event_type, ts_hour,
round(predicted, 6) AS predicted, round(greatest(predicted - wide, 0.0), 6) AS lower, round(predicted + wide, 6) AS upper
FROM a_out o JOIN (SELECT event_type, last FROM a_y) l USING (event_type) JOIN a_width v
  ON v.event_type = o.event_type AND ts_hour = last + to_hours(v.h)""")
def forecast_intervals(spark, sf):
    """The seasonal autoregression a week ahead, with 95 percent bounds of each hour."""
    fitted = stage(ln.fit_autoregression(grid(spark, sf), KEYS, "ts_hour", "n", seasonal=(24, 48)), "fitted")
    ahead = ln.forecast_autoregression(fitted, KEYS, "ts_hour")
    out = am.forecast_intervals(fitted, ahead, KEYS, "ts_hour")
    return out.withColumns({c: F.round(c, 6) for c in ("predicted", "lower", "upper")})


COMPARED = _sql("""
o AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts_hour DESC) AS back FROM g),
tr AS (SELECT ts_hour, event_type, n FROM o WHERE back > 168),
te AS (SELECT ts_hour, event_type, CAST(n AS DOUBLE) AS actual FROM o WHERE back <= 168)""",
    fit_sql.autoregression("tr", p="a_"), fit_sql.autoregression("tr", (24, 48), "s_"),
    fit_sql.fourier("tr"), """
u AS (SELECT *, 'autoregression' AS model FROM a_out
  UNION ALL SELECT *, 'seasonal_autoregression' FROM s_out UNION ALL SELECT *, 'fourier' FROM f_out),
x AS (SELECT event_type, ts_hour, actual, predicted, model FROM te JOIN u USING (event_type, ts_hour))""")


@query(COMPARED + " SELECT * REPLACE (round(predicted, 6) AS predicted) FROM x")
def model_comparison(spark, sf):
    return _rounded(compare_models(events(spark, sf), "ts", KEYS))


@query(COMPARED + """ SELECT event_type, model, round(avg(abs(actual - predicted)), 6) AS mae,
round(sqrt(avg((actual - predicted) * (actual - predicted))), 6) AS rmse,
round(100 * avg(CASE WHEN actual <> 0 THEN abs(actual - predicted) / actual END), 6) AS mape,
count(*) AS n, count(*) FILTER (WHERE actual = 0) AS n_zero FROM x GROUP BY 1, 2""")
def model_errors(spark, sf):
    out = rp.model_errors(compare_models(events(spark, sf), "ts", KEYS), KEYS)
    return out.withColumns({c: F.round(c, 6) for c in ("mae", "rmse", "mape")})


def _job(spark, sf, keys=()):
    return forecast_job(events(spark, sf), "ts", keys, holdout_days=7)


@query()
def forest_holdout(spark, sf):
    return _job(spark, sf).metrics


@query()
def forest_importance(spark, sf):
    return rp.top_importances(_job(spark, sf))


@query()
def forest_recursive(spark, sf):
    return rp.first_week(_job(spark, sf, KEYS))


@query()
def forest_hour_pattern(spark, sf):
    return rp.hour_pattern(_job(spark, sf))


def _naive(spark, sf, keys=KEYS, bounds="global"):
    """A forecast whose predictions SQL can repeat: the value 168 hours before."""
    rows = events(spark, sf).withColumn("loc", F.col("user_id") % 10)
    job = forecast_job(rows, "ts", keys, holdout_days=7, bounds=bounds)
    future = ft.future_frame(job.features, keys, "ts_hour")
    ahead = wn.add_lags(ft.extend(job.features.select("ts_hour", *keys, "n"), future), keys,
                        "ts_hour", "n", {"predicted": 168})
    job.forecast = forecast_rows(
        job.part(False), job.part(True).withColumn("predicted", F.col("lag_168h")),
        ahead.filter(F.col("n").isNull()), keys, "ts_hour", "n", "naive")
    return job


NAIVE = f"""WITH {BY_TYPE},
m AS (SELECT max(ts_hour) - INTERVAL 7 DAY AS test_start, max(ts_hour) + INTERVAL 1 HOUR AS forecast_start FROM g),
f AS (SELECT unnest(generate_series(hi + INTERVAL 1 HOUR, hi + INTERVAL 168 HOUR, INTERVAL 1 HOUR)) AS ts_hour,
  event_type, NULL AS n FROM b CROSS JOIN k),
a AS (SELECT *, CAST(lag(n, 168) OVER w AS DOUBLE) AS p FROM (SELECT * FROM g UNION ALL SELECT * FROM f) {SERIES}),
x AS (SELECT event_type, ts_hour, 'naive' AS model, CAST(n AS DOUBLE) AS actual,
  CASE WHEN ts_hour >= test_start THEN CASE WHEN ts_hour < forecast_start THEN coalesce(p, 0.0) ELSE p END END AS predicted,
  CASE WHEN ts_hour < test_start THEN 'train' WHEN ts_hour < forecast_start THEN 'test' ELSE 'future' END AS segment,
  test_start, forecast_start FROM a CROSS JOIN m)
"""


@query(NAIVE + "SELECT * FROM x")
def report_overall(spark, sf):
    return rp.overall(_naive(spark, sf))


@query(NAIVE + """SELECT event_type, ts_hour, model, actual, predicted, segment FROM x
WHERE ts_hour BETWEEN test_start AND forecast_start""")
def report_test_period(spark, sf):
    return rp.test_period(_naive(spark, sf))


@query(NAIVE + """SELECT date_trunc('day', ts_hour) AS day, event_type, segment, coalesce(sum(actual), 0.0) AS actual,
coalesce(sum(predicted), 0.0) AS predicted FROM x GROUP BY 1, 2, 3""")
def report_daily(spark, sf):
    return rp.daily(_naive(spark, sf))


@query(NAIVE + """SELECT event_type, CAST(hour(ts_hour) AS INTEGER) AS hour, actual, predicted FROM x
WHERE date_trunc('day', ts_hour) = date_trunc('day', test_start) + INTERVAL 5 DAY""")
def report_day_pattern(spark, sf):
    return rp.day_pattern(_naive(spark, sf))


@query(NAIVE + """SELECT event_type, ts_hour, predicted FROM x
WHERE ts_hour BETWEEN forecast_start AND forecast_start + INTERVAL 7 DAY""")
def report_first_week(spark, sf):
    return rp.first_week(_naive(spark, sf))


@query(NAIVE + """SELECT event_type, CAST(hour(ts_hour) AS INTEGER) AS hour, avg(actual) AS actual,
avg(coalesce(p, 0.0)) AS predicted FROM (SELECT x.*, a.p FROM x JOIN a USING (event_type, ts_hour))
WHERE segment = 'train' GROUP BY 1, 2""")
def report_hour_pattern(spark, sf):
    result = _naive(spark, sf)
    return rp.hour_pattern(result, result.part(False).withColumn("predicted", F.col("lag_168h")))


@query(NAIVE + """SELECT event_type, model, avg(abs(actual - predicted)) AS mae,
sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
round(100 * avg(CASE WHEN actual <> 0 THEN abs(actual - predicted) / actual END), 9) AS mape, count(*) AS n,
count(*) FILTER (WHERE actual = 0) AS n_zero FROM x WHERE segment = 'test' GROUP BY 1, 2""")
def report_errors(spark, sf):
    rows = _naive(spark, sf).forecast.filter("segment = 'test'")
    return rp.model_errors(rows, KEYS).withColumn("mape", F.round("mape", 9))


OWN = """WITH e AS (SELECT *, user_id % 10 AS loc FROM events),
c AS (SELECT date_trunc('hour', ts) AS ts_hour, event_type, loc, count(*) AS n FROM e GROUP BY 1, 2, 3),
k AS (SELECT event_type, loc, min(ts_hour) AS lo, max(ts_hour) AS hi FROM c GROUP BY 1, 2),
s AS (SELECT event_type, loc, unnest(generate_series(lo, hi + INTERVAL 168 HOUR, INTERVAL 1 HOUR)) AS ts_hour FROM k),
g AS (SELECT s.*, k.hi, CASE WHEN s.ts_hour <= k.hi THEN coalesce(c.n, 0) END AS n
  FROM s JOIN k USING (event_type, loc) LEFT JOIN c USING (ts_hour, event_type, loc)),
a AS (SELECT *, CAST(lag(n, 168) OVER (PARTITION BY event_type, loc ORDER BY ts_hour) AS DOUBLE) AS p FROM g)
"""


@query(OWN + "SELECT event_type, loc, ts_hour, p AS predicted FROM a WHERE ts_hour > hi")
def report_first_week_own_bounds(spark, sf):
    """Every series forecast from where it ends itself."""
    return rp.first_week(_naive(spark, sf, ["event_type", "loc"], "series"))


@query(OWN + """SELECT event_type, loc, ts_hour, 'naive' AS model, CAST(n AS DOUBLE) AS actual,
CASE WHEN ts_hour > hi THEN p ELSE coalesce(p, 0.0) END AS predicted,
CASE WHEN ts_hour > hi THEN 'future' ELSE 'test' END AS segment
FROM a WHERE ts_hour BETWEEN hi - INTERVAL 7 DAY AND hi + INTERVAL 1 HOUR""")
def report_test_period_own_bounds(spark, sf):
    return rp.test_period(_naive(spark, sf, ["event_type", "loc"], "series"))


def _best_split(rows, features):
    """SQL of the one split of least squared error: (feature, threshold, value left, value right)."""
    values = " UNION ALL ".join(
        f"SELECT {i} AS i, '{f}' AS feature, CAST({f} AS DOUBLE) AS v, count(*) AS m, CAST(sum(n) AS DOUBLE) AS t FROM {rows} GROUP BY 3"
        for i, f in enumerate(features))
    return f"""v AS ({values}),
cut AS (SELECT i, feature, (v + lead(v) OVER w) / 2 AS threshold, sum(m) OVER w AS ml, sum(t) OVER w AS tl,
  sum(m) OVER (PARTITION BY i) AS m, sum(t) OVER (PARTITION BY i) AS t FROM v WINDOW w AS (PARTITION BY i ORDER BY v)),
best AS (SELECT feature, threshold, tl / ml AS low, (t - tl) / (m - ml) AS high FROM cut WHERE threshold IS NOT NULL
  ORDER BY tl * tl / ml + (t - tl) * (t - tl) / (m - ml) DESC, i, threshold LIMIT 1)"""


# One tree without resampling and with one split: what SQL can grow as well.
STUMP = {"trees": 1, "depth": 1, "bootstrap": False}
TREE_FEATURES = ["hour", "dayofweek"]
TREE = f"""WITH {BY_TYPE}, x AS (SELECT event_type, ts_hour, n, CAST(hour(ts_hour) AS INTEGER) AS hour,
CAST(isodow(ts_hour) - 1 AS INTEGER) AS dayofweek FROM g), {{split}},
p AS (SELECT x.*, CASE WHEN CASE feature WHEN 'hour' THEN hour ELSE dayofweek END <= threshold THEN low ELSE high END AS predicted
  FROM x CROSS JOIN best)
"""
HELD = "tr AS (SELECT * FROM x WHERE ts_hour < (SELECT max(ts_hour) - INTERVAL 7 DAY FROM x)), "


def _stump(spark, sf, held=False):
    rows = stage(ft.add_calendar(grid(spark, sf), "ts_hour"), "tree")
    tagged = holdout_by_days(rows, "ts_hour", 7)
    train = tagged.filter("segment = 'train'") if held else rows
    return fr.fit_forest(train, "n", TREE_FEATURES, **STUMP), tagged


@query(TREE.format(split=_best_split("x", TREE_FEATURES))
       + "SELECT event_type, ts_hour, n, round(predicted, 9) AS predicted FROM p")
def tree_split(spark, sf):
    """The tree of one split, fitted to and scored on every hour."""
    model, rows = _stump(spark, sf)
    scored = fr.predict_forest(model, rows, TREE_FEATURES)
    return scored.select("event_type", "ts_hour", "n", F.round("predicted", 9).alias("predicted"))


@query(TREE.format(split=HELD + _best_split("tr", TREE_FEATURES)) + """SELECT event_type, round(avg(abs(n - predicted)), 9) AS mae,
round(sqrt(avg((n - predicted) * (n - predicted))), 9) AS rmse, count(*) AS n FROM p
WHERE ts_hour >= (SELECT max(ts_hour) - INTERVAL 7 DAY FROM x) GROUP BY 1""")
def tree_holdout(spark, sf):
    model, rows = _stump(spark, sf, held=True)
    scored = fr.predict_forest(model, rows.filter("segment = 'test'"), TREE_FEATURES)
    out = forecast_metrics(scored, "n", "predicted", KEYS)
    return out.select("event_type", F.round("mae", 9).alias("mae"), F.round("rmse", 9).alias("rmse"), "n")


@query(TREE.format(split=_best_split("x", TREE_FEATURES)) + """SELECT f AS feature, CASE WHEN f = feature THEN 1.0::DOUBLE ELSE 0.0 END
AS importance FROM (VALUES ('hour'), ('dayofweek')) AS z(f) CROSS JOIN best""")
def tree_importance(spark, sf):
    model, _ = _stump(spark, sf)
    return fr.importance_table(spark, model, TREE_FEATURES)


LAGGED = ["hour", "lag_24h"]


@query("WITH RECURSIVE " + BY_TYPE + f""", x AS (SELECT event_type, ts_hour, n, CAST(hour(ts_hour) AS INTEGER) AS hour,
{_lag(24)} AS lag_24h FROM g {SERIES}), {_best_split("x", LAGGED)},
r AS (SELECT event_type, ts_hour, 0 AS day, CAST(n AS DOUBLE) AS y FROM g WHERE ts_hour > (SELECT hi - INTERVAL 24 HOUR FROM b)
  UNION ALL SELECT event_type, ts_hour + INTERVAL 24 HOUR, day + 1,
  CASE WHEN CASE feature WHEN 'hour' THEN hour(ts_hour) ELSE y END <= threshold THEN low ELSE high END
  FROM r CROSS JOIN best WHERE day < 7)
SELECT event_type, ts_hour, round(y, 9) AS predicted FROM r WHERE day > 0""")
def tree_recursive(spark, sf):
    """A week ahead by a tree that may split on the value a day before, predicted values included."""
    rows = stage(ft.add_history(ft.add_calendar(grid(spark, sf), "ts_hour"), KEYS, "ts_hour", "n"), "tree")
    model = fr.fit_forest(rows, "n", LAGGED, **STUMP)
    out = fr.forecast_forest(spark, model, rows, KEYS, "ts_hour", "n", features=LAGGED)
    return out.withColumn("predicted", F.round("predicted", 9))


def _series_trees(rows, features, depth, bins, keep=""):
    """SQL of one tree per type over ``rows`` (event_type, y, features, ``keep``): per level the sums and the best split,
    then ``placed`` (rows with their leaf) and ``nodes``."""
    bounds = ", ".join(f"min({f}) AS lo_{f}, max({f}) AS hi_{f}" for f in features)
    cells = ", ".join(
        f"CAST(greatest(least(coalesce(floor(({f} - lo_{f}) * {bins} / nullif(hi_{f} - lo_{f}, 0)), 0), {bins - 1}), 0) AS INTEGER)"
        for f in features)
    typed = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in features)
    sql = f"""typed AS (SELECT event_type, y, {typed}{keep} FROM {rows}),
bounds AS (SELECT event_type, {bounds} FROM typed WHERE y IS NOT NULL GROUP BY 1),
r0 AS (SELECT typed.*, [{cells}] AS bins, 1 AS node FROM typed JOIN bounds USING (event_type))"""
    feature_ids = list(range(len(features)))
    for level in range(depth):
        sql += f""",
h{level} AS (SELECT event_type, node, feature, bin, count(*) AS m, sum(y) AS t FROM (SELECT event_type, node, y,
  unnest({feature_ids}) AS feature, unnest(bins) AS bin FROM r{level} WHERE y IS NOT NULL AND node >= {1 << level}) GROUP BY ALL),
c{level} AS (SELECT event_type, node, feature, bin, sum(m) OVER w AS ml, sum(t) OVER w AS tl, sum(m) OVER f - sum(m) OVER w AS mr,
  sum(t) OVER f - sum(t) OVER w AS tr, sum(t) OVER f * sum(t) OVER f / sum(m) OVER f AS unsplit FROM h{level}
  WINDOW f AS (PARTITION BY event_type, node, feature), w AS (PARTITION BY event_type, node, feature ORDER BY bin)),
s{level} AS (SELECT event_type, node, feature, bin FROM c{level} WHERE mr >= 1 AND tl * tl / ml + tr * tr / mr > unsplit
  QUALIFY row_number() OVER (PARTITION BY event_type, node ORDER BY tl * tl / ml + tr * tr / mr DESC, feature, bin) = 1),
r{level + 1} AS (SELECT r.* REPLACE (CASE WHEN s.bin IS NULL THEN r.node
  ELSE 2 * r.node + CAST(r.bins[s.feature + 1] > s.bin AS INTEGER) END AS node) FROM r{level} r LEFT JOIN s{level} s USING (event_type, node))"""
    cuts = " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(depth))
    lower = " ".join(f"WHEN {i} THEN lo_{f} + (bin + 1) * (hi_{f} - lo_{f}) / {bins}" for i, f in enumerate(features))
    names = " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(features))
    return sql + f""",
cuts AS ({cuts}),
way AS (SELECT event_type, y, unnest([node >> i FOR i IN range({depth + 1})]) AS node FROM r{depth} WHERE y IS NOT NULL),
sums AS (SELECT event_type, node, count(*) AS m, avg(y) AS value FROM way WHERE node > 0 GROUP BY 1, 2),
nodes AS (SELECT event_type, 0 AS tree, CAST(node AS INTEGER) AS node, CASE feature {names} END AS feature,
  CASE feature {lower} END AS threshold, m, value FROM sums LEFT JOIN cuts USING (event_type, node) JOIN bounds USING (event_type))
"""


GROWN = ["hour", "dayofweek", "lag_24h"]


@query(f"""WITH {BY_TYPE}, x AS (SELECT event_type, CAST(n AS DOUBLE) AS y, hour(ts_hour) AS hour, isodow(ts_hour) - 1 AS dayofweek,
{_lag(24)} AS lag_24h FROM g {SERIES}), {_series_trees("x", GROWN, 2, 32)}
SELECT event_type, tree, node, feature, round(threshold, 9) AS threshold, m, round(value, 9) AS value FROM nodes""")
def tree_per_series(spark, sf):
    """A tree of depth 2 for every type, all grown in one job."""
    rows = stage(ft.add_history(ft.add_calendar(grid(spark, sf), "ts_hour"), KEYS, "ts_hour", "n"), "tree")
    bounds, nodes = st.fit_trees(rows, KEYS, "n", GROWN, depth=2)
    out = st.thresholds(bounds, nodes, KEYS, GROWN)
    return out.withColumns({c: F.round(c, 9) for c in ("threshold", "value")})


HORIZONS = [1, 6, 24, 168]
AHEAD = ["hour", "now", "horizon", "target_hour", "target_weekday"]


@query(f"""WITH {BY_TYPE}, p AS (SELECT event_type, ts_hour, n, h.horizon, ts_hour + to_hours(h.horizon) AS at_ts,
  max(ts_hour) OVER (PARTITION BY event_type) AS last FROM g CROSS JOIN (SELECT unnest({HORIZONS}) AS horizon) h),
x AS (SELECT p.event_type, CAST(f.n AS DOUBLE) AS y, hour(p.ts_hour) AS hour, p.n AS now, p.horizon, hour(p.at_ts) AS target_hour,
  isodow(p.at_ts) - 1 AS target_weekday, p.at_ts, p.ts_hour = p.last AS is_last
  FROM p LEFT JOIN g f ON f.event_type = p.event_type AND f.ts_hour = p.at_ts), {_series_trees("x", AHEAD, 2, 32, ", at_ts, is_last")}
SELECT r2.event_type, r2.at_ts AS ts_hour, CAST(r2.horizon AS INTEGER) AS horizon, round(greatest(value, 0.0), 9) AS predicted
FROM r2 JOIN nodes ON nodes.event_type = r2.event_type AND nodes.node = r2.node WHERE is_last""")
def direct_reduction(spark, sf):
    """Four horizons from one tree per type over (row, horizon) pairs; no prediction is fed back."""
    rows = ft.add_calendar(grid(spark, sf), "ts_hour").withColumn("now", F.col("n"))
    out = st.direct_forecast(rows, KEYS, "ts_hour", "n", ["hour", "now"], HORIZONS, depth=2)
    return out.withColumn("predicted", F.round("predicted", 9))


@query(NAIVE + """SELECT segment, count(*) AS n, min(ts_hour) AS first_ts, max(ts_hour) AS last_ts,
count(DISTINCT event_type) AS series, true AS complete, 1.0::DOUBLE AS importance FROM x GROUP BY 1""")
def forest_shape(spark, sf):
    """What SQL can say of a forest's job: segments, hours and series, no gap in predictions, importances of sum 1."""
    job = forecast_job(events(spark, sf), "ts", KEYS, holdout_days=7, trees=10, depth=5)
    total = job.importance.agg(F.round(F.sum("importance"), 9)).scalar()
    known = F.col("segment").eqNullSafe("train") | F.col("predicted").isNotNull()
    return job.forecast.groupBy("segment").agg(
        F.count("*").alias("n"), F.min("ts_hour").alias("first_ts"), F.max("ts_hour").alias("last_ts"),
        F.countDistinct("event_type").alias("series"), F.every(known).alias("complete")).withColumn("importance", total)


@query("""SELECT 'x' AS event_type, TIMESTAMP '2024-01-01 00:00:00' AS ts_hour, 0.0::DOUBLE AS predicted WHERE false""")
def forecast_of_nothing(spark, sf):
    """The whole job over no events at all."""
    job = forecast_job(events(spark, sf).filter("event_type = 'no such type'"), "ts", KEYS)
    return rp.first_week(job)
