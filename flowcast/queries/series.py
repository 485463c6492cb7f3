"""Counts, grids, features, splits, metrics and profiles over ``events``.

Movement time is ``ts``, type is ``event_type``, location ``'loc_' || user_id % 10``.
"""

from pyspark.sql import functions as F

from flowcast.functions.calendar import date_text, day_bucket, hour_bucket, is_weekend, plus
from flowcast.functions.numeric import by_case
from flowcast.operators import features as ft
from flowcast.operators import hourly as hr
from flowcast.operators import profile as pf
from flowcast.operators import splits as sp
from flowcast.operators import windows as wn
from flowcast.operators.dimensions import position_in, with_dimension_id
from flowcast.operators.metrics import forecast_metrics
from flowcast.queries.registry import registrar
from flowcast.sources.readers import read_table
from flowcast.sources.staging import stage

QUERIES, ORACLES, query = registrar()

TYPES = ["click", "error", "purchase", "signup", "view"]
# Weekend factors by position of the type.
WEEKEND = dict(zip(TYPES, ["0.9", "0.95", "0.8", "0.9", "0.7"]))

BY_TYPE = """
c AS (SELECT date_trunc('hour', ts) AS ts_hour, event_type, count(*) AS n
      FROM events GROUP BY 1, 2),
b AS (SELECT min(ts_hour) AS lo, max(ts_hour) AS hi FROM c),
s AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts_hour FROM b),
k AS (SELECT DISTINCT event_type FROM c),
g AS (SELECT s.ts_hour, k.event_type, coalesce(c.n, 0) AS n
      FROM s CROSS JOIN k LEFT JOIN c USING (ts_hour, event_type))
"""
CALENDAR = """
CAST(hour(ts_hour) AS INTEGER) AS hour, CAST(isodow(ts_hour) - 1 AS INTEGER) AS dayofweek,
CAST(dayofyear(ts_hour) AS INTEGER) AS dayofyear, CAST(month(ts_hour) AS INTEGER) AS month,
CAST(year(ts_hour) AS INTEGER) AS year, CAST(week(ts_hour) AS INTEGER) AS weekofyear,
CAST(isodow(ts_hour) >= 6 AS INTEGER) AS is_weekend, CAST(quarter(ts_hour) AS INTEGER) AS quarter
"""


def _lag(k, fill=True):
    value = f"CAST(lag(n, {k}) OVER w AS DOUBLE)"
    return f"coalesce({value}, 0.0)" if fill else value


def _mean(k, fill=True):
    frame = f"OVER (PARTITION BY event_type ORDER BY ts_hour ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
    value = f"CASE WHEN count(n) {frame} = {k} THEN avg(n) {frame} END"
    return f"coalesce({value}, 0.0)" if fill else value


HISTORY = f"""
{_lag(1)} AS lag_1h, {_lag(24)} AS lag_24h, {_lag(168)} AS lag_168h,
{_mean(24)} AS rolling_24h_mean, {_mean(168)} AS rolling_7d_mean
"""
SERIES = "WINDOW w AS (PARTITION BY event_type ORDER BY ts_hour)"


def events(spark, sf):
    return read_table(spark, sf, "events")


def grid(spark, sf):
    return hr.hourly_grid(events(spark, sf), "ts", ["event_type"])


def staged_grid(spark, sf):
    """The grid for queries that use it more than once, so events are scanned once."""
    return stage(grid(spark, sf), "grid")


@query("""SELECT date_trunc('hour', ts) AS ts_hour, event_type, count(*) AS n
FROM events GROUP BY 1, 2""")
def hourly_counts(spark, sf):
    return hr.hourly_counts(events(spark, sf), "ts", ["event_type"])


@query("""SELECT date_trunc('hour', ts) AS ts_hour, event_type,
'loc_' || CAST(user_id % 10 AS VARCHAR) AS location, count(*) AS n FROM events GROUP BY 1, 2, 3""")
def hourly_counts_by_location(spark, sf):
    located = events(spark, sf).withColumn(
        "location", F.concat(F.lit("loc_"), (F.col("user_id") % 10).cast("string")))
    return hr.hourly_counts(located, "ts", ["event_type", "location"])


@query("SELECT date_trunc('hour', ts) AS ts_hour, " + ", ".join(
    f"count(*) FILTER (WHERE event_type = '{t}') AS {t}" for t in TYPES)
    + ", count(*) AS total FROM events GROUP BY 1")
def hourly_pivot(spark, sf):
    return hr.hourly_pivot(events(spark, sf), "ts", "event_type", TYPES)


@query("SELECT date_trunc('hour', ts) AS ts_hour, event_type, " + ", ".join(
    f"count(*) FILTER (WHERE user_id % 10 = {i}) AS loc_{i}" for i in range(10))
    + ", count(*) AS total FROM events GROUP BY 1, 2")
def hourly_location_pivot(spark, sf):
    located = events(spark, sf).withColumn(
        "location", F.concat(F.lit("loc_"), (F.col("user_id") % 10).cast("string")))
    places = [f"loc_{i}" for i in range(10)]
    return hr.hourly_pivot(located, "ts", "location", places, ["event_type"])


@query("""WITH c AS (SELECT date_trunc('hour', ts) AS ts_hour, event_type, count(*) AS n FROM events
WHERE event_type = 'click' GROUP BY 1, 2),
s AS (SELECT unnest(generate_series(min(ts_hour), max(ts_hour), INTERVAL 1 HOUR)) AS ts_hour FROM c)
SELECT ts_hour, 'click' AS event_type, coalesce(n, 0) AS n FROM s LEFT JOIN c USING (ts_hour)""")
def one_series(spark, sf):
    """One series alone; the filter on its key reaches the scan."""
    rows = events(spark, sf).filter(F.col("event_type") == "click")
    return hr.hourly_grid(rows, "ts", ["event_type"])


@query("""WITH c AS (SELECT date_trunc('hour', ts) AS ts_hour, count(*) AS n FROM events GROUP BY 1),
s AS (SELECT unnest(generate_series(min(ts_hour), max(ts_hour), INTERVAL 1 HOUR)) AS ts_hour FROM c)
SELECT ts_hour, coalesce(n, 0) AS n FROM s LEFT JOIN c USING (ts_hour)""")
def hourly_total_grid(spark, sf):
    return hr.hourly_grid(events(spark, sf), "ts")


@query(f"WITH {BY_TYPE} SELECT * FROM g")
def hourly_grid_by_type(spark, sf):
    return grid(spark, sf)


@query("""WITH e AS (SELECT *, user_id % 10 AS loc FROM events),
c AS (SELECT date_trunc('hour', ts) AS ts_hour, event_type, loc, count(*) AS n FROM e GROUP BY 1, 2, 3),
k AS (SELECT event_type, loc, min(ts_hour) AS lo, max(ts_hour) AS hi FROM c GROUP BY 1, 2),
s AS (SELECT event_type, loc, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts_hour FROM k)
SELECT ts_hour, event_type, loc, coalesce(n, 0) AS n FROM s LEFT JOIN c USING (ts_hour, event_type, loc)""")
def hourly_grid_own_bounds(spark, sf):
    located = events(spark, sf).withColumn("loc", F.col("user_id") % 10)
    return hr.hourly_grid(located, "ts", ["event_type", "loc"], bounds="series")


@query(f"""WITH {BY_TYPE}, t AS (SELECT DISTINCT ts_hour FROM c) SELECT ts_hour, {CALENDAR},
strftime(ts_hour, '%Y-%m-%d') AS day_text FROM t""")
def calendar_features(spark, sf):
    hours = hr.hourly_counts(events(spark, sf), "ts").select("ts_hour")
    return ft.add_calendar(hours, "ts_hour").withColumn("day_text", date_text("ts_hour"))


@query(f"""WITH {BY_TYPE} SELECT ts_hour, event_type, n, {_lag(1, False)} AS lag_1h,
{_lag(24, False)} AS lag_24h, {_lag(168, False)} AS lag_168h FROM g {SERIES}""")
def lag_features(spark, sf):
    return wn.add_lags(grid(spark, sf), ["event_type"], "ts_hour", "n", ft.LAGS)


@query(f"""WITH {BY_TYPE} SELECT ts_hour, event_type, n, {_mean(24, False)} AS rolling_24h_mean,
{_mean(168, False)} AS rolling_7d_mean FROM g""")
def rolling_features(spark, sf):
    return wn.add_trailing_means(grid(spark, sf), ["event_type"], "ts_hour", "n", ft.MEANS)


@query(f"WITH {BY_TYPE} SELECT ts_hour, event_type, n, {HISTORY}, {CALENDAR} FROM g {SERIES}")
def hourly_features(spark, sf):
    return ft.hourly_features(events(spark, sf), "ts", ["event_type"])


@query(f"""WITH {BY_TYPE}, f AS (SELECT ts_hour, event_type, n, {HISTORY}, {CALENDAR},
row_number() OVER w AS rn FROM g {SERIES}) SELECT * EXCLUDE (rn) FROM f WHERE rn > 168""")
def hourly_features_dropped_warmup(spark, sf):
    return ft.hourly_features(events(spark, sf), "ts", ["event_type"], warmup="drop")


@query(f"""WITH {BY_TYPE} SELECT ts_hour, event_type, n,
lag(n, 24) OVER (ORDER BY ts_hour, event_type) AS lag_24_rows FROM c""")
def row_lag_interleaved(spark, sf):
    counts = hr.hourly_counts(events(spark, sf), "ts", ["event_type"])
    return wn.add_history_in_table_order(
        counts, ["ts_hour", "event_type"], "n", {"lag_24_rows": 24})


@query(f"""WITH {BY_TYPE} SELECT ts_hour, event_type, n, lag(n, 1) OVER w AS lag_1h, lag(n, 24) OVER w AS lag_24h,
lag(n, 168) OVER w AS lag_168h,
CASE WHEN count(*) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) = 24
  THEN avg(n) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) END AS rolling_24h_mean,
CASE WHEN count(*) OVER (w ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) = 168
  THEN avg(n) OVER (w ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) END AS rolling_7d_mean
FROM c WINDOW w AS (ORDER BY ts_hour, event_type)""")
def row_features_interleaved(spark, sf):
    counts = hr.hourly_counts(events(spark, sf), "ts", ["event_type"])
    return wn.add_history_in_table_order(
        counts, ["ts_hour", "event_type"], "n", ft.LAGS, ft.MEANS)


@query(f"""WITH {BY_TYPE}, f AS (SELECT ts_hour, event_type, n, {_lag(24, False)} AS p FROM g {SERIES})
SELECT date_trunc('day', ts_hour) AS day, event_type, CAST(sum(n) AS BIGINT) AS n,
coalesce(sum(p), 0.0) AS predicted FROM f GROUP BY 1, 2""")
def daily_resample(spark, sf):
    lagged = wn.add_lags(grid(spark, sf), ["event_type"], "ts_hour", "n", {"predicted": 24})
    daily = hr.daily_sums(lagged, "ts_hour", ["n", "predicted"], ["event_type"])
    return daily.select("day", "event_type", "n", F.col("predicted").cast("double"))


@query("""WITH c AS (SELECT date_trunc('day', o_orderdate) AS day, o_orderpriority, o_orderstatus,
CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1, 2, 3),
s AS (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day FROM c),
k AS (SELECT DISTINCT o_orderpriority, o_orderstatus FROM c)
SELECT day, o_orderpriority, o_orderstatus, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM s CROSS JOIN k LEFT JOIN c USING (day, o_orderpriority, o_orderstatus)""")
def daily_order_grid(spark, sf):
    orders = read_table(spark, sf, "orders").withColumn("n", F.lit(1).cast("bigint"))
    return hr.daily_sums(orders, "o_orderdate", ["n"], ["o_orderpriority", "o_orderstatus"])


@query(f"""WITH {BY_TYPE} SELECT event_type, CAST(hour(ts_hour) AS INTEGER) AS hour, avg(n) AS n
FROM g GROUP BY 1, 2""")
def hour_of_day_mean(spark, sf):
    return hr.hour_of_day_means(grid(spark, sf), "ts_hour", ["n"], ["event_type"])


@query("""SELECT event_type, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_rows,
arg_max(value, (ts, event_id)) AS last_value FROM events GROUP BY 1""")
def series_bounds(spark, sf):
    return hr.series_bounds(events(spark, sf), "ts", ["event_type"], "value", "event_id")


@query("SELECT DISTINCT event_type, user_id % 10 AS loc FROM events")
def series_keys(spark, sf):
    located = events(spark, sf).withColumn("loc", F.col("user_id") % 10)
    return hr.series_keys(located, ["event_type", "loc"])


@query(f"""WITH {BY_TYPE} SELECT ts_hour, event_type, n,
CASE WHEN ts_hour < (SELECT max(ts_hour) - INTERVAL 7 DAY FROM g) THEN 'train' ELSE 'test' END AS segment
FROM g""")
def holdout_split_days(spark, sf):
    last = events(spark, sf).agg(hour_bucket(F.max("ts")).alias("t")).scalar()
    return sp.holdout_by_days(grid(spark, sf), "ts_hour", start=plus(last, days=-7))


@query(f"""WITH {BY_TYPE} SELECT ts_hour, event_type, n, CASE WHEN row_number()
OVER (PARTITION BY event_type ORDER BY ts_hour DESC) <= 168 THEN 'test' ELSE 'train' END AS segment FROM g""")
def holdout_last_n(spark, sf):
    return wn.last_rows_split(grid(spark, sf), ["event_type"], "ts_hour", 168)


@query("""SELECT event_id, CASE WHEN CAST('0x' || md5('42:' || event_id)[1:8] AS BIGINT) < 3221225472 THEN 'train' ELSE 'test' END
AS segment FROM events""")
def random_split(spark, sf):
    return sp.random_split(events(spark, sf).select("event_id"), "event_id")


def _metrics_sql(mape):
    return f"""WITH {BY_TYPE},
f AS (SELECT ts_hour, event_type, n AS y, lag(n, 24) OVER w AS p FROM g {SERIES}),
t AS (SELECT * FROM f WHERE ts_hour >= (SELECT max(ts_hour) - INTERVAL 7 DAY FROM g) AND p IS NOT NULL)
SELECT event_type, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
round({mape}, 9) AS mape, count(*) AS n, count(*) FILTER (WHERE y = 0) AS n_zero FROM t GROUP BY 1"""


def _lag_errors(spark, sf, mode):
    rows = staged_grid(spark, sf)
    lagged = wn.add_lags(rows, ["event_type"], "ts_hour", "n", {"predicted": 24})
    test = sp.since(lagged, "ts_hour", sp.holdout_start(rows, "ts_hour", 7))
    out = forecast_metrics(test, "n", "predicted", ["event_type"], mode)
    return out.withColumn("mape", F.round("mape", 9))


@query(_metrics_sql("100 * avg(CASE WHEN y <> 0 THEN abs(y - p) / y END)"))
def forecast_metrics_nonzero(spark, sf):
    return _lag_errors(spark, sf, "nonzero")


@query(_metrics_sql("""CASE WHEN count(*) FILTER (WHERE y = 0 AND p <> 0) > 0 THEN 0.0
ELSE 100 * avg(CASE WHEN y <> 0 THEN abs(y - p) / y END) END"""))
def forecast_metrics_published(spark, sf):
    return _lag_errors(spark, sf, "published")


@query(f"""WITH {BY_TYPE}, f AS (SELECT event_type,
unnest(generate_series(max(ts_hour) + INTERVAL 1 HOUR, max(ts_hour) + INTERVAL 168 HOUR, INTERVAL 1 HOUR))
AS ts_hour FROM g GROUP BY 1) SELECT event_type, ts_hour, {CALENDAR} FROM f""")
def future_frame(spark, sf):
    return ft.add_calendar(ft.future_frame(grid(spark, sf), ["event_type"], "ts_hour"), "ts_hour")


@query(f"""WITH {BY_TYPE}, f AS (SELECT unnest(generate_series(max(ts_hour) + INTERVAL 1 HOUR,
max(ts_hour) + INTERVAL 168 HOUR, INTERVAL 1 HOUR)) AS ts_hour, event_type, NULL AS n FROM g GROUP BY event_type),
a AS (SELECT * FROM g UNION ALL SELECT * FROM f)
SELECT ts_hour, event_type, n, {_lag(1, False)} AS lag_1h, {_lag(24, False)} AS lag_24h,
{_lag(168, False)} AS lag_168h, {_mean(24, False)} AS rolling_24h_mean, {_mean(168, False)} AS rolling_7d_mean
FROM a {SERIES}""")
def future_features(spark, sf):
    history = staged_grid(spark, sf)
    both = ft.extend(history, ft.future_frame(history, ["event_type"], "ts_hour"))
    return ft.add_history(both, ["event_type"], "ts_hour", "n", warmup="null")


@query(f"""WITH {BY_TYPE} SELECT * FROM c ORDER BY n DESC, ts_hour, event_type LIMIT 10""")
def top_values(spark, sf):
    counts = hr.hourly_counts(events(spark, sf), "ts", ["event_type"])
    return wn.top_rows(counts, [F.col("n").desc(), "ts_hour", "event_type"], 10)


@query("SELECT * FROM events ORDER BY ts, event_id LIMIT 5")
def first_rows(spark, sf):
    return wn.top_rows(events(spark, sf), ["ts", "event_id"], 5)


@query("""SELECT event_id, ts, event_type FROM events WHERE date_trunc('day', ts) =
(SELECT date_trunc('day', min(ts)) + INTERVAL 5 DAY FROM events)""")
def day_slice(spark, sf):
    rows = events(spark, sf).select("event_id", "ts", "event_type")
    day = plus(rows.agg(F.min("ts").alias("t")).scalar(), days=5)
    return sp.one_day(rows, "ts", day)


@query(f"""WITH {BY_TYPE} SELECT * FROM g WHERE ts_hour BETWEEN
(SELECT min(ts_hour) + INTERVAL 7 DAY FROM g) AND (SELECT min(ts_hour) + INTERVAL 14 DAY FROM g)""")
def week_slice(spark, sf):
    first = events(spark, sf).agg(hour_bucket(F.min("ts")).alias("t")).scalar()
    start = plus(first, days=7)
    return sp.between(grid(spark, sf), "ts_hour", start, plus(start, days=7))


@query("SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS seq_id FROM events")
def seq_id(spark, sf):
    rows = events(spark, sf).select("event_id", "ts")
    return wn.sequence_ids(rows, ["ts", "event_id"])


@query("""SELECT event_id, event_type, CAST(list_position(['click', 'error', 'purchase', 'signup', 'view'],
event_type) AS BIGINT) AS type_id, user_id, d.user_no FROM events
LEFT JOIN (SELECT user_id, row_number() OVER (ORDER BY user_id) AS user_no
FROM (SELECT DISTINCT user_id FROM events)) d USING (user_id)""")
def dimension_ids(spark, sf):
    rows = events(spark, sf).select("event_id", "event_type", "user_id")
    typed = rows.withColumn("type_id", position_in("event_type", TYPES))
    return with_dimension_id(typed, "user_id", "user_no")


@query("""WITH w AS (SELECT event_type, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS weight FROM events GROUP BY 1, 2)
SELECT event_type, hour, weight, weight / sum(weight) OVER (PARTITION BY event_type) AS share FROM w""")
def profile_normalise(spark, sf):
    rows = events(spark, sf)
    weights = rows.groupBy("event_type", F.hour("ts").alias("hour")).agg(
        F.count("*").alias("weight"))
    return pf.normalise(weights, "weight", ["event_type"])


SCALED = """
d AS (SELECT date_trunc('day', ts) AS day, event_type, count(*) AS total FROM events GROUP BY 1, 2),
m AS (SELECT *, CASE WHEN isodow(day) < 6 THEN 100 ELSE CASE event_type
  WHEN 'click' THEN 90 WHEN 'error' THEN 95 WHEN 'purchase' THEN 80 WHEN 'signup' THEN 90
  WHEN 'view' THEN 70 END END AS percent FROM d),
z AS (SELECT day, event_type, total, CAST(total * percent // 100 AS BIGINT) AS scaled FROM m)
"""


def _scaled(counts):
    """Daily totals from hourly counts, times the weekend factor."""
    daily = counts.groupBy(day_bucket("ts_hour").alias("day"), "event_type").agg(
        F.sum("n").alias("total"))
    factor = F.when(is_weekend("day") == 0, F.lit("1.0")).otherwise(
        by_case("event_type", WEEKEND, "1.0"))
    return pf.scale_totals(daily, "total", factor)


@query(f"WITH {SCALED} SELECT * FROM z")
def weekend_totals(spark, sf):
    return _scaled(hr.hourly_counts(events(spark, sf), "ts", ["event_type"]))


ALLOCATED = f"""WITH {SCALED}, p AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS weight FROM events GROUP BY 1),
h AS (SELECT CAST(range AS INTEGER) AS hour FROM range(24)),
x AS (SELECT day, event_type, scaled, hour, CAST(coalesce(weight, 0) AS HUGEINT) AS w,
  (SELECT CAST(sum(weight) AS HUGEINT) FROM p) AS sw FROM z CROSS JOIN h LEFT JOIN p USING (hour)),
y AS (SELECT *, scaled * w // sw AS base, scaled * w % sw AS rest FROM x),
r AS (SELECT *, row_number() OVER (PARTITION BY day, event_type ORDER BY rest DESC, hour) AS rn,
  scaled - sum(base) OVER (PARTITION BY day, event_type) AS spare FROM y),
al AS (SELECT day, event_type, hour, CAST(base + CASE WHEN rn <= spare THEN 1 ELSE 0 END AS BIGINT) AS allocated FROM r)
"""


def _allocated(spark, sf, hours=range(24)):
    counts = stage(hr.hourly_counts(events(spark, sf), "ts", ["event_type"]), "counts")
    weights = counts.filter(F.hour("ts_hour").isin(*hours)).groupBy(F.hour("ts_hour").alias("hour")).agg(F.sum("n").alias("weight"))
    return pf.allocate(_scaled(counts), ["day", "event_type"], "scaled", weights)


@query(ALLOCATED + "SELECT * FROM al")
def profile_allocate(spark, sf):
    return _allocated(spark, sf)


@query(ALLOCATED.replace("FROM events GROUP BY 1),\nh AS", "FROM events WHERE hour(ts) BETWEEN 8 AND 17 GROUP BY 1),\nh AS")
       + "SELECT * FROM al")
def allocate_sparse_profile(spark, sf):
    """A profile with weights for ten hours only; the other hours are there, with 0."""
    return _allocated(spark, sf, range(8, 18))


# The published shares of the hours 0 to 23, which sum to 1.08.
PUBLISHED = [0.02, 0.01, 0.005, 0.005, 0.01, 0.02, 0.06, 0.08, 0.09, 0.08, 0.06, 0.05,
             0.05, 0.05, 0.05, 0.06, 0.07, 0.08, 0.07, 0.06, 0.04, 0.03, 0.02, 0.01]


@query(ALLOCATED.replace("p AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS weight FROM events GROUP BY 1)",
                         "p AS (SELECT CAST(unnest(range(24)) AS INTEGER) AS hour, CAST(round(1000 * unnest("
                         + str(PUBLISHED) + ")) AS BIGINT) AS weight)") + "SELECT * FROM al")
def allocate_published_profile(spark, sf):
    """The published fractional weights as they are."""
    counts = hr.hourly_counts(events(spark, sf), "ts", ["event_type"])
    shares = F.array(*[F.lit(w) for w in PUBLISHED])
    weights = spark.range(1).select(F.posexplode(shares).alias("hour", "weight"))
    return pf.allocate(_scaled(counts), ["day", "event_type"], "scaled", weights)


@query(ALLOCATED + """SELECT day, event_type, day + to_hours(hour) AS ts,
unnest(generate_series(1, allocated)) AS copy FROM al""")
def allocated_movements(spark, sf):
    rows = pf.as_movements(_allocated(spark, sf), "day", "hour", "allocated")
    return rows.select("day", "event_type", "ts", "copy")


@query(f"""WITH {BY_TYPE} SELECT ts_hour, event_type, n, unnest(generate_series(1, n)) AS copy FROM c""")
def count_expand(spark, sf):
    return pf.expand_counts(hr.hourly_counts(events(spark, sf), "ts", ["event_type"]), "n")


def _value_mean(k):
    frame = f"OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
    return f"round(CASE WHEN count(value) {frame} = {k} THEN avg(value) {frame} END, 6)"


@query(f"SELECT event_id, event_type, {_value_mean(24)} AS mean_24, {_value_mean(168)} AS mean_168 FROM events")
def rolling_values(spark, sf):
    """Trailing means of doubles, by sums within blocks."""
    rows = events(spark, sf).select("event_id", "event_type", "value")
    out = wn.add_trailing_means(rows, ["event_type"], "event_id", "value", {"mean_24": 24, "mean_168": 168})
    return out.select("event_id", "event_type", *[F.round(c, 6).alias(c) for c in ("mean_24", "mean_168")])
