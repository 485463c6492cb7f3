from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowcast.operators import hourly as hr
from flowcast.operators.features import hourly_features

GAPPY = [("2024-01-01T00:10:00", "a"), ("2024-01-01T00:50:00", "a"), ("2024-01-01T03:00:00", "a"),
         ("2024-01-01T01:30:00", "b"), (None, "a")]


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_counts_keep_rows_without_time(events):
    got = values(hr.hourly_counts(events(GAPPY), "ts", ["kind"]).filter("ts_hour IS NOT NULL"),
                 "kind", F.hour("ts_hour"), "n")
    assert got == [("a", 0, 2), ("a", 3, 1), ("b", 1, 1)]
    assert hr.hourly_counts(events(GAPPY), "ts", ["kind"]).agg(F.sum("n")).first()[0] == 5


def test_grid_with_global_bounds(events):
    got = values(hr.hourly_grid(events(GAPPY), "ts", ["kind"]), "kind", F.hour("ts_hour"), "n")
    assert got == [("a", 0, 2), ("a", 1, 0), ("a", 2, 0), ("a", 3, 1),
                   ("b", 0, 0), ("b", 1, 1), ("b", 2, 0), ("b", 3, 0)]


def test_grid_with_own_bounds(events):
    got = values(hr.hourly_grid(events(GAPPY), "ts", ["kind"], bounds="series"),
                 "kind", F.hour("ts_hour"), "n")
    assert got == [("a", 0, 2), ("a", 1, 0), ("a", 2, 0), ("a", 3, 1), ("b", 1, 1)]


def test_keyless_grid(events):
    got = values(hr.hourly_grid(events(GAPPY), "ts"), F.hour("ts_hour"), "n")
    assert got == [(0, 2), (1, 1), (2, 0), (3, 1)]


def test_null_key_is_a_series(events):
    rows = events([("2024-01-01T00:00:00", None), ("2024-01-01T02:00:00", "a")])
    assert hr.hourly_grid(rows, "ts", ["kind"]).count() == 6


def test_one_row_and_empty(events):
    single = hr.hourly_grid(events([("2024-01-01T05:59:59", "a")]), "ts", ["kind"])
    assert values(single, "kind", "n") == [("a", 1)]
    for keys in (["kind"], []):
        full = hourly_features(events(GAPPY), "ts", keys)
        empty = hourly_features(events([]), "ts", keys)
        assert empty.schema == full.schema and empty.count() == 0


def test_pivot_fills_and_totals(events):
    wide = hr.hourly_pivot(events(GAPPY).filter("ts IS NOT NULL"), "ts", "kind", ["a", "b", "c d"])
    assert wide.columns == ["ts_hour", "a", "b", "c d", "total"]
    assert values(wide, "a", "b", "c d", "total") == [(0, 1, 0, 1), (1, 0, 0, 1), (2, 0, 0, 2)]
    found = hr.hourly_pivot(events(GAPPY).filter("ts IS NOT NULL"), "ts", "kind")
    assert found.columns == ["ts_hour", "a", "b", "total"]


def test_daily_sums_fill_days_and_nulls(spark):
    rows = [(datetime(2024, 1, 1, 5), 2.0), (datetime(2024, 1, 1, 6), 3.0),
            (datetime(2024, 1, 4, 1), None)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v double")
    got = values(hr.daily_sums(df, "ts", ["v"]), F.dayofmonth("day"), "v")
    assert got == [(1, 5.0), (2, 0.0), (3, 0.0), (4, 0.0)]


def test_align_left_joins_and_fills(spark):
    index = spark.createDataFrame([(1,), (2,)], "i int")
    rows = spark.createDataFrame([(2, 5), (3, 6)], "i int, v int")
    assert values(hr.align(index, rows, ["i"], ["v"]), "i", "v") == [(1, 0), (2, 5)]


def test_bounds_and_keys(events):
    rows = events(GAPPY).withColumn("v", F.monotonically_increasing_id())
    got = hr.series_bounds(rows.filter("ts IS NOT NULL"), "ts", ["kind"], "v").orderBy("kind").first()
    assert (got.first_ts.minute, got.last_ts.hour, got.n_rows) == (10, 3, 3)
    assert hr.series_keys(events(GAPPY), ["kind"]).count() == 2


def test_pairing_keeps_a_null_key(events):
    left = hr.hourly_grid(events([("2024-01-01T00:00:00", None), ("2024-01-01T02:00:00", "a")]),
                          "ts", ["kind"])
    right = left.withColumnRenamed("n", "m").filter("kind IS NULL")
    got = hr.pair(left, right, ["kind"], "ts_hour")
    assert got.columns == ["ts_hour", "kind", "n", "m"] and got.count() == 6
    assert got.filter("kind IS NULL AND m = n").count() == 3 == got.filter("m IS NULL").count()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_hours_of_any_era_and_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2024-03-10 02:30:15.25", "1969-12-31 23:59:59.999999", "1970-01-01 00:00:00",
                 "1899-05-06 07:08:09", "2024-12-31 23:00:00"]
        df = spark.sql("SELECT * FROM VALUES " + ", ".join(
            f"(TIMESTAMP_NTZ'{t}')" for t in texts) + ", (NULL) AS v(ts)")
        out = hr.with_hour(df, "ts")
        assert dict(out.dtypes)["ts_hour"] == "timestamp_ntz"
        want = {t: t.replace(minute=0, second=0, microsecond=0)
                for t in map(datetime.fromisoformat, texts)}
        assert {r.ts: r.ts_hour for r in out.collect()} == {**want, None: None}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_zoned_times_keep_their_type(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 05:30:00' AS ts")
    assert dict(hr.hourly_counts(df, "ts").dtypes)["ts_hour"] == "timestamp"
