from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from flowcast.functions import calendar as cal
from flowcast.functions.numeric import by_case, clip_below, row_total


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kolkata"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


# 02:30 on 10 March 2024 does not exist in New York.
@pytest.mark.parametrize("text", ["2024-03-10 02:30:15.25", "2024-12-30 23:59:59.999999",
                                  "2024-02-29 00:00:00"])
def test_buckets_do_not_depend_on_the_zone(spark, zone, text):
    df = spark.sql(f"SELECT TIMESTAMP_NTZ'{text}' AS t")
    row = df.select(cal.hour_bucket("t").alias("h"), cal.day_bucket("t").alias("d"))
    assert row.dtypes == [("h", "timestamp_ntz"), ("d", "timestamp_ntz")]
    exact = datetime.fromisoformat(text)
    assert tuple(row.first()) == (exact.replace(minute=0, second=0, microsecond=0),
                                  datetime(exact.year, exact.month, exact.day))


def test_calendar_at_the_turn_of_the_iso_year(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-12-30 13:00:00' AS t")
    row = df.select(*[c.alias(n) for n, c in cal.calendar_columns("t").items()]).first()
    assert row.asDict() == {"hour": 13, "dayofweek": 0, "dayofyear": 365, "month": 12,
                            "year": 2024, "weekofyear": 1, "is_weekend": 0, "quarter": 4}


def test_weekend(spark):
    days = [date(2024, 6, d) for d in range(3, 10)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [tuple(r) for r in df.select(cal.weekday("d"), cal.is_weekend("d")).collect()]
    assert got == [(i, int(i >= 5)) for i in range(7)]


def test_parse(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("soon",), (None,)], "t string")
    assert [r[0] for r in df.select(cal.parse_timestamp("t")).collect()] == [
        datetime(2024, 1, 2, 3, 4, 5), None, None]
    df = spark.createDataFrame([("02/01/2024 03",), ("x",)], "t string")
    assert [r[0] for r in df.select(cal.parse_timestamp("t", "dd/MM/yyyy HH")).collect()] == [
        datetime(2024, 1, 2, 3), None]


def test_sequences_and_arithmetic(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-31 22:00:00' AS t, DATE'2024-02-01' AS d")
    row = df.select(
        cal.sequence_after("t", 4).alias("s"), cal.plus("t", days=-30, hours=1).alias("p"),
        cal.time_on("d", 7, 8, 9).alias("o"), cal.date_text("t").alias("x"),
        F.size(cal.sequence_between("t", cal.plus("t", days=2), "day")).alias("n")).first()
    assert [t.hour for t in row.s] == [23, 0, 1, 2]
    assert row.p == datetime(2024, 1, 1, 23)
    assert row.o == datetime(2024, 2, 1, 7, 8, 9)
    assert (row.x, row.n) == ("2024-01-31", 3)


def test_numeric_helpers(spark):
    df = spark.createDataFrame([(-1.5, 2.5, "a"), (None, 1.0, "z")], "x double, y double, k string")
    rows = df.select(clip_below("x"), row_total(["y", "y"]),
                     by_case("k", {"a": 1, "b": 2}, 0)).collect()
    assert [tuple(r) for r in rows] == [(0.0, 5.0, 1), (None, 2.0, 0)]
