import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowcast.operators import features as ft
from flowcast.operators import splits as sp
from flowcast.operators import windows as wn
from flowcast.operators.dimensions import dimension_table, position_in, with_dimension_id
from flowcast.operators.stacking import stack, stack_tagged


@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_trailing_mean_excludes_the_current_row(series, kind):
    df = series({"a": range(30)}, kind=kind)
    out = wn.add_trailing_means(df, ["kind"], "ts_hour", "n", {"m": 24}, "null")
    got = [r.m for r in out.orderBy("ts_hour").collect()]
    assert got[:24] == [None] * 24 and got[24] == 11.5 and got[29] == 16.5
    zero = wn.add_trailing_means(df, ["kind"], "ts_hour", "n", {"m": 24}, "zero")
    assert [r.m for r in zero.orderBy("ts_hour").collect()][:24] == [0.0] * 24


@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_trailing_mean_needs_every_value(spark, kind):
    start = datetime(2024, 1, 1)
    values = [1, 2, None, 4, 5, 6]
    rows = [(start + timedelta(hours=i), "a", v if v is None or kind == "bigint" else float(v))
            for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"ts_hour timestamp_ntz, kind string, n {kind}")
    out = wn.add_trailing_means(df, ["kind"], "ts_hour", "n", {"m": 2})
    assert [r.m for r in out.orderBy("ts_hour").collect()] == [None, None, 1.5, None, None, 4.5]


def test_lags_stay_in_their_series(series):
    df = series({"a": range(5), "b": range(100, 105)})
    out = wn.add_lags(df, ["kind"], "ts_hour", "n", {"l": 2}).orderBy("kind", "ts_hour")
    assert [r.l for r in out.collect()] == [None, None, 0.0, 1.0, 2.0, None, None, 100.0, 101.0, 102.0]


def test_warmup_drop(series):
    full = series({"a": range(200)})
    assert ft.add_features(full, ["kind"], "ts_hour", "n", "drop").count() == 32
    assert ft.add_features(full, ["kind"], "ts_hour", "n", "zero").count() == 200


def test_global_index_in_many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        df = spark.range(0, 5000, 1, 5).select(
            ((F.col("id") * 7919) % 5003).alias("a"), F.lit("x" * 400).alias("pad"))
        df = df.select("a", "pad", *[F.lit("y" * 400).alias(f"p{i}") for i in range(8)])
        got = wn.global_row_index(df, ["a"]).select("a", "row_index").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ordered = sorted(r.a for r in got)
    assert {r.a: r.row_index for r in got} == {a: i + 1 for i, a in enumerate(ordered)}


@pytest.mark.parametrize("parts", ["1", "5"])
def test_history_in_table_order(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame([(i, i * i) for i in range(50)], "a int, v bigint")
        out = wn.add_history_in_table_order(df, ["a"], "v", {"l": 3}, {"m": 4}, bucket=int(parts) + 3)
        rows = out.orderBy("a").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r.l for r in rows] == [None] * 3 + [i * i for i in range(47)]
    assert [r.m for r in rows] == [None] * 4 + [
        sum(j * j for j in range(i - 4, i)) / 4 for i in range(4, 50)]


def test_holdout_is_721_hours_when_gap_free(series):
    df = series({"a": [1] * 1000})
    tagged = sp.holdout_by_days(df, "ts_hour", 30)
    assert tagged.filter("segment = 'test'").count() == 721
    assert wn.last_rows_split(df, ["kind"], "ts_hour", 168).filter("segment = 'test'").count() == 168


def test_slices(series):
    df = series({"a": range(72)})
    start = F.lit(datetime(2024, 1, 2))
    assert sp.one_day(df, "ts_hour", start).count() == 24
    assert sp.between(df, "ts_hour", start, F.lit(datetime(2024, 1, 3))).count() == 25
    assert sp.before(df, "ts_hour", start).count() + sp.since(df, "ts_hour", start).count() == 72
    parts = sp.random_split(df.withColumn("id", F.monotonically_increasing_id()), "id", (0.5, 0.3, 0.2), ("a", "b", "c"), 1)
    assert parts.count() == 72 and {r.segment for r in parts.collect()} == {"a", "b", "c"}
    assert parts.exceptAll(sp.random_split(parts.drop("segment"), "id", (0.5, 0.3, 0.2), ("a", "b", "c"), 1)).isEmpty()


def test_future_frame_follows_each_series(series):
    df = series({"a": range(5), "b": range(3)})
    rows = ft.future_frame(df, ["kind"], "ts_hour", 2).orderBy("kind", "ts_hour").collect()
    assert [(r.kind, r.ts_hour.hour) for r in rows] == [("a", 5), ("a", 6), ("b", 3), ("b", 4)]
    both = ft.extend(df, ft.future_frame(df, ["kind"], "ts_hour", 2))
    assert both.filter("n IS NULL").count() == 4 and both.count() == 12


def test_dimension_ids(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "k string")
    assert sorted(tuple(r) for r in dimension_table(df, "k", "id").collect()) == [("a", 1), ("b", 2)]
    got = [r.id for r in with_dimension_id(df, "k", "id").orderBy("k").collect()]
    assert got == [None, 1, 2, 2]
    got = [r[0] for r in df.orderBy("k").select(position_in("k", ["b", "a"])).collect()]
    assert got == [None, 2, 1, 1]


def test_stacks(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y",), ("z",)], "s string")
    assert sorted(map(tuple, stack_tagged({"p": a, "q": b}, "t").collect()), key=repr) == [
        (1, "x", "p"), (None, "y", "q"), (None, "z", "q")]
    assert stack(a, b, b).count() == 5


def test_top_rows(spark):
    df = spark.range(100)
    assert [r.id for r in wn.top_rows(df, [F.col("id").desc()], 3).collect()] == [99, 98, 97]
    assert wn.first_rows(df).count() == 5


@pytest.mark.parametrize("k", [1, 3, 7])
def test_block_means_of_doubles(spark, series, k):
    values = {"a": [random.Random(i).uniform(-5, 5) for i in range(40)], "b": [1.5], "c": [2.0] * k}
    values["a"][4] = 1e300
    out = wn.add_trailing_means(series(values, kind="double"), ["kind"], "ts_hour", "n", {"m": k})
    got = {(r.kind, r.ts_hour.hour + 24 * (r.ts_hour.day - 1)): r.m for r in out.collect()}
    for kind, row in values.items():
        for i in range(len(row)):
            want = sum(row[i - k:i]) / k if i >= k else None
            assert got[kind, i] == (pytest.approx(want, rel=1e-12) if want is not None else None)


def test_block_means_of_nulls_and_infinities(spark):
    rows = [(i, v) for i, v in enumerate([1.0, None, 2.0, 4.0, float("inf"), 3.0, 5.0, float("nan"), 1.0, 2.0, 3.0])]
    out = wn.add_trailing_means(spark.createDataFrame(rows, "t int, y double"), [], "t", "y", {"m": 2})
    got = [r.m for r in out.orderBy("t").collect()]
    assert got[:5] == [None, None, None, None, 3.0]
    assert got[5] == got[6] == float("inf") and got[7] == 4.0 and got[10] == 1.5
    assert got[8] != got[8] and got[9] != got[9]
    assert wn.add_trailing_means(spark.createDataFrame([], "t int, y double"), [], "t", "y", {"m": 2}).count() == 0


def test_block_means_use_no_sliding_frame(spark, series):
    out = wn.add_trailing_means(series({"a": [1.0] * 9}, kind="double"), ["kind"], "ts_hour", "n", {"m": 24, "w": 168})
    plan = out._jdf.queryExecution().executedPlan().toString()
    frames = re.findall(r"specifiedwindowframe\(RowFrame, ([^)]*\)?)", plan)
    assert frames and all("unboundedpreceding" in f or re.match(r"-\d+, -\d+", f) for f in frames)
    assert "AVG" not in plan.upper() and plan.count("Exchange hashpartitioning") <= 1
