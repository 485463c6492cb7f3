"""Plans that must hold at scale: pushed filters, few shuffles, no overgrown group."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowcast.operators import hourly as hr
from flowcast.operators import nested as nt
from flowcast.operators import splits as sp
from flowcast.operators.features import add_features, hourly_features
from flowcast.operators.profile import expand_counts
from flowcast.operators.windows import add_history_in_table_order
from flowcast.queries import documents as docs


def plan_of(df):
    df.toArrow()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, events, tmp_path):
    rows = [(f"2024-01-0{d} {h:02d}:30:00", k) for d in (1, 2, 3) for h in range(0, 24, 5)
            for k in "ab"]
    events(rows).withColumn("pad", F.lit("x")).write.parquet(str(tmp_path / "e"))
    return spark.read.parquet(str(tmp_path / "e"))


def test_filters_and_columns_reach_the_scan(stored):
    plan = plan_of(hr.hourly_grid(stored.filter("kind = 'a'"), "ts", ["kind"]))
    assert "EqualTo(kind,a)" in plan and "pad" not in plan
    plan = plan_of(sp.one_day(stored, "ts", F.lit(datetime(2024, 1, 2))).select("ts"))
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in plan and "LessThan(ts,2024-01-03T00:00)" in plan


def test_features_after_the_grid_need_no_shuffle(stored):
    grid = hr.hourly_grid(stored, "ts", ["kind"], bounds="series")
    count = plan_of(grid).split("== Initial Plan ==")[0].count("Exchange hashpartitioning")
    full = plan_of(add_features(grid, ["kind"], "ts_hour", "n"))
    assert full.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == count == 2


def test_events_are_scanned_once_with_global_bounds(stored):
    plan = plan_of(hourly_features(stored, "ts", ["kind"]))
    final = plan.split("+- == Initial Plan ==")
    assert "ReusedExchange" in plan and sum(p.count("*(1) ColumnarToRow") for p in final[:2]) == 1


def test_hot_cell_is_counted_before_the_shuffle(spark):
    df = spark.range(0, 20000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"))
    out = hr.hourly_counts(df, "ts", ["k"])
    assert out.filter("k = 'hot'").first().n == 6667
    assert "partial_count" in out._jdf.queryExecution().executedPlan().toString()


def test_hot_count_expands_in_several_tasks(spark):
    df = spark.createDataFrame([("hot", 5000), ("cold", 3)], "k string, n bigint")
    parts = expand_counts(df, "n", chunk=100).groupBy("k", F.spark_partition_id().alias("p")).count()
    hot = parts.filter("k = 'hot'").agg(F.sum("count"), F.max("count")).first()
    assert hot[0] == 5000 and hot[1] < 5000


def test_hot_key_becomes_many_bounded_documents(spark):
    df = spark.range(0, 4000, 1, 2).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), "id")
    rows = docs.in_runs(df, "k", bits=6)
    nested = rows.groupBy("k", "run").agg(F.collect_list("id").alias("ids"))
    assert nested.agg(F.max(F.size("ids"))).first()[0] <= 64
    back = nt.explode_rows(nested, "ids", "id", ["k"])
    assert back.exceptAll(df.select("k", "id")).count() == 0 and back.count() == 4000


def test_grid_keeps_the_sessions_partitions(spark, stored):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert hr.hourly_grid(stored, "ts", ["kind"]).rdd.getNumPartitions() == 37
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_row_history_takes_one_shuffle_after_numbering(spark, stored):
    counts = hr.hourly_counts(stored, "ts", ["kind"])
    plan = plan_of(add_history_in_table_order(counts, ["ts_hour", "kind"], "n", {"a": 1, "b": 5}, {"m": 3}))
    first = plan.split("== Initial Plan ==")[1]
    assert first.count("hashpartitioning(_bucket") == 1 and "SortMergeJoin" not in first


def test_long_gaps_are_cut(spark, events):
    rows = events([("2020-01-01 00:00:00", "a"), ("2024-01-01 00:00:00", "a")])
    out = hr.hourly_grid(rows, "ts", ["kind"])
    assert out.count() == out.select("ts_hour").distinct().count() == 24 * 1461 + 1
