from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowcast.operators import profile as pf


def brute(total, weights):
    everything = sum(weights.values())
    base = {h: total * w // everything for h, w in weights.items()}
    order = sorted(weights, key=lambda h: (-(total * weights[h] % everything), h))
    for h in order[: total - sum(base.values())]:
        base[h] += 1
    return base


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(total=st.integers(0, 10**9), seed=st.lists(st.integers(0, 10**12), min_size=24, max_size=24))
def test_allocation_is_exact(spark, total, seed):
    weights = {h: w for h, w in enumerate(seed)}
    weights[0] += 1
    profile = spark.createDataFrame(list(weights.items()), "hour int, weight bigint")
    daily = spark.createDataFrame([("d", total)], "day string, total bigint")
    got = {r.hour: r.allocated for r in pf.allocate(daily, ["day"], "total", profile).collect()}
    assert sum(got.values()) == total
    assert got == brute(total, weights)


def test_normalise_sums_to_one(spark):
    df = spark.createDataFrame([("a", 2), ("a", 6), ("b", 0)], "p string, w bigint")
    got = {(r.p, r.w): r.share for r in pf.normalise(df, "w", ["p"]).collect()}
    assert got == {("a", 2): 0.25, ("a", 6): 0.75, ("b", 0): None}


def test_scaling_is_exact(spark):
    df = spark.createDataFrame([(10,), (15000,), (7,)], "n bigint")
    got = [r.scaled for r in pf.scale_totals(df, "n", F.lit("0.9")).collect()]
    assert got == [9, 13500, 6]


def test_factors_keep_their_digits(spark):
    df = spark.createDataFrame([(1_000_000,)], "n bigint")
    assert pf.scale_totals(df, "n", F.lit("0.333333")).first().scaled == 333333
    assert pf.scale_totals(df, "n", F.lit("150")).first().scaled == 150_000_000
    assert pf.scale_totals(df, "n", F.lit("0.12345678901").cast("decimal(12,11)")).first().scaled == 123456


@pytest.mark.parametrize("weights", [[], [(3, 0), (4, 0)]])
def test_profiles_without_weight(spark, weights):
    profile = spark.createDataFrame(weights, "hour int, weight bigint")
    daily = spark.createDataFrame([("d", 50), ("e", 0)], "day string, total bigint")
    got = {(r.day, r.hour): r.allocated for r in pf.allocate(daily, ["day"], "total", profile).collect()}
    assert got == {("d", h): 2 + (h < 2) for h in range(24)} | {("e", h): 0 for h in range(24)}
    with pytest.raises(Exception, match="no weight above 0"):
        pf.allocate(daily, ["day"], "total", profile, without_weights="error").collect()


def test_sparse_profile_keeps_all_hours(spark):
    profile = spark.createDataFrame([(7, 1), (9, 3)], "hour int, weight bigint")
    daily = spark.createDataFrame([("d", 10)], "day string, total bigint")
    got = {r.hour: r.allocated for r in pf.allocate(daily, ["day"], "total", profile).collect()}
    assert got == {h: {7: 3, 9: 7}.get(h, 0) for h in range(24)}


@pytest.mark.parametrize("chunk", [1, 3, 100])
def test_expand_counts_across_chunks(spark, chunk):
    df = spark.createDataFrame([("a", 7), ("b", 0), ("c", 1), ("d", 9)], "k string, n bigint")
    got = sorted((r.k, r.copy) for r in pf.expand_counts(df, "n", chunk=chunk).collect())
    want = [("a", i) for i in range(1, 8)] + [("c", 1)] + [("d", i) for i in range(1, 10)]
    assert got == want


def test_movements_are_timed_in_their_hour(spark):
    df = spark.createDataFrame([(date(2024, 1, 2), 5, 2)], "day date, hour int, allocated bigint")
    rows = pf.as_movements(df, "day", "hour", "allocated").collect()
    assert [(r.ts.day, r.ts.hour, r.copy) for r in rows] == [(2, 5, 1), (2, 5, 2)]


@pytest.mark.parametrize("kind", ["double", "decimal(6,3)", "float"])
def test_fractional_weights_keep_their_places(spark, kind):
    daily = spark.sql("SELECT date'2024-01-01' AS day, 1000L AS total")
    profile = spark.sql(f"SELECT CAST(id AS int) AS hour, CAST(IF(id = 8, 0.4, 0.02) AS {kind}) AS weight FROM range(24)")
    got = {r.hour: r.allocated for r in pf.allocate(daily, ["day"], "total", profile).collect()}
    assert sum(got.values()) == 1000 and got[8] == 465 and {got[h] for h in range(24) if h != 8} == {23, 24}


def test_hours_out_of_the_day_are_an_error(spark):
    daily = spark.sql("SELECT date'2024-01-01' AS day, 10L AS total")
    for hour in ("24", "-1", "NULL"):
        profile = spark.sql(f"SELECT CAST({hour} AS int) AS hour, 1L AS weight")
        with pytest.raises(Exception, match="out of 0 to 23"):
            pf.allocate(daily, ["day"], "total", profile).collect()
