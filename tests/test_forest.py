from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowcast.models import forest as fo
from flowcast.operators.features import FEATURES, add_features, extend, future_frame
from flowcast.plans import reports as rp
from flowcast.plans.forecast import compare_models, forecast_job


@pytest.fixture(scope="module")
def raw(spark):
    """Movements of two kinds with a daily cycle, 40 days."""
    rng = np.random.default_rng(5)
    start, rows = datetime(2024, 1, 1), []
    for h in range(24 * 40):
        for kind, level in (("a", 3), ("b", 1)):
            for _ in range(int(rng.poisson(level * (2 if 7 <= h % 24 <= 18 else 1)))):
                rows.append((start + timedelta(hours=h, minutes=int(rng.integers(60))), kind))
    rows += [(start, "a"), (start + timedelta(hours=24 * 40 - 1), "a")]
    return spark.createDataFrame(rows, "ts timestamp_ntz, kind string").cache()


@pytest.fixture(scope="module")
def job(raw):
    return forecast_job(raw, "ts", ["kind"], horizon=30, trees=8, depth=5)


def test_split_and_segments(job):
    counts = {(r.kind, r.segment): r["count"] for r in
              job.forecast.groupBy("kind", "segment").count().collect()}
    assert counts == {(k, s): n for k in "ab" for s, n in
                      (("train", 24 * 40 - 721), ("test", 721), ("future", 30))}
    mark = job.marks.first()
    assert mark.test_start == mark.last_ts - timedelta(days=30)
    assert mark.forecast_start == mark.last_ts + timedelta(hours=1)


def test_predictions_sit_where_they_belong(job):
    bad = job.forecast.filter(
        "(segment = 'train' AND (predicted IS NOT NULL OR actual IS NULL)) OR "
        "(segment = 'test' AND (predicted IS NULL OR actual IS NULL)) OR "
        "(segment = 'future' AND (predicted IS NULL OR actual IS NOT NULL)) OR predicted < 0")
    assert bad.count() == 0
    assert {(r.kind, r.n) for r in job.metrics.collect()} == {("a", 721), ("b", 721)}


def test_first_step_equals_plain_prediction(spark, job):
    """At the first future hour all lags are actual values."""
    grid = job.features.select("ts_hour", "kind", "n")
    ahead = extend(grid, future_frame(grid, ["kind"], "ts_hour", 1))
    rows = add_features(ahead, ["kind"], "ts_hour", "n").filter("n IS NULL")
    want = {r.kind: r.predicted for r in fo.predict_forest(job.model, rows).collect()}
    got = fo.forecast_forest(spark, job.model, grid, ["kind"], "ts_hour", "n", 1).collect()
    assert {r.kind: r.predicted for r in got} == pytest.approx(want, abs=1e-12)


def test_recursion_equals_step_by_step_scoring(spark, job):
    """Append each prediction as if it were actual, and score the next hour anew."""
    grid = job.features.select("ts_hour", "kind", F.col("n").cast("double"))
    got = fo.forecast_forest(spark, job.model, grid, ["kind"], "ts_hour", "n", 3)
    got = {(r.kind, r.ts_hour): r.predicted for r in got.collect()}
    for _ in range(3):
        ahead = extend(grid, future_frame(grid, ["kind"], "ts_hour", 1))
        rows = add_features(ahead, ["kind"], "ts_hour", "n").filter("n IS NULL")
        step = [(r.ts_hour, r.kind, r.predicted)
                for r in fo.predict_forest(job.model, rows).collect()]
        for ts, kind, predicted in step:
            assert got[kind, ts] == pytest.approx(predicted, abs=1e-9)
        grid = grid.union(spark.createDataFrame(step, grid.schema))


def test_series_shorter_than_the_memory(spark, job, series):
    short = series({"s": [3, 4, 5]}).withColumn("n", F.col("n").cast("double"))
    got = fo.forecast_forest(spark, job.model, short, ["kind"], "ts_hour", "n", 1).first()
    ahead = extend(short, future_frame(short, ["kind"], "ts_hour", 1))
    rows = add_features(ahead, ["kind"], "ts_hour", "n").filter("n IS NULL")
    want = fo.predict_forest(job.model, rows).first()
    assert (got.ts_hour, got.predicted) == (want.ts_hour, pytest.approx(want.predicted))


def test_same_seed_same_forest(job, raw):
    again = forecast_job(raw, "ts", ["kind"], horizon=1, trees=8, depth=5)
    assert again.importance.collect() == job.importance.collect()


def test_importance(job):
    rows = job.importance.collect()
    assert [r.feature for r in rows] == FEATURES
    assert sum(r.importance for r in rows) == pytest.approx(1.0)
    top = rp.top_importances(job, 3).collect()
    assert [r.importance for r in top] == sorted((r.importance for r in rows), reverse=True)[:3]


def test_reports(job):
    start = job.marks.first().test_start
    assert rp.overall(job).filter("test_start IS NULL OR forecast_start IS NULL").count() == 0
    assert rp.test_period(job).count() == 2 * (721 + 1)
    assert rp.day_pattern(job).count() == 48
    assert rp.first_week(job).count() == 60
    assert rp.hour_pattern(job).count() == 48
    daily = rp.daily(job).filter("segment = 'test' AND kind = 'a'")
    assert daily.count() == 31 and daily.agg(F.min("day")).first()[0] == start.replace(hour=0)
    train = rp.daily(job).filter("segment = 'train'").agg(F.sum("predicted")).first()[0]
    assert train == 0.0


def test_keyless_job(raw):
    job = forecast_job(raw, "ts", horizon=5, trees=3, depth=3, holdout_days=5)
    got = {r.segment: r["count"] for r in job.forecast.groupBy("segment").count().collect()}
    assert got == {"train": 24 * 40 - 121, "test": 121, "future": 5}


def test_empty_job(raw, job):
    none = forecast_job(raw.limit(0), "ts", ["kind"])
    assert none.model is None and none.forecast.count() == 0 and none.metrics.count() == 0
    assert none.forecast.schema == job.forecast.schema
    assert none.metrics.columns == job.metrics.columns
    assert rp.hour_pattern(none).count() == 0


def test_models_are_compared_on_the_same_hours(raw):
    out = compare_models(raw, "ts", ["kind"], holdout_hours=48)
    got = {(r.kind, r.model): r["count"] for r in
           out.filter("predicted IS NOT NULL").groupBy("kind", "model").count().collect()}
    assert got == {(k, m): 48 for k in "ab" for m in
                   ("autoregression", "seasonal_autoregression", "fourier")}
    errors = rp.model_errors(out, ["kind"])
    assert errors.count() == 6 and errors.filter("mae > 3").count() == 0
