import math

import pytest

from flowcast.operators.metrics import forecast_metrics


def errors(spark, rows, mode):
    df = spark.createDataFrame([(float(y), float(p)) for y, p in rows], "y double, p double")
    return forecast_metrics(df, "y", "p", mape_mode=mode).first()


def test_plain_errors(spark):
    row = errors(spark, [(2, 1), (4, 6), (0, 0)], "nonzero")
    assert row.mae == pytest.approx(1.0)
    assert row.rmse == pytest.approx(math.sqrt(5 / 3))
    assert row.mape == pytest.approx(50.0)
    assert (row.n, row.n_zero) == (3, 1)


def test_published_mape_is_zero_once_infinite(spark):
    assert errors(spark, [(2, 1), (4, 6), (0, 3)], "published").mape == 0.0
    assert errors(spark, [(2, 1), (4, 6), (0, 3)], "nonzero").mape == pytest.approx(50.0)
    assert errors(spark, [(2, 1), (4, 6), (0, 0)], "published").mape == pytest.approx(50.0)


def test_null_sides_do_not_count(spark):
    df = spark.createDataFrame([(1.0, None), (None, 1.0), (1.0, 2.0)], "y double, p double")
    row = forecast_metrics(df, "y", "p").first()
    assert (row.n, row.mae) == (1, 1.0)
    with pytest.raises(ValueError):
        forecast_metrics(df, "y", "p", mape_mode="other")
