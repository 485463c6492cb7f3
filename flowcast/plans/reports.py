"""Report tables from a forecast: what a chart would show, as rows."""

from pyspark.sql import functions as F

from flowcast.functions.calendar import day_bucket, plus
from flowcast.models.forest import predict_forest
from flowcast.operators.hourly import daily_sums, hour_of_day_means
from flowcast.operators.metrics import forecast_metrics
from flowcast.operators.splits import between, one_day
from flowcast.operators.windows import top_rows


def overall(result):
    """Every hour with its segment, and the split and horizon marks."""
    return result.marked(result.forecast).select(*result.forecast.columns, "test_start", "forecast_start")


def test_period(result):
    """Actual against predicted from the split to the horizon, both included."""
    rows = result.marked(result.forecast).filter(F.col(result.ts).between(F.col("test_start"), F.col("forecast_start")))
    return rows.select(*result.forecast.columns)


def daily(result, bounds="series"):
    """Daily sums of actual and predicted by segment; all-NULL days give 0."""
    return daily_sums(result.forecast, result.ts, ["actual", "predicted"],
                      [*result.keys, "segment"], bounds=bounds)


def day_pattern(result, days_after_split=5):
    """Hours of one sample day of the test period."""
    rows = result.marked(result.forecast)
    rows = one_day(rows, result.ts, plus(day_bucket("test_start"), days=days_after_split))
    return rows.select(*result.keys, F.hour(result.ts).alias("hour"), "actual", "predicted")


def fitted(result, n="n"):
    """The model's own predictions for its training rows."""
    if result.model is None:
        return result.training.withColumn("predicted", F.lit(None).cast("double"))
    return predict_forest(result.model, result.training)


def hour_pattern(result, rows=None, n="n"):
    """Mean actual and fitted value per hour of day over the training rows."""
    rows = fitted(result, n) if rows is None else rows
    rows = rows.select(*result.keys, result.ts, F.col(n).alias("actual"), "predicted")
    return hour_of_day_means(rows, result.ts, ["actual", "predicted"], result.keys)


def first_week(result):
    """The first seven forecast days, both ends included."""
    rows = result.marked(result.forecast)
    rows = between(rows, result.ts, F.col("forecast_start"), plus("forecast_start", days=7))
    return rows.select(*result.keys, result.ts, "predicted")


def top_importances(result, n=10):
    return top_rows(result.importance, [F.col("importance").desc(), "feature"], n)


def model_errors(compared, keys, mape_mode="nonzero"):
    """Errors by series and model of ``compare_models`` rows."""
    return forecast_metrics(compared, "actual", "predicted", [*keys, "model"], mape_mode)
