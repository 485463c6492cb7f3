"""Forecast errors."""

from pyspark.sql import functions as F

from flowcast.functions.calendar import as_column


def forecast_metrics(df, actual, predicted, by=(), mape_mode="nonzero"):
    """MAE, RMSE and MAPE per group, in one pass; rows with a NULL side do not count.

    ``mape_mode="nonzero"`` averages over actual values other than 0. ``"published"``
    is 0 as soon as any actual 0 was predicted as something else; rows where both are
    0 are skipped.
    """
    rows = df.filter(as_column(actual).isNotNull() & as_column(predicted).isNotNull())
    y, p = as_column(actual).cast("double"), as_column(predicted).cast("double")
    error = y - p
    relative = F.avg(F.try_divide(F.abs(error), F.abs(y))) * 100
    if mape_mode == "published":
        relative = F.when(F.count_if((y == 0) & (p != 0)) > 0, F.lit(0.0)).otherwise(relative)
    elif mape_mode != "nonzero":
        raise ValueError(f"mape_mode must be 'nonzero' or 'published', not {mape_mode!r}")
    return rows.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        relative.alias("mape"),
        F.count("*").alias("n"),
        F.count_if(y == 0).alias("n_zero"),
    )
