"""Feature rows for the hourly model."""

from pyspark.sql import functions as F

from flowcast.functions.calendar import CALENDAR, calendar_columns, sequence_after
from flowcast.operators.hourly import hourly_grid
from flowcast.operators.windows import add_lags, add_trailing_means

# The model's lags and trailing windows, in hours.
LAGS = {"lag_1h": 1, "lag_24h": 24, "lag_168h": 168}
MEANS = {"rolling_24h_mean": 24, "rolling_7d_mean": 168}
FEATURES = [*CALENDAR, *LAGS, *MEANS]


def add_calendar(df, ts):
    return df.withColumns(calendar_columns(ts))


def add_history(df, keys, ts, y, warmup="zero"):
    """Lags and trailing means. ``warmup``: "zero" fills, "null" keeps, "drop" removes
    the rows that lack history."""
    how = "null" if warmup == "drop" else warmup
    out = add_trailing_means(add_lags(df, keys, ts, y, LAGS, how), keys, ts, y, MEANS, how)
    return out.na.drop(subset=[*LAGS, *MEANS]) if warmup == "drop" else out


def add_features(grid, keys, ts, y, warmup="zero"):
    """The 13 features next to the target; ``grid`` must be gap-free."""
    return add_calendar(add_history(grid, keys, ts, y, warmup), ts)


def hourly_features(events, ts, keys=(), hour="ts_hour", n="n", warmup="zero",
                    bounds="global"):
    """Events to feature rows: count, close gaps, add features."""
    grid = hourly_grid(events, ts, keys, hour, n, bounds)
    return add_features(grid, list(keys), hour, n, warmup)


def future_frame(grid, keys, ts, horizon=168):
    """The ``horizon`` hours after each series' last one."""
    last = grid.groupBy(*keys).agg(F.max(ts).alias("_last"))
    return last.select(
        F.explode(sequence_after("_last", horizon)).alias(ts), *keys
    )


def extend(grid, future):
    """History and future rows in one table; columns the future lacks are NULL."""
    return grid.unionByName(future, allowMissingColumns=True)
