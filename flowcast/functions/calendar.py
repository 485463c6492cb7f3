"""Time columns. Zone-free timestamps stay zone-free, whatever the session zone is."""

from pyspark.sql import Column
from pyspark.sql import functions as F

CALENDAR = ["hour", "dayofweek", "dayofyear", "month", "year", "weekofyear", "is_weekend",
            "quarter"]


def as_column(c):
    return c if isinstance(c, Column) else F.col(c)


def parse_timestamp(c, fmt=None):
    """Text to a zone-free timestamp; NULL where it cannot be read."""
    c = as_column(c)
    if fmt is None:
        return c.try_cast("timestamp_ntz")
    # The zoned parser only says whether the text fits; the value is read without any zone.
    return F.when(F.try_to_timestamp(c, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(c, F.lit(fmt)))


def hour_bucket(c):
    """Start of the hour. Subtracts minutes and seconds, so no zone rule applies."""
    c = as_column(c)
    return c - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(c), F.extract(F.lit("SECOND"), c))


def day_bucket(c):
    """Midnight of the day, zone-free."""
    return F.to_date(as_column(c)).cast("timestamp_ntz")


def weekday(c):
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(as_column(c))


def is_weekend(c):
    return (weekday(c) >= 5).cast("int")


def calendar_columns(ts):
    """The eight calendar features by name. The week is ISO, the year is not."""
    ts = as_column(ts)
    return {
        "hour": F.hour(ts),
        "dayofweek": weekday(ts),
        "dayofyear": F.dayofyear(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "weekofyear": F.weekofyear(ts),
        "is_weekend": is_weekend(ts),
        "quarter": F.quarter(ts),
    }


def plus(c, days=0, hours=0):
    """Shift by whole days and hours; either may be a number or a column."""
    amount = [x if isinstance(x, Column) else F.lit(x) for x in (days, hours)]
    return as_column(c) + F.make_dt_interval(*amount)


def time_on(day, hour, minute=0, second=0):
    """Timestamp from a day and the time of day."""
    parts = [x if isinstance(x, Column) else F.lit(x) for x in (hour, minute, second)]
    midnight = as_column(day).cast("timestamp_ntz")
    return midnight + F.make_dt_interval(F.lit(0), *parts)


def step_interval(step):
    return {"hour": F.expr("INTERVAL '1' HOUR"), "day": F.expr("INTERVAL '1' DAY")}[step]


def sequence_between(lo, hi, step="hour"):
    """Array of times from ``lo`` to ``hi``, both included."""
    return F.sequence(as_column(lo), as_column(hi), step_interval(step))


def sequence_after(last, periods, step="hour"):
    """Array of ``periods`` times, the first one step after ``last``."""
    last, one = as_column(last), step_interval(step)
    return F.sequence(last + one, last + one * F.lit(periods), one)


def date_text(c, fmt="yyyy-MM-dd"):
    return F.date_format(as_column(c), fmt)
