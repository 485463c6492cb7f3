"""Movements to hourly and daily series."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcast.functions.calendar import (day_bucket, hour_bucket, sequence_between,
                                         step_interval)
from flowcast.functions.numeric import filled, row_total
from flowcast.session import shuffle_partitions

STAND_IN = "1970-01-01 00:00:00"
GAP_CHUNK = 4096  # steps of a gap that one array holds


def with_hour(df, ts, hour="ts_hour"):
    """Add the start of the hour; NULL where the time is.

    For zone-free times this is a tumbling window's start, plain arithmetic on the
    epoch and several times cheaper per row than calendar functions. The window would
    drop NULL times, so they pass through it under a stand-in.
    """
    if not isinstance(df.select(ts).schema[0].dataType, T.TimestampNTZType):
        return df.withColumn(hour, hour_bucket(ts))
    known = F.coalesce(F.col(ts), F.lit(STAND_IN).cast("timestamp_ntz"))
    start = F.window(known, "1 hour").getField("start")
    return df.withColumn(hour, F.when(F.col(ts).isNotNull(), start))


def hourly_counts(df, ts, keys=(), hour="ts_hour", n="n"):
    """Rows per hour and key. Partial counts are taken before the shuffle."""
    return with_hour(df, ts, hour).groupBy(hour, *keys).agg(F.count("*").alias(n))


def hourly_pivot(df, ts, column, values=None, keys=(), hour="ts_hour", total="total"):
    """Hourly counts with one column per value of ``column`` and their row total.

    Give ``values``; without them one extra job looks them up, and Spark's own
    limit on pivot columns applies.
    """
    grouped = with_hour(df, ts, hour).groupBy(hour, *keys)
    wide = grouped.pivot(column, list(values)) if values else grouped.pivot(column)
    wide = wide.agg(F.count(F.lit(1)))
    columns = [c for c in wide.columns if c not in (hour, *keys)]
    wide = wide.na.fill(0, columns)
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in columns]
    return wide.withColumn(total, row_total(quoted))


def span(counts, ts, n):
    """Scalar ``struct(lo, hi, events)`` over all series.

    The event total is part of it so that this small aggregate reads all columns of
    ``counts``: its plan then equals the main branch and the shuffle is reused, and
    the events are scanned once.
    """
    return counts.agg(
        F.struct(
            F.min(ts).alias("lo"), F.max(ts).alias("hi"), F.sum(n).alias("events")
        ).alias("span")
    ).scalar()


def _stretched(df, first, last, ts, step, keep):
    """One row per step from ``first`` to ``last``, long stretches in chunks of bounded arrays."""
    length = step_interval(step) * F.lit(GAP_CHUNK)
    chunks = df.select("*", F.explode(F.sequence(first, last, length)).alias("_from"), last.alias("_last"))
    until = F.least(F.col("_from") + length - step_interval(step), F.col("_last"))
    return chunks.select(*keep, F.explode(sequence_between("_from", until, step)).alias(ts))


def _filled(counts, ts, keys, values, step, bounds):
    """Gap-free series: absent steps appear with value 0.

    Each row is stretched to just before the next row of its series, so no spine
    table, no join and no list of keys is needed: one shuffle by series, which the
    lag and rolling windows that follow use again. ``bounds="global"`` runs every
    series from the first to the last step of all; ``"series"`` over its own.
    """
    keys, values = list(keys), list(values)
    if not keys:
        return on_spine(counts, ts, values, step)
    order = Window.partitionBy(*keys).orderBy(ts)
    # By number: the rows are few before they are stretched, and must stay spread.
    spread = counts.repartition(shuffle_partitions(counts.sparkSession), *keys)
    marked = spread.select(
        *keys,
        F.col(ts).alias("_at"),
        *values,
        F.lag(ts).over(order).isNull().alias("_first"),
        F.lead(ts).over(order).alias("_next"),
    )
    if bounds == "global":
        marked = marked.withColumn("_span", span(counts, ts, values[0]))
        first = F.when(F.col("_first"), F.col("_span.lo")).otherwise(F.col("_at"))
        last = F.coalesce(F.col("_next") - step_interval(step), F.col("_span.hi"))
    elif bounds == "series":
        first = F.col("_at")
        last = F.coalesce(F.col("_next") - step_interval(step), F.col("_at"))
    else:
        raise ValueError(f"bounds must be 'global' or 'series', not {bounds!r}")
    stretched = _stretched(marked, first, last, ts, step, [*keys, "_at", *values])
    here = F.col(ts) == F.col("_at")
    return stretched.select(
        ts, *keys, *[F.when(here, filled(v)).otherwise(F.lit(0)).alias(v) for v in values]
    )


def spine(spark, lo, hi, ts, step="hour"):
    """One row per step from ``lo`` to ``hi`` (columns or scalars), none if NULL."""
    return spark.range(1).select(F.explode(sequence_between(lo, hi, step)).alias(ts))


def align(frame, rows, on, values, fill=0):
    """Left join on an index frame; values it lacks become ``fill``."""
    joined = frame.join(rows, list(on), "left")
    return joined.select(*frame.columns, *[filled(v, fill).alias(v) for v in values])


def pair(left, right, keys, ts, how="left"):
    """Join two tables of a series on key and time; a NULL key is a series as well."""
    names = [*keys, ts]
    other = right.select(*[F.col(c).alias("_" + c) if c in names else F.col(c)
                           for c in right.columns])
    same = [F.col(k).eqNullSafe(F.col("_" + k)) for k in keys]
    joined = left.join(other, [*same, F.col(ts) == F.col("_" + ts)], how)
    return joined.drop(*["_" + c for c in names])


def on_spine(counts, ts, values, step="hour"):
    """One keyless series, aligned on its full index."""
    edge = span(counts, ts, values[0])
    index = spine(counts.sparkSession, edge["lo"], edge["hi"], ts, step)
    return align(index, counts, [ts], values)


def hourly_grid(df, ts, keys=(), hour="ts_hour", n="n", bounds="global"):
    """Gap-free hourly counts per series; events without a time belong to no hour."""
    timed = df.filter(F.col(ts).isNotNull())
    return _filled(hourly_counts(timed, ts, keys, hour, n), hour, keys, [n], "hour", bounds)


def daily_sums(df, ts, values, keys=(), day="day", bounds="global"):
    """Sums per day and key; days without rows, and all-NULL days, give 0."""
    sums = df.filter(F.col(ts).isNotNull()).groupBy(day_bucket(ts).alias(day), *keys).agg(
        *[filled(F.sum(v)).alias(v) for v in values]
    )
    return _filled(sums, day, keys, values, "day", bounds)


def hour_of_day_means(df, ts, values, keys=(), hour="hour"):
    """Mean of each value per hour of day."""
    return df.groupBy(*keys, F.hour(ts).alias(hour)).agg(*[F.avg(v).alias(v) for v in values])


def series_bounds(df, ts, keys=(), value=None, tie=None):
    """First and last time, row count and last value per series, in one pass."""
    aggregates = [F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
                  F.count("*").alias("n_rows")]
    if value:
        order = F.struct(ts, tie) if tie else F.col(ts)
        aggregates.append(F.max_by(value, order).alias("last_value"))
    return df.groupBy(*keys).agg(*aggregates)


def series_keys(df, keys):
    """The distinct keys, one row each."""
    return df.select(*keys).distinct()
