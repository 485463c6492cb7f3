"""Hourly weight profiles and exact allocation of daily totals."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcast.functions.calendar import as_column, time_on
from flowcast.session import shuffle_partitions

EXPAND_CHUNK = 65_536
PLACES = 9


def normalise(profile, weight, by=(), out="share"):
    """Weights divided by their sum, per profile; without ``by``, over the whole table."""
    if by:
        total = F.sum(weight).over(Window.partitionBy(*by))
    else:
        total = profile.agg(F.sum(weight)).scalar()
    return profile.select("*", F.try_divide(as_column(weight), total).alias(out))


def scale_totals(daily, total, factor, out="scaled", precision=17, scale=9):
    """Whole part of ``total * factor``, by exact decimals.

    A decimal factor keeps its own type; any other is read as decimal(precision, scale).
    """
    factor = as_column(factor)
    if not isinstance(daily.select(factor).schema[0].dataType, T.DecimalType):
        factor = factor.cast(f"decimal({precision},{scale})")
    return daily.select("*", F.floor(as_column(total).cast("decimal(20,0)") * factor).cast("bigint").alias(out))


def allocate(daily, keys, total, profile, hour="hour", weight="weight", out="allocated", without_weights="even"):
    """Split each daily total over the 24 hours of day; the parts sum to the total.

    Largest remainder in whole numbers: every hour gets the floor of its share, then
    the hours with the largest remainders one more each, earlier hours first. Hours the
    profile lacks have weight 0; hours out of 0 to 23 are an error. If all weights are 0, or the profile is empty, totals are
    spread evenly, or with ``without_weights="error"`` the job fails with a clear message.
    Weights may be whole numbers, decimals, which keep their places, or doubles, of which nine places count; they need not sum
    to 1. They are summed per hour of day, so 24 rows at most are broadcast, whatever ``profile`` holds. Products are
    decimals of whole numbers and cannot overflow.
    """
    keys = list(keys)
    hours = daily.select(*keys, total, F.explode(F.sequence(F.lit(0), F.lit(23))).alias(hour))
    if without_weights not in ("even", "error"):
        raise ValueError(f"without_weights must be 'even' or 'error', not {without_weights!r}")
    kind = profile.schema[weight].dataType
    places = kind.scale if isinstance(kind, T.DecimalType) else PLACES if isinstance(kind, (T.FloatType, T.DoubleType)) else 0
    number = F.when(F.col(hour).between(0, 23), F.col(hour)).otherwise(
        F.raise_error(F.concat(F.lit("the profile has an hour out of 0 to 23: "), F.coalesce(F.col(hour).cast("string"), F.lit("NULL")))))
    given = profile.groupBy(number.cast("int").alias(hour)).agg(
        (F.sum(F.col(weight).cast(f"decimal({18 + places},{places})")) * F.lit(10 ** places)).cast("decimal(18,0)").alias("_w"))
    clock = daily.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(23))).alias(hour))
    weights = clock.join(given, hour, "left").select(hour, F.coalesce("_w", F.lit(0)).cast("decimal(18,0)").alias("_w"))
    weights = weights.withColumn("_all", F.sum("_w").over(Window.partitionBy()).cast("decimal(18,0)"))
    none = F.col("_all") == 0
    if without_weights == "error":
        weights = weights.withColumn("_all", F.when(none, F.raise_error(F.lit("the profile has no weight above 0"))
                                                    .cast("decimal(18,0)")).otherwise(F.col("_all")))
    else:
        weights = weights.select(hour, *[F.when(none, F.lit(n)).otherwise(F.col(c)).cast("decimal(18,0)").alias(c)
                                         for c, n in (("_w", 1), ("_all", 24))])
    rows = hours.join(F.broadcast(weights), hour)
    product = F.col(total).cast("decimal(19,0)") * F.col("_w")
    rows = rows.withColumn("_product", product).withColumns({
        "_base": F.expr("_product div _all"),
        "_rest": F.expr("_product % _all"),
    })
    day = Window.partitionBy(*keys)
    rank = F.row_number().over(day.orderBy(F.col("_rest").desc(), hour))
    spare = F.col(total) - F.sum("_base").over(day)
    share = F.col("_base") + F.when(rank <= spare, 1).otherwise(0)
    return rows.select(*keys, hour, share.cast("bigint").alias(out))


def expand_counts(df, n, out="copy", chunk=EXPAND_CHUNK):
    """Repeat each row ``n`` times, numbered from 1; rows with n < 1 vanish.

    A count is first cut into chunks, and the chunks are spread over the tasks before
    they are expanded, so one very large count neither builds a huge array nor runs in
    one task.
    """
    rest = F.col(n) - F.lit(1)
    starts = F.sequence(F.lit(0).cast("bigint"), F.floor(rest / F.lit(chunk)).cast("bigint"))
    parts = df.filter(F.col(n) > 0).select("*", F.explode(starts).alias("_chunk"))
    tasks = shuffle_partitions(df.sparkSession)
    spread = parts.repartition(tasks, *df.columns, "_chunk")
    first = F.col("_chunk") * F.lit(chunk) + F.lit(1)
    last = F.least(F.col(n).cast("bigint"), (F.col("_chunk") + F.lit(1)) * F.lit(chunk))
    return spread.select(*df.columns, F.explode(F.sequence(first, last)).alias(out))


def as_movements(allocated, day, hour, n, ts="ts"):
    """Expand allocated counts to one row per movement, timed at the start of its hour."""
    timed = allocated.withColumn(ts, time_on(day, F.col(hour)))
    return expand_counts(timed, n)
