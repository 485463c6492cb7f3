"""Lags, trailing means and row numbers."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcast.functions.calendar import as_column
from flowcast.functions.numeric import filled
from flowcast.session import shuffle_partitions
from flowcast.sources.staging import stage

BUCKET_ROWS = 1 << 16
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def by_series(keys, ts):
    """The one window all lag features share: a series in time order.

    Series are hourly aggregates, so a window partition is bounded by the hours of
    the period, not by the events of a hot key.
    """
    return Window.partitionBy(*keys).orderBy(ts)


def _warm(column, warmup):
    return filled(column, 0.0) if warmup == "zero" else column


def add_lags(df, keys, ts, y, lags, warmup="null"):
    """Value ``k`` rows back, for ``lags`` = {name: k}; on a gap-free grid, k steps."""
    order = by_series(keys, ts)
    return df.select(
        "*", *[_warm(F.lag(y, k).over(order).cast("double"), warmup).alias(name)
               for name, k in lags.items()]
    )


def add_trailing_means(df, keys, ts, y, windows, warmup="null"):
    """Mean of the ``k`` rows before the current one, for ``windows`` = {name: k}.

    NULL until k values exist. Constant work per row whatever k is, where a sliding frame would add k values per row:
    whole numbers go through running sums, exactly, others through sums within blocks (``_block_means``).
    """
    order = by_series(keys, ts)
    if not isinstance(df.schema[y].dataType, INTEGRAL):
        return _block_means(df, keys, order, y, windows, warmup)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = df.select(
        "*",
        filled(F.sum(y).over(running)).alias("_sum"),
        F.count(y).over(running).alias("_count"),
    )

    def before(column, k):
        return filled(F.lag(column, k).over(order))

    columns = []
    for name, k in windows.items():
        total = before("_sum", 1) - before("_sum", k + 1)
        count = before("_count", 1) - before("_count", k + 1)
        columns.append(_warm(F.when(count == k, total / F.lit(k)), warmup).alias(name))
    return summed.select(*df.columns, *columns)


def _block_means(df, keys, order, y, windows, warmup):
    """Trailing means of doubles from prefix and suffix sums within blocks of ``k`` rows.

    The k rows before a row are the end of one block and the start of the next: one suffix and one prefix sum. Nothing is
    ever subtracted, so a huge value, NaN or infinity touches only the windows that hold it.
    """
    rows = df.select(
        "*", (F.row_number().over(order) - 1).alias("_row"), F.col(y).cast("double").alias("_y"),
        F.count(y).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_count"))
    columns = []
    for i, (name, k) in enumerate(windows.items()):
        block = Window.partitionBy(*keys, F.floor(F.col("_row") / F.lit(k)))
        so_far = (Window.unboundedPreceding, Window.currentRow)
        rows = rows.select(
            "*", filled(F.sum("_y").over(block.orderBy("_row").rowsBetween(*so_far)), 0.0).alias(f"_head{i}"),
            filled(F.sum("_y").over(block.orderBy(F.desc("_row")).rowsBetween(*so_far)), 0.0).alias(f"_tail{i}"))
        series = Window.partitionBy(*keys).orderBy("_row")
        head, tail = F.lag(f"_head{i}", 1).over(series), F.lag(f"_tail{i}", k).over(series)
        count = F.lag("_count", 1).over(series) - filled(F.lag("_count", k + 1).over(series))
        total = F.when(F.col("_row") % F.lit(k) == 0, head).otherwise(tail + head)
        columns.append(_warm(F.when(count == k, total / F.lit(k)), warmup).alias(name))
    return rows.select(*df.columns, *columns)


def global_row_index(df, order, name="row_index", start=1, running=None, parts=None):
    """Consecutive numbers over the whole table in ``order``, without one big task.

    ``order`` should be unique per row. Rows are range partitioned, sorted in place
    and staged once with their position in the partition; only one row of totals per
    partition is summed up in order. ``running`` = {name: whole-number column} adds
    running sums over the table, the current row included. ``parts`` is the number of
    range partitions, by default the session's shuffle setting.
    """
    running = dict(running or {})
    placed = (
        df.repartitionByRange(parts or shuffle_partitions(df.sparkSession), *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = stage(placed, "row-index")
    part = F.shiftright("_place", 33)
    position = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    totals = placed.groupBy(part.alias("_part")).agg(
        F.count("*").alias("_size"),
        *[filled(F.sum(column)).alias("_all_" + out) for out, column in running.items()],
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part", filled(F.sum("_size").over(before)).alias("_offset"),
        *[filled(F.sum("_all_" + out).over(before)).alias("_all_" + out) for out in running],
    )
    # One row per range partition: bounded by spark.sql.shuffle.partitions.
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    within = Window.partitionBy("_part").orderBy("_place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return numbered.select(
        *df.columns, (F.col("_offset") + position + F.lit(start)).cast("bigint").alias(name),
        *[(F.col("_all_" + out) + filled(F.sum(column).over(within))).alias(out)
          for out, column in running.items()],
    )


def add_history_in_table_order(df, order, y, lags, means=None, index="row_index", bucket=BUCKET_ROWS):
    """Lags and trailing means over the rows of the whole table, whatever their series.

    A keyless window would pull every row into one task. The rows are numbered in
    parallel instead and cut into buckets of consecutive numbers; a bucket also gets a copy of
    the last rows before it, as many as the longest lag needs, so one shuffle by bucket
    serves all lags and means. ``y`` holds whole numbers, without NULLs.
    """
    means = dict(means or {})
    reach = max([1, *lags.values(), *means.values()])
    bucket = max(bucket, reach)
    number = F.col(index) - F.lit(1)
    own = F.floor(number / F.lit(bucket)).cast("bigint")
    tail = number % F.lit(bucket) >= F.lit(bucket - reach)
    near = F.when(tail, F.array(own, own + F.lit(1))).otherwise(F.array(own))
    rows = global_row_index(df, order, index).select("*", own.alias("_own"), F.explode(near).alias("_bucket"))
    here = Window.partitionBy("_bucket").orderBy(index)
    total = F.sum(y).over(here.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.select("*", total.alias("_sum"))

    def mean(k):
        since = F.lag("_sum", 1).over(here) - filled(F.lag("_sum", k + 1).over(here))
        return F.when(F.col(index) > F.lit(k), since / F.lit(k))

    out = rows.select(
        "*", *[F.lag(y, k).over(here).alias(name) for name, k in lags.items()],
        *[mean(k).alias(name) for name, k in means.items()])
    return out.filter(F.col("_own") == F.col("_bucket")).drop("_own", "_bucket", "_sum", index)


def sequence_ids(df, order, name="seq_id"):
    """Running id from 1 in the given order."""
    return global_row_index(df, order, name, 1)


def top_rows(df, by, n=10):
    """First ``n`` rows in the given order; each task keeps only its own best ``n``."""
    return df.orderBy(*by).limit(n)


def first_rows(df, n=5):
    return df.limit(n)


def last_rows_split(df, keys, ts, n, segment="segment"):
    """Tag the last ``n`` rows of each series "test", the rest "train"."""
    order = by_series(keys, as_column(ts))
    behind = F.count("*").over(Window.partitionBy(*keys)) - F.row_number().over(order)
    tag = F.when(behind < n, "test").otherwise("train")
    return df.select("*", tag.alias(segment))
