"""File and table sinks."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowcast.sources.staging import on_release, scratch_path

MIB = 1024 * 1024
#: So many files at most are dealt out through a staged copy; each of more holds a small share of the rows.
FEW_FILES = 16


def write_parquet(df, path, mode="overwrite", partition_by=()):
    """One file per task, no shuffle."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def _measured(df, target_bytes, size):
    """A staged copy of ``df`` and how many files of ``target_bytes`` its measured size fills."""
    path = scratch_path(df.sparkSession, "compact")
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    return staged, max(1, -(-(size(staged, path) or 0) // target_bytes))


def _parquet_bytes(staged, path):
    files = staged.sparkSession.read.format("binaryFile").load(path)
    return files.agg(F.sum("length")).first()[0]


def _csv_bytes(staged, path):
    line = F.to_csv(F.struct("*"))
    return staged.agg(F.sum(F.octet_length(line).cast("bigint") + 1)).first()[0]


def _spread(df, files, even):
    return df.repartition(files) if even else df.coalesce(files)


def _dealt(df, files):
    """``files`` partitions of about equally many rows, each read from a compressed columnar copy.

    The task that writes one of few large files must read all its rows. As compressed columns they are far fewer
    bytes than as rows of a shuffle, and the steps before stay parallel. A share is a scan of its own, so small
    ones are not packed into one partition.
    """
    if files > FEW_FILES:
        return df.repartition(files)
    number, path = "file-" + uuid.uuid4().hex, scratch_path(df.sparkSession, "dealt")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(2 ** 33 - 1))
    dealt = df.select("*", F.pmod(place + F.spark_partition_id(), F.lit(files)).cast("int").alias(number))
    dealt.write.partitionBy(number).option("compression", "zstd").parquet(path)
    staged = df.sparkSession.read.schema(dealt.schema).parquet(path)
    shares = [staged.filter(F.col(quoted(number)) == i).drop(number) for i in range(files)]
    return reduce(DataFrame.union, shares).coalesce(files)


def compact_parquet(df, path, files=None, target_bytes=128 * MIB, even=False, mode="overwrite"):
    """Rewrite as few files of about ``target_bytes``: one file when the data is small.

    Without ``files`` the rows are staged once and their files' lengths summed up, so the count
    follows what was written and no estimate steers it. ``coalesce`` needs no shuffle;
    ``even=True`` deals the rows out, for files of equal size, or where ``files`` is given
    and the steps before it must stay parallel.
    """
    if files and even:
        df = _dealt(df, files)
    else:
        if not files:
            df, files = _measured(df, target_bytes, _parquet_bytes)
        df = _spread(df, files, even)
    df.write.mode(mode).parquet(path)


def write_csv(df, path, header=True, compact=False, files=None, target_bytes=128 * MIB,
              even=False, mode="overwrite", **options):
    """CSV with a header; ``compact`` writes as few files as the text's size allows."""
    if files and even:
        df = _dealt(df, files)
    else:
        if compact and not files:
            df, files = _measured(df, target_bytes, _csv_bytes)
        if files:
            df = _spread(df, files, even)
    df.write.mode(mode).options(header=header, **options).csv(path)


def write_json(df, path, mode="overwrite", max_records=65536, **options):
    """JSON, one document per line, so the files stay splittable.

    Compressed files (``compression="gzip"``) are not; they hold at most ``max_records`` documents each instead.
    """
    if options.get("compression", "none") != "none":
        options = {"maxRecordsPerFile": max_records, **options}
    df.write.mode(mode).options(**options).json(path)


def save_table(df, name, fmt="parquet", mode="error", path=None, partition_by=()):
    """Catalog table; ``path`` makes it external. ``mode`` is Spark's own default."""
    writer = df.write.format(fmt).mode(mode)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(quoted(name) if "." not in name else name)


def scratch_table(df, name, **how):
    """Catalog table for the length of the open staging scope, which drops it."""
    spark = df.sparkSession
    on_release(lambda: spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}"))
    return save_table(df, name, **how)


def quoted(name):
    """Back-quoted identifier, for names with spaces, dashes or a leading digit."""
    return "`" + name.replace("`", "``") + "`"
