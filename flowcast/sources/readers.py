"""File scans: CSV, JSON, text, Parquet."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcast.functions.calendar import parse_timestamp


def read_csv(spark, path, schema=None, infer=False, header=True, mode="PERMISSIVE", **options):
    """CSV with a header: fixed ``schema``, all strings, or inferred types.

    A schema or all-string read starts no job; ``infer=True`` costs one pass more. Inferred
    times are read zone-free, so the session's zone does not shift them.
    """
    reader = spark.read.options(header=header, mode=mode, **options)
    if schema is not None:
        return reader.schema(schema).csv(path)
    if not infer:
        return reader.csv(path)
    found = reader.option("inferSchema", True).csv(path).schema
    zone_free = [T.StructField(f.name, T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType) else f.dataType)
                 for f in found.fields]
    return reader.schema(T.StructType(zone_free)).csv(path)


def read_format(spark, fmt, path, schema=None, **options):
    """Scan by format name; options the format does not know are ignored by it."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_json(spark, path, schema=None, multiline=True, file_key=None):
    """JSON documents, one object or array per file, or one per line.

    Without a schema Spark scans all files to infer one, and keys no document has
    are missing from it. ``file_key`` names a column for the file's base name.
    """
    reader = spark.read.option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(path)
    if file_key:
        name = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
        df = df.select("*", name.alias(file_key))
    return df


def read_text(spark, path, whole=True):
    """Text as column ``value``: one row per file, or one row per line."""
    return spark.read.text(path, wholetext=whole)


def read_parquet(spark, *paths, schema=None):
    """Parquet file or multi-part directory."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def read_table(spark, folder, name):
    """One table of a data folder that holds ``<name>.parquet`` per table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def time_column(df, preferred="timestamp"):
    """Name of the time column: ``preferred`` if present, else the first column."""
    name = preferred if preferred in df.columns else df.columns[0]
    kind = df.schema[name].dataType
    allowed = (T.StringType, T.TimestampType, T.TimestampNTZType, T.DateType)
    if not isinstance(kind, allowed):
        raise TypeError(f"column {name!r} is {kind.simpleString()}, not a time or text")
    return name


def with_event_time(df, preferred="timestamp", out="event_time", fmt=None):
    """Add ``out``: the picked time column as a zone-free timestamp, NULL if unreadable."""
    return df.withColumn(out, parse_timestamp(time_column(df, preferred), fmt))
