"""Write a supplied table in some format, read it back, and query the copy."""

import uuid

from pyspark.sql import functions as F

from flowcast.functions.calendar import parse_timestamp
from flowcast.operators import match as mt
from flowcast.operators.hourly import hourly_counts
from flowcast.queries import documents as docs
from flowcast.queries.nesting import DELIVERIES
from flowcast.queries.registry import registrar
from flowcast.sources import catalog, readers, writers
from flowcast.sources.audit import audit_copy
from flowcast.sources.audit import audit_differences as differences
from flowcast.sources.readers import read_table
from flowcast.sources.staging import scratch_path

QUERIES, ORACLES, query = registrar()

# The product file.
PRODUCT = "ProductID int, ProductName string, Category string, ListPrice double"


def _products(spark, sf):
    return read_table(spark, sf, "part").select(
        F.col("p_partkey").cast("int").alias("ProductID"), F.col("p_name").alias("ProductName"),
        F.col("p_type").alias("Category"), F.col("p_retailprice").alias("ListPrice"))


@query("""SELECT CAST(p_partkey AS INTEGER) AS "ProductID", p_name AS "ProductName", p_type AS "Category",
p_retailprice AS "ListPrice" FROM part""")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "products")
    writers.write_csv(_products(spark, sf), path, compact=True)
    return readers.read_csv(spark, path, PRODUCT)


@query(f"""SELECT * REPLACE (CAST("Over" AS VARCHAR) AS "Over", CAST("Runs_Batter" AS VARCHAR) AS "Runs_Batter",
CAST("Runs_Extras" AS VARCHAR) AS "Runs_Extras", CAST("Runs_Total" AS VARCHAR) AS "Runs_Total")
FROM ({DELIVERIES})""")
def csv_all_strings(spark, sf):
    path = scratch_path(spark, "deliveries")
    writers.write_csv(mt.ball_by_ball(docs.innings_documents(spark, sf)), path)
    return readers.read_csv(spark, path)


@query("""SELECT date_trunc('hour', ts) AS ts_hour, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def csv_inferred_counts(spark, sf):
    path = scratch_path(spark, "movements")
    rows = read_table(spark, sf, "events").select("ts", "event_type")
    writers.write_csv(rows, path)
    timed = readers.with_event_time(readers.read_csv(spark, path, infer=True), "timestamp")
    return hourly_counts(timed, "event_time", ["event_type"])


@query("SELECT * FROM supplier")
def format_scan(spark, sf):
    return readers.read_format(spark, "parquet", f"{sf}/supplier.parquet",
                               inferSchema="false", header="false", sep=",")


@query(DELIVERIES)
def json_roundtrip(spark, sf):
    path = scratch_path(spark, "documents")
    writers.write_json(docs.innings_documents(spark, sf), path, compression="gzip")
    schema = "match_id string, " + mt.MATCH_SCHEMA
    return mt.ball_by_ball(readers.read_json(spark, path, schema, multiline=False))


@query("SELECT * FROM lineitem")
def parquet_compact(spark, sf):
    path = scratch_path(spark, "compact")
    writers.compact_parquet(read_table(spark, sf, "lineitem"), path)
    return readers.read_parquet(spark, path)


@query("SELECT * FROM orders")
def table_roundtrip(spark, sf):
    name = "orders_copy_" + uuid.uuid4().hex
    return writers.scratch_table(read_table(spark, sf, "orders"), name,
                                 path=scratch_path(spark, "table"))


@query("SELECT * FROM events")
def sql_view(spark, sf):
    name = "events-1_json"
    catalog.register_view(read_table(spark, sf, "events"), name)
    return catalog.query_view(spark, name)


@query("""SELECT count(*) AS source_rows, count(*) AS copy_rows, CAST(3 AS BIGINT) AS copy_files,
true AS schema_equal, true AS content_equal FROM lineitem""")
def write_audit(spark, sf):
    source, path = read_table(spark, sf, "lineitem"), scratch_path(spark, "audited")
    writers.compact_parquet(source, path, files=3, even=True)
    return audit_copy(source, readers.read_parquet(spark, path))


@query("SELECT * FROM orders")
def parquet_overwrite(spark, sf):
    """The plain sink: a second write replaces the first."""
    path, rows = scratch_path(spark, "plain"), read_table(spark, sf, "orders")
    writers.write_parquet(rows.filter("o_orderstatus = 'F'"), path)
    writers.write_parquet(rows, path)
    return readers.read_parquet(spark, path)


@query("""SELECT CAST(p_partkey AS INTEGER) AS "ProductID", p_name AS "ProductName", p_type AS "Category",
p_retailprice AS "ListPrice" FROM part""")
def csv_by_format(spark, sf):
    """The scan by format name, with a separator and a schema."""
    path = scratch_path(spark, "by-format")
    writers.write_csv(_products(spark, sf), path, sep=";")
    return readers.read_format(spark, "csv", path, PRODUCT, header="true", sep=";")


@query("""SELECT date_trunc('day', o_orderdate) AS event_time, count(*) AS n FROM orders GROUP BY 1""")
def time_by_name(spark, sf):
    """The time column found by its name, not its place."""
    rows = read_table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("timestamp"))
    path = scratch_path(spark, "named")
    writers.write_csv(rows, path)
    timed = readers.with_event_time(readers.read_csv(spark, path))
    return timed.groupBy("event_time").agg(F.count("*").alias("n"))


@query("""SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN ts END AS at FROM
(SELECT event_id, date_trunc('second', ts) AS ts FROM events)""")
def parse_timestamps(spark, sf):
    """Texts in a given format, some of them unreadable, to zone-free times."""
    rows = read_table(spark, sf, "events").select("event_id", F.date_format("ts", "dd.MM.yyyy HH:mm:ss").alias("text"))
    bad = rows.withColumn("text", F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("no time "), "text")).otherwise(F.col("text")))
    return bad.select("event_id", parse_timestamp("text", "dd.MM.yyyy HH:mm:ss").alias("at"))


KINDS = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double",
         "props": "string"}


@query(" UNION ALL ".join(f"SELECT '{c}' AS path, '{kind}' AS type, count({c}) AS n_values FROM events" for c, kind in KINDS.items()))
def schema_rows(spark, sf):
    """The columns of a table as rows, with how many values each holds."""
    rows = read_table(spark, sf, "events")
    counts = rows.agg(*[F.count(c).alias(c) for c in rows.columns])
    counted = counts.unpivot([], rows.columns, "path", "n_values")
    return catalog.schema_rows(rows).join(counted, "path")


@query("""WITH k AS (SELECT l_orderkey AS o, l_linenumber AS l, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT o AS l_orderkey, l AS l_linenumber, CASE WHEN o % 97 = 0 THEN 'missing' WHEN o % 89 = 0 THEN 'changed'
  ELSE 'repeated' END AS kind, n AS source_rows, CASE WHEN o % 97 = 0 THEN 0 WHEN o % 89 = 0 THEN n ELSE 2 * n END AS copy_rows
FROM k WHERE o % 97 = 0 OR o % 89 = 0 OR o % 83 = 0
UNION ALL SELECT -o, l, 'added', 0, n FROM k WHERE o % 79 = 0 AND o <> 0""")
def audit_differences(spark, sf):
    """A copy with missing, changed, repeated and added rows, compared by hash trees."""
    source, path = read_table(spark, sf, "lineitem"), scratch_path(spark, "differing")
    key = F.col("l_orderkey")
    kept = source.filter(key % 97 != 0)
    quantity = F.when(key % 89 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    changed = kept.withColumn("l_quantity", quantity.cast(source.schema["l_quantity"].dataType))
    repeated = kept.filter((key % 83 == 0) & (key % 89 != 0))
    added = source.filter((key % 79 == 0) & (key != 0)).withColumn("l_orderkey", -key)
    writers.write_parquet(changed.unionByName(repeated).unionByName(added), path)
    return differences(source, readers.read_parquet(spark, path), ["l_orderkey", "l_linenumber"])
