import os
from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from flowcast.session import shared_dir
from flowcast.sources import catalog, readers, writers
from flowcast.sources.audit import audit_copy
from flowcast.sources.staging import scratch_path, stage, staging

PRODUCT = "ProductID int, ProductName string, Category string, ListPrice double"


def test_csv_with_fixed_schema(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        'ProductID,ProductName,Category,ListPrice\n1,"Nut, hex",small,2.5\n2,,big,cheap\n')
    got = [tuple(r) for r in readers.read_csv(spark, str(tmp_path), PRODUCT).collect()]
    assert got == [(1, "Nut, hex", "small", 2.5), (2, None, "big", None)]
    assert dict(readers.read_csv(spark, str(tmp_path)).dtypes)["ProductID"] == "string"
    assert dict(readers.read_csv(spark, str(tmp_path), infer=True).dtypes)["ProductID"] == "int"


def test_csv_header_only(spark, tmp_path):
    (tmp_path / "p.csv").write_text("ProductID,ProductName,Category,ListPrice\n")
    assert readers.read_csv(spark, str(tmp_path), PRODUCT).count() == 0


def test_format_scan_ignores_foreign_options(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"a": 1}\n{"a": 2}\n')
    df = readers.read_format(spark, "json", str(tmp_path), inferSchema="false", header="false", sep=",")
    assert df.count() == 2


def test_multiline_json_inferred_and_array_root(spark, tmp_path):
    (tmp_path / "one.json").write_text('{\n "a": 1,\n "b": {"c": [1, 2]}\n}')
    (tmp_path / "two.json").write_text('[\n {"a": 2},\n {"a": 3}\n]')
    df = readers.read_json(spark, str(tmp_path), file_key="file")
    assert sorted((r.file, r.a) for r in df.collect()) == [("one", 1), ("two", 2), ("two", 3)]
    assert sorted(catalog.struct_fields(df, "b")) == ["c"]


def test_time_column(spark):
    named = spark.createDataFrame([(1, "2024-01-01 00:00:00")], "id int, timestamp string")
    assert readers.time_column(named) == "timestamp"
    first = spark.createDataFrame([("2024-01-01 05:00:00", 1)], "datetime string, id int")
    assert readers.with_event_time(first).first().event_time == datetime(2024, 1, 1, 5)
    with pytest.raises(TypeError):
        readers.time_column(spark.createDataFrame([(1,)], "id int"))


def test_compaction_follows_the_size(spark, tmp_path):
    df = spark.range(0, 10000, 1, 8)
    writers.write_parquet(df, str(tmp_path / "many"))
    many = readers.read_parquet(spark, str(tmp_path / "many"))
    writers.compact_parquet(many, str(tmp_path / "one"))
    assert len(readers.read_parquet(spark, str(tmp_path / "one")).inputFiles()) == 1
    size = sum(os.path.getsize(f.removeprefix("file://")) for f in many.inputFiles())
    writers.compact_parquet(many, str(tmp_path / "few"), target_bytes=size // 3, even=True)
    assert len(readers.read_parquet(spark, str(tmp_path / "few")).inputFiles()) in (3, 4)
    writers.write_csv(many, str(tmp_path / "csv"), files=1)
    assert readers.read_csv(spark, str(tmp_path / "csv")).count() == 10000


def test_audit_sees_changes(spark, tmp_path):
    df = spark.range(100).select("id", F.create_map(F.lit("k"), "id").alias("m"))
    path = str(tmp_path / "t")
    writers.write_parquet(df.repartition(3), path)
    good = audit_copy(df, readers.read_parquet(spark, path)).first()
    assert tuple(good) == (100, 100, 3, True, True)
    changed = df.withColumn("id", F.when(F.col("id") == 5, 6).otherwise(F.col("id")))
    assert audit_copy(changed, readers.read_parquet(spark, path)).first().content_equal is False
    fewer = audit_copy(df.limit(0), readers.read_parquet(spark, path)).first()
    assert (fewer.source_rows, fewer.content_equal) == (0, False)
    other = audit_copy(df.select(F.col("id").cast("int"), "m"), readers.read_parquet(spark, path))
    assert other.first().schema_equal is False


def test_tables_and_views(spark, tmp_path):
    df = spark.range(3)
    assert writers.save_table(df, "t_files", path=str(tmp_path / "t")).count() == 3
    with pytest.raises(Exception, match="already exists"):
        writers.save_table(df, "t_files", path=str(tmp_path / "t"))
    catalog.register_view(df, "2024-1 view")
    assert catalog.query_view(spark, "2024-1 view", where="id > 0").count() == 2


def test_schema_rows(spark):
    df = spark.createDataFrame([], "a int, s struct<x:array<struct<y:string>>>")
    got = [tuple(r) for r in catalog.schema_rows(df).collect()]
    assert [p for p, _ in got] == ["a", "s", "s.x", "s.x[].y"]


def test_staging_uses_the_named_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert stage(spark.range(5), "five").count() == 5


@pytest.mark.parametrize("zone", ["America/New_York", "UTC"])
def test_times_are_read_without_any_zone(spark, tmp_path, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        (tmp_path / "t.csv").write_text("ts,n\n2024-03-10 02:30:00,1\n2024-11-03 01:30:00,2\n")
        inferred = readers.read_csv(spark, str(tmp_path), infer=True)
        assert dict(inferred.dtypes) == {"ts": "timestamp_ntz", "n": "int"}
        assert [r.ts for r in inferred.orderBy("n").collect()] == [datetime(2024, 3, 10, 2, 30), datetime(2024, 11, 3, 1, 30)]
        rows = spark.createDataFrame([("2024-03-10 02:30:00",), ("10.03.2024",), (None,)], "timestamp string")
        for fmt in (None, "yyyy-MM-dd HH:mm:ss"):
            got = [r.event_time for r in readers.with_event_time(rows, fmt=fmt).collect()]
            assert got == [datetime(2024, 3, 10, 2, 30), None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_staged_tables_end_with_their_scope(spark):
    with staging(spark):
        kept = stage(spark.range(5), "kept")
        path = kept.inputFiles()[0].removeprefix("file://")
        table = writers.scratch_table(spark.range(3), "scoped_table", path=scratch_path(spark, "table"))
        with staging(spark):
            inner = stage(kept, "inner").inputFiles()[0].removeprefix("file://")
            assert os.path.exists(inner)
        assert not os.path.exists(inner) and kept.count() == 5 and table.count() == 3
    assert not os.path.exists(path) and not spark.catalog.tableExists("scoped_table")


def test_a_joined_frame_compacts_by_what_it_holds(spark, tmp_path):
    one = spark.range(2000).withColumn("k", F.col("id") % 5)
    joined = one.join(one.withColumnRenamed("id", "a"), "k").join(spark.range(5).withColumnRenamed("id", "k"), "k").limit(3000)
    writers.compact_parquet(joined, str(tmp_path / "j"), even=True)
    writers.write_csv(joined, str(tmp_path / "c"), compact=True, target_bytes=20000, even=True)
    assert len(spark.read.parquet(str(tmp_path / "j")).inputFiles()) == 1
    size = sum(f.stat().st_size for f in (tmp_path / "c").glob("*.csv"))
    assert abs(len(list((tmp_path / "c").glob("*.csv"))) - size / 20000) <= 1


@pytest.mark.parametrize("parts, rows", [(1, 3), (1, 6000), (7, 6000), (40, 40)])
def test_few_even_files_are_written_without_a_shuffle(spark, tmp_path, parts, rows):
    """The one task per file reads its share as compressed columns, not as the rows of a shuffle."""
    plans, write = [], DataFrameWriter.parquet
    df = spark.range(0, rows, 1, parts).select("id", F.create_map(F.lit("k"), "id").alias("m"), F.lit("x").alias("a b.c"))

    def seen(writer, path, *args, **how):
        plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return write(writer, path, *args, **how)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(DataFrameWriter, "parquet", seen)
        writers.compact_parquet(df, str(tmp_path / "even"), files=3, even=True)
    assert plans and not [p for p in plans if "Exchange" in p]
    copy = readers.read_parquet(spark, str(tmp_path / "even"))
    assert tuple(audit_copy(df, copy).first()) == (rows, rows, 3, True, True)
    sizes = [r["count"] for r in copy.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) - min(sizes) <= parts
    writers.write_csv(df.select("id"), str(tmp_path / "csv"), files=3, even=True)
    assert readers.read_csv(spark, str(tmp_path / "csv"), "id long").distinct().count() == rows


def test_no_rows_in_few_even_files(spark, tmp_path):
    writers.compact_parquet(spark.range(0), str(tmp_path / "none"), files=3, even=True)
    assert readers.read_parquet(spark, str(tmp_path / "none")).count() == 0


def test_compressed_json_is_written_in_files_of_bounded_documents(spark, tmp_path):
    df = spark.range(0, 1000, 1, 2).select("id", F.lit("text").alias("t"))
    writers.write_json(df, str(tmp_path / "z"), max_records=200, compression="gzip")
    files = sorted((tmp_path / "z").glob("*.json.gz"))
    assert len(files) == 6 and not list((tmp_path / "z").glob("*.json"))
    back = readers.read_json(spark, str(tmp_path / "z"), "id long, t string", multiline=False)
    assert max(r["count"] for r in back.groupBy(F.input_file_name()).count().collect()) <= 200
    assert sorted(r.id for r in back.collect()) == list(range(1000))
    writers.write_json(df, str(tmp_path / "plain"))
    assert len(list((tmp_path / "plain").glob("*.json"))) == 2


def test_documents_of_the_roundtrip_are_compressed(spark, tmp_path):
    from flowcast.queries import files
    spark.sql("""SELECT id AS l_orderkey, id AS l_partkey, id AS l_suppkey, 1 AS l_linenumber, 1.0D AS l_quantity, 0.0D AS l_discount,
        1.0D AS l_extendedprice, 'A' AS l_returnflag, 'F' AS l_linestatus, TIMESTAMP_NTZ '2024-01-30 00:00:00' AS l_shipdate FROM range(20)
        """).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT id AS o_orderkey, DATE '2024-01-30' AS o_orderdate, 'p' AS o_orderpriority FROM range(20)").write.parquet(f"{tmp_path}/orders.parquet")
    out = files.QUERIES["json_roundtrip"](spark, str(tmp_path))
    assert out.count() == 20 and all(f.endswith(".json.gz") for f in out.inputFiles())
