import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from flowcast.operators import nested as nt

RECORD = ("name string, age int, address struct<street:string, city:string>, "
          "items array<struct<id:int, value:string>>, details map<string,string>")
DOC = {"name": "a", "age": 3, "address": {"street": "s", "city": "c"},
       "items": [{"id": 1, "value": "x"}, {"id": 2, "value": "y"}], "details": {"k": "v"}}


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture
def write(tmp_path):
    def put(**texts):
        for name, text in texts.items():
            (tmp_path / f"{name}.json").write_text(text)
        return str(tmp_path)
    return put


def test_pretty_printed_object(spark, write):
    path = write(one=json.dumps(DOC, indent=2))
    df = nt.process_nested_json(spark, path, RECORD)
    assert rows(df, "name", "age", "address.city", F.size("items"), "details", nt.CORRUPT) == [
        ("a", 3, "c", 2, {"k": "v"}, None)]


def test_root_array_and_missing_items(spark, write):
    second = {k: v for k, v in DOC.items() if k != "items"} | {"name": "b"}
    path = write(two=json.dumps([DOC, second], indent=2), none="[]")
    schema = f"array<struct<{RECORD.replace(' string', ':string').replace(' int', ':int').replace('address ', 'address:').replace('items ', 'items:').replace('details ', 'details:')}>>"
    df = nt.process_nested_json(spark, path, schema)
    assert rows(df, "name", F.col("items").isNull()) == [("a", False), ("b", True)]


@pytest.mark.parametrize("schema", ["struct<name:string>", "array<struct<name:string>>"])
def test_malformed_text_is_kept(spark, write, schema):
    path = write(good='{"name": "a"}', bad='{"name": ')
    df = nt.process_nested_json(spark, path, schema)
    assert rows(df, "name", nt.CORRUPT) == [("a", None), (None, '{"name": ')]


def test_one_document_per_line(spark, write):
    path = write(lines="\n".join(json.dumps({"name": n}) for n in "ab"))
    df = nt.process_nested_json(spark, path, "struct<name:string>", whole=False)
    assert rows(df, "name") == [("a",), ("b",)]


def test_flatten(spark, write):
    path = write(one=json.dumps(DOC))
    flat = nt.process_nested_json(spark, path, RECORD, flat=True)
    assert {"address_street", "address_city", "items", "details"} <= set(flat.columns)
    deep = nt.process_nested_json(spark, path, RECORD, flat=True, explode_arrays=True)
    assert rows(deep, "name", "items_id", "items_value") == [("a", 1, "x"), ("a", 2, "y")]


def test_flatten_keeps_rows_with_empty_arrays(spark):
    df = spark.createDataFrame([(1, []), (2, [7]), (3, None)], "i int, a array<int>")
    assert rows(nt.flatten(df, True), "i", "a") == [(1, None), (2, 7), (3, None)]


def test_paths(spark):
    df = spark.createDataFrame(
        [((["x"], [(1, "p"), (2, "q")], ("NH",)),)],
        "info struct<dates:array<string>, w:array<struct<a:int,b:string>>, "
        "players:struct<`North Hill`:string>>")
    out = nt.project(df, {"d": "info.dates[0]", "none": "info.dates[5]", "arr": "info.w.b",
                          "first": "info.w[0].b", "nh": "info.players.North Hill",
                          "nh2": ("info", "players", "North Hill")})
    assert tuple(out.first()) == ("x", None, ["p", "q"], "p", "NH", "NH")
    with pytest.raises(AnalysisException):
        nt.project(df, {"x": "info.nope"})


def test_explode_variants(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "i int, a array<string>")
    assert rows(nt.explode_rows(df, "a", "x", ["i"]), "i", "x") == [(1, "a"), (1, "b")]
    assert rows(nt.explode_rows(df, "a", "x", ["i"], outer=True), "i", "x") == [
        (1, "a"), (1, "b"), (2, None), (3, None)]
    assert rows(nt.explode_rows(df, "a", "x", ["i"], position="p"), "i", "p") == [(1, 0), (1, 1)]
    both = nt.tagged_rows(df.select("i", "a", F.array(F.lit("z")).alias("b")),
                          {"first": "a", "second": "b"}, "x", "tag", ["i"])
    assert rows(both, "i", "x", "tag") == [
        (1, "a", "first"), (1, "b", "first"), (1, "z", "second"), (2, "z", "second"),
        (3, "z", "second")]


def test_struct_rows_take_any_field_names(spark):
    df = spark.createDataFrame([(1, ("u", None)), (2, ("w", "x"))],
                               "i int, p struct<`A. Player`:string, B:string>")
    assert rows(nt.struct_rows(df, "p", keep=["i"]), "i", "key", "value") == [
        (1, "A. Player", "u"), (2, "A. Player", "w"), (2, "B", "x")]


def test_flatten_pairs_siblings_and_numbers_names(spark):
    df = spark.sql("""SELECT 1 AS i, named_struct('b', 2) AS a, 3 AS a_b, 4 AS a_b_2, array(1, 2) AS x, array('p', 'q', 'r') AS y
        UNION ALL SELECT 2, NULL, 5, 6, NULL, array()""")
    out = nt.flatten(df, True)
    assert out.columns == ["i", "a_b", "a_b_3", "a_b_2", "x", "y"]
    assert sorted(map(tuple, out.collect()), key=str) == [
        (1, 2, 3, 4, 1, "p"), (1, 2, 3, 4, 2, "q"), (1, 2, 3, 4, None, "r"), (2, None, 5, 6, None, None)]


def test_variant_leaves_of_unlike_documents(spark):
    texts = ['{"a": {"x y": 1, "b": [true, {"c": null}]}}', '{"z": 2.5}', "[1, [2]]", '"plain"', "{broken", None, "{}",
             '{"e": [], "f": {}, "d": {"d": {"d": {"d": {"d": 1}}}}}', '{"": "named by nothing"}']
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    parsed = nt.parse_variant(rows, "text")
    assert {r.id: r._corrupt_record for r in parsed.collect() if r._corrupt_record} == {4: "{broken"}
    got = {(r.id, r.path): r.value for r in nt.variant_leaves(parsed, "doc", ["id"]).collect()}
    assert got == {
        (0, "a.x y"): "1", (0, "a.b[0]"): "true", (0, "a.b[1].c"): None, (1, "z"): "2.5", (2, "[0]"): "1", (2, "[1][0]"): "2",
        (3, ""): "plain", (6, ""): "{}", (7, "e"): "[]", (7, "f"): "{}", (7, "d.d.d.d"): '{"d":1}',
        (8, ""): "named by nothing"}
    assert nt.variant_leaves(parsed.limit(0), "doc", ["id"]).count() == 0


def test_variant_pairs(spark):
    texts = ['{"p": {"Ann": "1", "Bo": {"n": 2}}}', '{"p": 3}', '{"q": {}}', "no", None, '{"p": {}}', '{"p": ["x"]}']
    rows = nt.parse_variant(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "text")
    got = {(r.id, r.key, r.value) for r in nt.variant_pairs(rows, "doc", "$.p", keep=["id"]).collect()}
    assert got == {(0, "Ann", "1"), (0, "Bo", '{"n":2}'), (6, None, "x")}
