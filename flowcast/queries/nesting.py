"""Nested documents to flat tables; the documents are nested from the supplied tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcast.operators import match as mt
from flowcast.operators import nested as nt
from flowcast.queries import documents as docs
from flowcast.queries.registry import registrar
from flowcast.sources.catalog import struct_fields
from flowcast.sources.readers import read_json, read_table
from flowcast.sources.staging import scratch_path

QUERIES, ORACLES, query = registrar()

# The nested record.
RECORD = """array<struct<name:string, age:int, address:struct<street:string, city:string>,
items:array<struct<id:int, value:string>>, details:map<string,string>>>"""

DELIVERIES = """
SELECT CAST(l_orderkey AS VARCHAR) AS "Match_ID", strftime(o_orderdate, '%Y-%m-%d') AS "Date",
o_orderpriority AS "Venue", l_returnflag AS "Team", l_linenumber AS "Over",
'p' || l_partkey AS "Batter", 's' || l_suppkey AS "Bowler",
strftime(l_shipdate, '%Y-%m-%d') AS "Non_Striker", CAST(l_quantity AS INTEGER) AS "Runs_Batter",
CAST(round(l_discount * 100) AS INTEGER) AS "Runs_Extras",
CAST(floor(l_extendedprice) AS INTEGER) AS "Runs_Total",
CASE WHEN l_linestatus = 'F' THEN 'p' || l_partkey END AS "Wicket_Player_Out",
CASE WHEN l_linestatus = 'F' THEN l_returnflag END AS "Wicket_Kind"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def parsed(texts, *objects):
    """JSON texts to documents by the match schema, only the objects asked for."""
    schema = mt.objects_schema(*objects)
    out = nt.parse_json(texts, "value", schema, corrupt=False)
    return nt.expand_root(out, "json_data", schema, keep=["match_id"])


@query(DELIVERIES)
def ball_by_ball(spark, sf):
    return mt.ball_by_ball(docs.innings_documents(spark, sf))


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS match_id, l_returnflag AS "Team", l_linenumber AS "Over",
'p' || l_partkey AS player_out, l_returnflag AS kind FROM lineitem WHERE l_linestatus = 'F'""")
def all_wickets(spark, sf):
    rows = mt.wickets(docs.innings_documents(spark, sf))
    return rows.drop("inning_no", "ball_no")


@query("""SELECT o_orderkey AS match_id, '1.0.0' AS data_version, strftime(o_orderdate, '%Y-%m-%d') AS created,
CAST(o_orderkey % 7 AS INTEGER) AS revision FROM orders""")
def match_metadata(spark, sf):
    return mt.metadata(parsed(docs.header_documents(spark, sf), "meta"))


@query("""SELECT o_orderkey AS match_id, o_orderpriority AS city, strftime(o_orderdate, '%Y-%m-%d') AS match_date,
'Customer ' || o_custkey AS event_name, CAST(o_orderkey % 100 AS INTEGER) AS match_number,
CASE WHEN o_orderstatus = 'F' THEN 'A' END AS "group", o_orderstatus AS gender, 'ODI' AS match_type,
CAST(o_orderkey % 5000 AS INTEGER) AS match_type_number, CAST(year(o_orderdate) AS VARCHAR) AS season,
'club' AS team_type, 'Ground ' || (o_custkey % 10) AS venue, 'Team ' || (o_custkey % 2) AS toss_winner,
'bat' AS toss_decision, CASE WHEN o_orderstatus <> 'O' THEN 'Team ' || (o_custkey % 2) END AS winner,
CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice / 1000) AS INTEGER) END AS win_by_runs FROM orders""")
def match_info(spark, sf):
    return mt.match_info(parsed(docs.header_documents(spark, sf), "info"))


@query("""SELECT o_orderkey AS match_id, 'ODI' AS "Match_Type", strftime(o_orderdate, '%Y-%m-%d') AS "Date",
'Ground ' || (o_custkey % 10) AS "Venue", 'Team 0' AS "Team1", 'Team 1' AS "Team2",
CASE WHEN o_orderstatus <> 'O' THEN 'Team ' || (o_custkey % 2) END AS "Winner" FROM orders""")
def match_header(spark, sf):
    return mt.match_header(parsed(docs.header_documents(spark, sf), "info"))


@query("""SELECT l_orderkey AS match_id, 'Team ' || l_returnflag AS team_name, 'p' || l_partkey AS player_name
FROM lineitem""")
def team_players(spark, sf):
    return mt.players(parsed(docs.players_documents(spark, sf), "info"))


@query("""SELECT conv_id AS match_id, 'turn ' || turn AS official_name, CASE role WHEN 'system' THEN 'match_referee'
WHEN 'assistant' THEN 'reserve_umpire' ELSE 'umpire' END AS role FROM conversations
WHERE role IN ('system', 'assistant', 'user')""")
def officials_by_role(spark, sf):
    return mt.officials(parsed(docs.officials_documents(spark, sf), "info"))


PAIRS = """SELECT event_id AS {id}, key AS {key}, props ->> key AS {value}
FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)"""


@query(PAIRS.format(id="match_id", key="player_name", value="player_id"))
def match_registry(spark, sf):
    return mt.registry(parsed(docs.registry_documents(spark, sf), "info"))


@query(PAIRS.format(id="event_id", key="key", value="value"))
def registry_pairs(spark, sf):
    rows = nt.parse_json(read_table(spark, sf, "events"), "props", "struct<k:int>", "people")
    return nt.struct_rows(rows, "people", keep=["event_id"])


@query("""SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k, props ->> '$.k' AS k_text,
CAST(NULL AS VARCHAR) AS _corrupt_record FROM events""")
def parse_props(spark, sf):
    rows = read_table(spark, sf, "events").select(
        "event_id", "props", F.get_json_object("props", "$.k").alias("k_text"))
    out = nt.parse_json(rows, "props", "struct<k:int>")
    return nt.expand_root(out, "json_data", "struct<k:int>", keep=["event_id", "k_text"])


@query("""SELECT c_name AS name, CAST(c_custkey AS INTEGER) AS age, c_mktsegment AS address_street,
CAST(c_nationkey AS VARCHAR) AS address_city, i.id AS items_id,
CASE i.id WHEN 1 THEN c_mktsegment ELSE c_name END AS items_value,
CAST(NULL AS VARCHAR) AS _corrupt_record FROM customer CROSS JOIN (VALUES (1), (2)) AS i(id)""")
def root_array(spark, sf):
    path = scratch_path(spark, "root-array")
    docs.array_documents(spark, sf).write.text(path)
    rows = nt.process_nested_json(spark, path, RECORD, whole=False, flat=True, explode_arrays=True)
    return rows.drop("details")


FLAT = """SELECT c_name AS name, CAST(c_custkey AS INTEGER) AS age, c_mktsegment AS street,
CAST(c_nationkey AS VARCHAR) AS city, c_mktsegment AS first_item, CAST(c_acctbal AS VARCHAR) AS k FROM customer"""


def _flat(df):
    return nt.project(df, {"name": "name", "age": "age", "street": "address.street",
                           "city": "address.city", "first_item": "items[0].value",
                           "k": ("details", "k")})


def _document_files(spark, sf, label):
    """Pretty-printed arrays over many lines, one document per file."""
    path = scratch_path(spark, label)
    arrays = docs.array_documents(spark, sf, bits=17, pretty="true")
    arrays.write.option("maxRecordsPerFile", 1).text(path)
    return path


@query(FLAT)
def multiline_json(spark, sf):
    record = T.DataType.fromDDL(RECORD).elementType
    return _flat(read_json(spark, _document_files(spark, sf, "multiline"), record))


@query(FLAT)
def whole_text_json(spark, sf):
    return _flat(nt.process_nested_json(spark, _document_files(spark, sf, "whole"), RECORD))


@query("""SELECT event_id, event_type, user_id % 10 AS loc, i.n AS copy FROM events
CROSS JOIN (VALUES (0), (1)) AS i(n)""")
def exploded_positions(spark, sf):
    rows = read_table(spark, sf, "events").select(
        "event_id", F.array("event_type", "event_type").alias("pair"),
        (F.col("user_id") % 10).alias("loc"))
    return nt.explode_rows(rows, "pair", "event_type", ["event_id", "loc"], position="copy")


@query("""SELECT c_custkey AS a_b, c_name AS a_b_2, CASE i WHEN 0 THEN c_nationkey WHEN 1 THEN c_nationkey + 1 END AS xs,
CASE i WHEN 0 THEN c_mktsegment WHEN 1 THEN c_name ELSE 'last' END AS ys FROM customer CROSS JOIN (VALUES (0), (1), (2)) AS p(i)""")
def flatten_siblings(spark, sf):
    """Sibling arrays side by side, not multiplied, and names that would clash."""
    rows = read_table(spark, sf, "customer").select(
        F.struct(F.col("c_custkey").alias("b")).alias("a"), F.col("c_name").alias("a_b"),
        F.array("c_nationkey", F.col("c_nationkey") + 1).alias("xs"), F.array("c_mktsegment", "c_name", F.lit("last")).alias("ys"))
    return nt.flatten(rows, explode_arrays=True)


@query("""SELECT event_id, value AS "the value", event_type AS "event type", user_id AS "user.no" FROM events""")
def struct_fields_by_schema(spark, sf):
    """All fields of a struct whose names, with spaces and dots, are only known at run time."""
    rows = read_table(spark, sf, "events").select("event_id", F.struct(
        F.col("value").alias("the value"), F.col("event_type").alias("event type"), F.col("user_id").alias("user.no")).alias("all data"))
    return nt.project(rows, {name: ("all data", name) for name in struct_fields(rows, "all data")}, ["event_id"])


@query("""SELECT 'Customer ' || o_custkey AS event_name, CAST(o_orderkey % 7 AS BIGINT) AS revision,
strftime(o_orderdate, '%Y-%m-%d') AS first_date, 'Team 1' AS second_team FROM orders""")
def inferred_json(spark, sf):
    """Nested documents read with the schema Spark finds in them."""
    path = scratch_path(spark, "inferred")
    docs.header_documents(spark, sf).select("value").write.text(path)
    return nt.project(read_json(spark, path, multiline=False), {
        "event_name": "info.event.name", "revision": "meta.revision", "first_date": "info.dates[0]", "second_team": "info.teams[1]"})


@query("""SELECT strftime(o_orderdate, '%Y-%m-%d') AS created, o_orderpriority AS city, 'Ground ' || (o_custkey % 10) AS venue
FROM orders""")
def match_day_files(spark, sf):
    """Multi-line files of all orders, one per day and run of rows, keyed by file name, saved as one release of five tables, and a join of two of them."""
    path, root = scratch_path(spark, "match-files"), scratch_path(spark, "match-release")
    docs.day_documents(spark, sf).write.option("maxRecordsPerFile", 1).text(path)
    saved = mt.save_match_release(mt.read_matches(spark, path), root, "orders")
    return saved["metadata_table"].select("match_id", "created").distinct().join(
        saved["match_information_table"].select("match_id", "city", "venue"), "match_id").drop("match_id")


@query(PAIRS.format(id="match_id", key="player_name", value="player_id"))
def variant_registry(spark, sf):
    """The registry of people without a declared schema: their names are keys of the documents."""
    rows = nt.parse_variant(docs.registry_documents(spark, sf), "value")
    return nt.variant_pairs(rows, "doc", "$.info.registry.people", "player_name", "player_id", ["match_id"])


@query("""SELECT c_custkey, unnest(['name', 'address.street', 'scores[0]', 'scores[1]', 'seen_' || c_nationkey]) AS path,
unnest([c_name, c_mktsegment, CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR), NULL]) AS value FROM customer
WHERE c_custkey % 9 <> 0""")
def variant_flatten(spark, sf):
    """Leaves of documents whose keys differ from one to the next, some of them unreadable."""
    text = F.to_json(F.struct(
        F.col("c_name").alias("name"), F.struct(F.col("c_mktsegment").alias("street")).alias("address"),
        F.array("c_custkey", "c_nationkey").alias("scores")))
    own = F.concat(F.lit(',"seen_'), F.col("c_nationkey").cast("string"), F.lit('":null}'))
    whole = F.concat(F.expr("left(text, length(text) - 1)"), own)
    rows = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey", text.alias("text"))
    rows = rows.withColumn("text", F.when(F.col("c_custkey") % 9 == 0, F.col("text").substr(1, 9)).otherwise(whole))
    return nt.variant_leaves(nt.parse_variant(rows, "text"), "doc", ["c_custkey"])
