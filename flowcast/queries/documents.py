"""Nest the flat tables into match documents.

A document covers one key and one run of its rows. A key with very many
rows so becomes many documents of bounded size, never one large group; flattening them
gives the rows back whole. Ids are not unique and no query reports a count per document. The run number depends on
the rows per key and the file split alone, so a recomputed task repeats it.
"""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from flowcast.sources.readers import read_table

RUN_BITS = 16


def long_keys(df, *keys, bits=RUN_BITS):
    """(k0, k1, ..., runs) of the keys with more than 2^bits rows: at most one per 2^bits rows of ``df``."""
    counts = df.groupBy(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("n"))
    runs = F.ceil(F.col("n") / 2 ** bits).cast("int").alias("runs")
    return counts.filter(F.col("n") > 2 ** bits).select(*[f"k{i}" for i in range(len(keys))], runs)


def in_runs(df, *keys, bits=RUN_BITS, long=None):
    """Add the number of the run of about 2^bits rows and spread the rows by key and run.

    A key has as many runs as its own rows fill, one if they are few, however they are spread over the files.
    Without keys a run is one of neighbouring rows. ``long`` are the ``long_keys`` if known.
    """
    place = F.monotonically_increasing_id()
    if not keys:
        return df.select("*", F.shiftright(place, bits).alias("run")).repartition("run")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"k{i}")) for i, k in enumerate(keys)])
    long = long if long is not None else long_keys(df, *keys, bits=bits)
    rows = df.select("*", place.alias("place")).join(F.broadcast(long), same, "left")
    run = F.coalesce(F.pmod(F.xxhash64("place"), "runs"), F.lit(0)).cast("int").alias("run")
    return rows.select(*df.columns, run).repartition(*keys, "run")


def _text_date(c):
    return F.date_format(c, "yyyy-MM-dd")


def innings_documents(spark, sf):
    """orders ⟕ lineitem: (match_id, info, innings), innings = flag, over = line number.

    Only the columns that deliveries are made of are shuffled, once; headers follow to the runs of their order.
    """
    items = read_table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_returnflag").alias("team"), F.col("l_linenumber").alias("over"), "l_partkey", "l_suppkey",
        F.to_date("l_shipdate").alias("shipped"), F.col("l_quantity").cast("int").alias("quantity"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount"),
        F.floor("l_extendedprice").cast("int").alias("price"), (F.col("l_linestatus") == "F").alias("out"))
    batter = F.concat(F.lit("p"), "l_partkey")
    delivery = F.struct(
        batter.alias("batter"), F.concat(F.lit("s"), "l_suppkey").alias("bowler"),
        _text_date("shipped").alias("non_striker"),
        F.struct(F.col("quantity").alias("batter"), F.col("discount").alias("extras"), F.col("price").alias("total")).alias("runs"),
        F.when(F.col("out"), F.array(F.struct(batter.alias("player_out"), F.col("team").alias("kind")))).alias("wickets"))
    long = long_keys(items, "l_orderkey")
    rows = in_runs(items, "l_orderkey", long=long)
    overs = rows.groupBy("l_orderkey", "run", "team", "over").agg(
        F.collect_list(delivery).alias("deliveries"))
    teams = overs.groupBy("l_orderkey", "run", "team").agg(
        F.collect_list(F.struct("over", "deliveries")).alias("overs"))
    documents = teams.groupBy("l_orderkey", "run").agg(
        F.collect_list(F.struct("team", "overs")).alias("innings"))
    info = F.struct(F.array(_text_date("o_orderdate")).alias("dates"),
                    F.col("o_orderpriority").alias("venue"))
    runs = F.explode(F.sequence(F.lit(0), F.coalesce("runs", F.lit(1)) - 1)).alias("o_run")
    header = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority").join(
        F.broadcast(long), F.col("o_orderkey") == F.col("k0"), "left").select("o_orderkey", "o_orderdate", "o_orderpriority", runs)
    same = (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("run") == F.col("o_run"))
    joined = documents.join(header, same).select("l_orderkey", info.alias("info"), "innings")
    return joined.select(F.col("l_orderkey").cast("string").alias("match_id"), "info", "innings")


def header_documents(spark, sf):
    """One JSON text per order with its meta and info objects, and its day."""
    day = _text_date("o_orderdate")
    late = F.col("o_orderstatus") == "F"
    done = F.col("o_orderstatus") != "O"
    winner = F.concat(F.lit("Team "), (F.col("o_custkey") % 2).cast("string"))
    meta = F.struct(
        F.lit("1.0.0").alias("data_version"), day.alias("created"),
        (F.col("o_orderkey") % 7).cast("int").alias("revision"))
    info = F.struct(
        F.col("o_orderpriority").alias("city"),
        F.array(day, _text_date(F.date_add("o_orderdate", 1))).alias("dates"),
        F.struct(
            F.concat(F.lit("Customer "), "o_custkey").alias("name"),
            (F.col("o_orderkey") % 100).cast("int").alias("match_number"),
            F.when(late, "A").alias("group")).alias("event"),
        F.col("o_orderstatus").alias("gender"), F.lit("ODI").alias("match_type"),
        (F.col("o_orderkey") % 5000).cast("int").alias("match_type_number"),
        F.year("o_orderdate").cast("string").alias("season"), F.lit("club").alias("team_type"),
        F.concat(F.lit("Ground "), (F.col("o_custkey") % 10).cast("string")).alias("venue"),
        F.array(F.lit("Team 0"), F.lit("Team 1")).alias("teams"),
        F.struct(winner.alias("winner"), F.lit("bat").alias("decision")).alias("toss"),
        F.when(done, F.struct(
            winner.alias("winner"),
            F.when(late, F.struct(F.floor(F.col("o_totalprice") / 1000).cast("int").alias("runs")))
            .alias("by"))).alias("outcome"))
    return read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("match_id"), day.alias("day"),
        F.to_json(F.struct(meta.alias("meta"), info.alias("info"))).alias("value"))


def day_documents(spark, sf, bits=16):
    """The documents of all orders of a day and run of its rows as one JSON array text of many lines."""
    rows = in_runs(header_documents(spark, sf).select("value", "day"), "day", bits=bits)
    lines = F.array_join(F.collect_list("value"), ",\n")
    return rows.groupBy("day", "run").agg(F.concat(F.lit("["), lines, F.lit("]")).alias("value")).select("value")


def players_documents(spark, sf):
    """JSON texts with an object of player lists per team, teams with spaces in the name."""
    rows = in_runs(
        read_table(spark, sf, "lineitem").select(
            "l_orderkey", F.concat(F.lit("Team "), "l_returnflag").alias("team"),
            F.concat(F.lit("p"), "l_partkey").alias("player")), "l_orderkey")
    teams = rows.groupBy("l_orderkey", "run", "team").agg(F.collect_list("player").alias("names"))
    documents = teams.groupBy("l_orderkey", "run").agg(
        F.map_from_entries(F.collect_list(F.struct("team", "names"))).alias("players"))
    return documents.select(
        F.col("l_orderkey").alias("match_id"),
        F.to_json(F.struct(F.struct("players").alias("info"))).alias("value"))


def officials_documents(spark, sf):
    """JSON texts with one array per role; a run in which nobody has a role lacks it."""
    names = F.concat(F.lit("turn "), "turn")
    rows = in_runs(read_table(spark, sf, "conversations").select(
        "conv_id", "role", names.alias("name")), "conv_id")

    def having(role):
        found = F.collect_list(F.when(F.col("role") == role, F.col("name")))
        return F.when(F.size(found) > 0, found)

    documents = rows.groupBy("conv_id", "run").agg(F.struct(
        having("system").alias("match_referees"), having("assistant").alias("reserve_umpires"),
        having("user").alias("umpires")).alias("officials"))
    return documents.select(
        F.col("conv_id").alias("match_id"),
        F.to_json(F.struct(F.struct("officials").alias("info"))).alias("value"))


def registry_documents(spark, sf):
    """JSON texts with the event's key/value object as the people registry."""
    head, tail = F.lit('{"info":{"registry":{"people":'), F.lit("}}}")
    return read_table(spark, sf, "events").select(
        F.col("event_id").alias("match_id"), F.concat(head, "props", tail).alias("value"))


def array_documents(spark, sf, bits=8, **options):
    """Each run of customers as one JSON array text."""
    rows = in_runs(read_table(spark, sf, "customer"), bits=bits)
    entry = F.struct(
        F.col("c_name").alias("name"), F.col("c_custkey").cast("int").alias("age"),
        F.struct(F.col("c_mktsegment").alias("street"),
                 F.col("c_nationkey").cast("string").alias("city")).alias("address"),
        F.array(F.struct(F.lit(1).alias("id"), F.col("c_mktsegment").alias("value")),
                F.struct(F.lit(2).alias("id"), F.col("c_name").alias("value"))).alias("items"),
        F.create_map(F.lit("k"), F.col("c_acctbal").cast("string")).alias("details"))
    return rows.groupBy("run").agg(
        F.to_json(F.collect_list(entry), options).alias("value")).select("value")
