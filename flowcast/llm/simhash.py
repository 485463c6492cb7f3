"""Near duplicates by 64-bit SimHash and multi-index hashing.

Fingerprints: lower-cased A-Z, words between ASCII white space, shingles of three words with
repeats (shorter texts: the whole sequence), XXH64 with seed 42; a bit is set if it is set in over
half of the hashes. A text without words has fingerprint zero and is linked like any other.

Links at two or fewer differing bits, by multi-index hashing: the fingerprint is cut into two
segments of 32 bits. For each segment the Hamming ball of radius one is enumerated, and the
bucket is found under (enumerated segment, other segment as it is). Two fingerprints within two bits
always share a bucket: with differences (2, 0) or (0, 2) both reach the value in between, with
(1, 1) one reaches the other's segment, and closer ones share theirs. A bucket can hold
at most 65 distinct fingerprints however many documents repeat them, because it stands for one
64-bit value and holds only its neighbours. So no bucket is ever hot, nothing is capped, and a bucket
needs no pairs: each member is linked to the smallest one, after the complete distance is verified.

Only distinct fingerprints go through this; documents meet them again at the end.

Defined results: null text is the empty one. A row with a null id takes part, but a group is named
by the smallest id that is not null. Repeated rows repeat their results. Empty tables give empty tables.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowcast.llm.components import components
from flowcast.llm.frames import sliced_map, texts
from flowcast.session import shuffle_partitions
from flowcast.sources.staging import stage

SEED, SHINGLE, BITS, SEGMENT = 42, 3, 64, 32
PIECE = 1 << 16


def fingerprint(data):
    """SimHash of UTF-8 bytes, as an unsigned number."""
    words = data.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return digest(b" ".join(words), SEED)
    ones, n = np.zeros(BITS, np.int64), len(words) - SHINGLE + 1
    for i in range(0, n, PIECE):  # bounded memory for very long texts
        part = words[i:i + PIECE + SHINGLE - 1]
        h = np.array([digest(b" ".join(s), SEED) for s in zip(part, part[1:], part[2:])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def _fingerprints(batch):
    prints = np.array([fingerprint(t) for t in batch.column("text").cast(pa.binary()).to_pylist()], "<u8")
    return {"id": batch.column("id"), "fp": prints.view("<i8"), "key": batch.column("key")}


def fingerprints(docs, id_col="doc_id", text_col="text"):
    """(id, fp, key): fp holds the 64 bits as a long, key names id and text together."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts(docs, id_col, text_col)
    return sliced_map(rows.withColumn("key", _key(F.col("id"), F.col("text"))), f"id {kind}, fp long, key string", _fingerprints)


def _key(name, text):
    return F.md5(F.concat(F.coalesce(name.cast("string"), F.lit("")), F.when(name.isNull(), "?").otherwise(":"), text))


def links(prints):
    """Edges (a, b) between distinct fingerprints, enough to connect all that are linked."""
    one = F.expr("transform(sequence(0, 31), i -> shiftleft(1L, i))")
    high = F.expr("transform(sequence(32, 63), i -> shiftleft(1L, i))")
    # each ball leaves one segment as it is; the centre is common to both
    probes = F.transform(F.concat(F.array(F.lit(0).cast("long")), one, high), lambda m: F.col("fp").bitwiseXOR(m))
    bucket = W.partitionBy("bucket")
    spread = prints.select("fp").repartition(shuffle_partitions(prints.sparkSession), "fp")    # before it grows 65-fold
    members = (spread.select("fp", F.explode(probes).alias("bucket"))
               .withColumn("head", F.min("fp").over(bucket)))
    return (members.where("fp <> head and bit_count(fp ^ head) <= 2")
            .select(F.col("fp").alias("a"), F.col("head").alias("b")).distinct())


def _grouped(docs, id_col, text_col):
    """(id, fp, key, root, component) of every row, root being the smallest fingerprint of its group."""
    prints = stage(fingerprints(docs, id_col, text_col), "simhash")
    each = stage(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    roots = components(links(each.select("fp")), "simhash-links")
    named = each.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    named = stage(named, "simhash-roots")
    groups = named.groupBy("root").agg(F.min("first").alias("component"))
    known = stage(named.join(groups, "root").select("fp", "root", "component"), "simhash-groups")
    return prints.join(known, "fp")


def near_duplicates(docs, id_col="doc_id", text_col="text"):
    """(id, fp, component): component is the smallest id of all rows reachable by links."""
    return _grouped(docs, id_col, text_col).select(F.col("id").alias(id_col), "fp", "component")


def deduplicate(docs, id_col="doc_id", text_col="text"):
    """One row of each group: the one with the smallest id, null ids last, then by fingerprint and a hash of the text.

    Rows of one id with unlike texts are judged by their groups, each on its own. Of rows with the same id and text
    one stays, by a hash of all its columns. Columns stay as they are. Only keys are grouped; texts move
    once, whatever the size (a plan by size would broadcast the keys of small tables and sort those of large ones).
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names))
    found = stage(_grouped(docs, id_col, text_col).select("root", F.struct(F.col("id").isNull().alias("n"), "id", "fp", "key").alias("row")),
                  "simhash-rows")
    kept = found.groupBy("root").agg(F.min("row").alias("best"))
    keys = found.groupBy("root", F.col("row.key").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    judged = keys.join(kept, "root").select("key", "n", (F.col("key") == F.col("best.key")).alias("stays"))
    apart = stage(judged.where(~F.col("stays") | (F.col("n") > 1)), "simhash-apart")   # all but rows that simply stay
    inner = docs.toDF(*names)
    keyed = inner.select(*names, _key(F.col(at[id_col]), F.coalesce(at[text_col], F.lit(""))).alias("key"))
    row = F.struct(*names)
    once = keyed.join(apart.where("stays").select("key").hint("merge"), "key", "left_semi").groupBy("key").agg(
        F.min_by(row, F.xxhash64(*names)).alias("row")).select("row.*")
    return keyed.join(apart.select("key").hint("merge"), "key", "left_anti").select(*names).unionAll(once).toDF(*docs.columns)
