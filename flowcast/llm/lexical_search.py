"""Ranked lexical search: posting lists with range-maximum tables, searched best interval first.

Items are queries, documents are ranked. Every text is cut once into terms; of each document its length and its counts
of the items' terms are staged. Numbers of documents and terms are then counted over all documents, which fixes
every score. The staged rows are read again in shards of at most ``SHARD_POSTINGS`` postings (a single document may have
more), documents in the order of their ids. A shard holds

- one posting list per term: documents and impacts, an impact being what the term adds to the document's score;
- sparse tables over the lists: for each power of two the place of the largest impact of every run of that length,
  so the maximum of any range is the larger one of two entries.

For an item, an interval of documents is bounded by the sum, over its terms, of the largest impact inside. A heap gives
the interval of highest bound. It is split at the document of its largest single impact: that one is scored
exactly, both sides become new intervals with bounds of their own; an interval of ``LEAF`` documents is scored whole. A task keeps its best ``top`` per item from shard to shard; an
interval whose bound cannot enter them, ties by id included, is dropped, and the search ends with the last interval. The tasks' best
are merged by one window. Every document is indexed and can be found.

Items go in blocks of at most ``BLOCK_CHARS`` characters (a longer item is a block of its own), which bounds what the driver and each
worker hold of them; blocks are searched in turn, with the same result.

Arithmetic is on 64-bit integers but for the logarithm of a term's weight.

Defined results: null and empty texts have no terms, such documents are never found and such items find nothing; texts
of any length are counted whole; repeated documents are ranked one by one, repeated items answered one by one; equal scores go by
ascending id, null ids last; other columns are ignored; an empty table of documents or items gives an empty result.
"""

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowcast.llm.frames import arrow_map, schema_of, slices, texts, to_batches
from flowcast.sources.staging import stage

TOP, SHARD_POSTINGS, BLOCK_CHARS, LEAF = 10, 1 << 19, 4_000_000, 256
STAGED = "id long, n long, terms array<int>, counts array<long>"
FOUND = "item int, id long, score long"

_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x41:0x5B] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def cut(column):
    """Runs of term and other characters of a whole column: (runs as bytes, text of each run, whether it is a term)."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = _LOWER[np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(0, bool)
    inside = _IS_WORD[data]
    change = np.zeros(len(data), bool)
    change[1:] = inside[1:] != inside[:-1]
    change[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(change)
    ends = np.r_[starts, len(data)].astype(np.int64)
    runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return runs, np.searchsorted(offsets, starts, side="right") - 1, inside[starts]


def terms_of(text):
    runs, _, inside = cut(pa.array([text or ""], pa.large_string()))
    return [r.decode() for r in runs.filter(pa.array(inside)).to_pylist()]


def _counted(batch, vocabulary):
    """Length and counts of the vocabulary's terms of every document."""
    known = pa.array(vocabulary, pa.large_binary())
    columns = {"id": [], "n": [], "terms": [], "counts": []}
    for part in slices([batch]):
        runs, doc, inside = cut(part.column("text"))
        rows = part.num_rows
        found = pc.index_in(runs, value_set=known)
        at = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        term = found.take(pa.array(at)).to_numpy(zero_copy_only=False).astype(np.int64)
        pair, counts = np.unique(doc[at] * len(vocabulary) + term, return_counts=True)
        ends = np.searchsorted(pair, np.arange(rows + 1) * len(vocabulary)).astype(np.int32)
        columns["id"].append(part.column("id"))
        columns["n"].append(pa.array(np.bincount(doc[inside], minlength=rows).astype(np.int64)))
        columns["terms"].append(pa.ListArray.from_arrays(ends, pa.array((pair % len(vocabulary)).astype(np.int32))))
        columns["counts"].append(pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int64))))
    return {name: pa.chunked_array(parts) for name, parts in columns.items()}


def weight(documents, frequency):
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


class Shard:
    """Posting lists of some documents, in the order of their ids, with range-maximum tables."""

    def __init__(self, ids, lengths, terms, counts, sizes, weights, documents, total):
        missing = np.equal(ids, None)
        order = np.lexsort((np.where(missing, 0, ids).astype(np.int64), missing))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.size = ids[order], len(ids)
        doc = np.repeat(np.arange(len(ids)), sizes)
        m = 10 + (90 * lengths * documents) // total
        impact = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 8 * m[doc]))
        key = terms.astype(np.int64) * self.size + place[doc]
        by = np.argsort(key)
        self.key, self.impact = key[by], impact[by]
        self.tables = [np.arange(len(by), dtype=np.int32)]
        longest = int(np.bincount(terms).max(initial=0)) if len(terms) else 0
        for step in (1 << np.arange(max(longest, 1).bit_length() - 1)).tolist():
            below = self.tables[-1]
            left, right = below[:-step], below[step:]
            self.tables.append(np.where(self.impact[left] >= self.impact[right], left, right))

    def ranges(self, terms, lo, hi):
        """Places of the documents lo..hi-1 in the terms' lists."""
        return np.searchsorted(self.key, terms * self.size + lo), np.searchsorted(self.key, terms * self.size + hi)

    def best(self, a, b):
        """Place of the largest impact of each range a..b-1, all of them filled."""
        level = np.frexp((b - a).astype(float))[1] - 1
        left = np.empty(len(a), np.int64)
        right = np.empty(len(a), np.int64)
        for j in set(level.tolist()):
            rows = level == j
            table = self.tables[j]
            left[rows], right[rows] = table[a[rows]], table[b[rows] - (1 << j)]
        return np.where(self.impact[left] >= self.impact[right], left, right)

    def scores(self, lo, hi, a, b):
        """Places and scores of the documents of a short interval that hold any of the terms."""
        size = b - a
        at = np.repeat(b - np.cumsum(size), size) + np.arange(size.sum())
        scores = np.zeros(hi - lo, np.int64)
        np.add.at(scores, self.key[at] % self.size - lo, self.impact[at])
        held = np.flatnonzero(scores)
        return (held + lo).tolist(), scores[held].tolist()

    def search(self, terms, top, kept):
        """Improves ``kept``, a heap of (score, reversed id) of the item's best documents so far."""
        def bounded(lo, hi, own, a, b):
            full = b > a
            if not full.any():
                return
            own, a, b = own[full], a[full], b[full]
            peak = self.best(a, b)
            impact = self.impact[peak]
            bound = int(impact.sum())
            if bound > 0 and worthy(bound, lo):
                heapq.heappush(heap, (-bound, lo, hi, own, a, b, int(peak[impact.argmax()])))

        def worthy(bound, lo):
            return len(kept) < top or (bound, _late(self.ids[lo])) > kept[0]

        def keep(place, score):
            entry = (score, _late(self.ids[place]))
            if score > 0 and len(kept) < top:
                heapq.heappush(kept, entry)
            elif score > 0 and entry > kept[0]:
                heapq.heapreplace(kept, entry)

        heap = []
        bounded(0, self.size, terms, *self.ranges(terms, 0, self.size))
        while heap:
            bound, lo, hi, own, a, b, peak = heapq.heappop(heap)
            if not worthy(-bound, lo):
                continue
            if hi - lo <= LEAF:
                for place, score in zip(*self.scores(lo, hi, a, b)):
                    keep(place, score)
                continue
            split = int(self.key[peak] % self.size)
            middle = np.searchsorted(self.key, own * self.size + split)
            inside = middle < b
            holds = np.zeros(len(own), bool)
            holds[inside] = self.key[middle[inside]] == own[inside] * self.size + split
            score = int(self.impact[middle[holds]].sum())
            keep(split, score)
            bounded(lo, split, own, a, middle)
            bounded(split + 1, hi, own, middle + holds, b)


def _late(i):
    """Sorts ids the other way round, null ids before all."""
    return -math.inf if i is None else -int(i)


def _searcher(items, vocabulary, schema, weights, documents, total, top):
    """Arrow map over the staged documents of one task: the task's best documents per item."""
    def flush(parts, kept):
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        ids, terms, counts = (table.column(c).combine_chunks() for c in ("id", "terms", "counts"))
        ids = np.array(ids.to_pylist(), object) if ids.null_count else ids.to_numpy()
        sizes = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
        shard = Shard(ids, table.column("n").to_numpy(), terms.flatten().to_numpy(), counts.flatten().to_numpy(), sizes,
                      weights, documents, total)
        for number, own in enumerate(items):
            shard.search(own, top, kept[number])

    def run(batches):
        kept, parts, size = [[] for _ in items], [], 0
        for batch in batches:
            ends = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                before = int(ends[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + SHARD_POSTINGS - size, side="right")))
                parts.append(batch.slice(at, to - at))
                size += int(ends[to - 1]) - before
                if size >= SHARD_POSTINGS or to < batch.num_rows:
                    flush(parts, kept)
                    parts, size = [], 0
                at = to
        flush(parts, kept)
        rows = [(n, None if late == -math.inf else -late, score) for n, best in enumerate(kept) for score, late in best]
        if rows:
            yield from to_batches(dict(zip(("item", "id", "score"), map(list, zip(*rows)))), schema)

    return run


def _blocks(items, id_col, text_col):
    """Lists of (item id, terms), at most ``BLOCK_CHARS`` characters of items at a time on the driver."""
    rows = stage(texts(items, id_col, text_col).withColumn("row_key", F.monotonically_increasing_id()), "items")
    order = Window.partitionBy("chunk").orderBy("row_key")
    chunk = F.shiftright("row_key", 33)     # items of one task; tasks are numbered from bit 33 on
    sized = rows.select("row_key", chunk.alias("chunk"), F.length("text").alias("size")).withColumn(
        "block", F.floor(F.sum("size").over(order) / BLOCK_CHARS))
    marks = sized.groupBy("chunk", "block").agg(F.min("row_key").alias("lo"), F.max("row_key").alias("hi"),
                                               F.sum("size").alias("size")).orderBy("lo")
    lo, hi, size = None, None, 0
    for mark in [*marks.toLocalIterator(), None]:
        if lo is not None and (mark is None or size + mark["size"] > BLOCK_CHARS):
            found = rows.where(F.col("row_key").between(lo, hi)).orderBy("row_key").collect()
            yield [(r["id"], sorted(set(terms_of(r["text"])))) for r in found]
            lo, size = None, 0
        if mark is not None:
            lo, hi, size = mark["lo"] if lo is None else lo, mark["hi"], size + mark["size"]


def search(docs, items, id_col="doc_id", text_col="text", item_id="item_id", item_text="text", top=TOP):
    """(item_id, rank, id, score): the ``top`` best documents of every item."""
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    rows = texts(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    out = spark.createDataFrame([], f"{item_id} {kind}, rank int, {id_col} long, score long")
    for block in _blocks(items, item_id, item_text):
        vocabulary = sorted({t.encode() for _, own in block for t in own})
        if not vocabulary:
            continue
        number = {t: n for n, t in enumerate(vocabulary)}
        queries = [np.array([number[t.encode()] for t in own], np.int64) for _, own in block]
        staged = stage(arrow_map(rows, STAGED, _counted, vocabulary), "postings")
        documents, total = staged.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents:
            break
        held = staged.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # one row per term of the block
        weights = np.full(len(vocabulary), 0, np.int64)
        for row in held:
            weights[row["term"]] = weight(documents, row["count"])
        run = _searcher(queries, vocabulary, schema_of(spark, FOUND), weights, documents, total, top)
        found = staged.where(F.size("terms") > 0).mapInArrow(run, FOUND)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], f"item int, item_id {kind}")
        out = out.unionAll(best.join(names, "item").select(
            F.col("item_id").alias(item_id), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"))
    return out


def oracle():
    """The same in DuckDB SQL: every document scored for every item that shares a term."""
    def words(text):
        lowered = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

    return f"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, {words('text')} AS w FROM documents),
s AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS nn, CAST(sum(len(w)) AS BIGINT) AS l FROM d),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS wt FROM p, s GROUP BY term, nn),
q AS (SELECT DISTINCT item_id, unnest({words('text')}) AS term FROM benchmark),
x AS (SELECT item_id, r, CAST(sum(wt * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(w) * nn) // l)))) AS BIGINT) AS score
  FROM q JOIN f USING (term) JOIN p USING (term) JOIN d USING (r), s GROUP BY ALL),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM x JOIN d USING (r) WHERE score > 0)
SELECT * FROM k WHERE rank <= 10"""
