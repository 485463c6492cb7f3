"""Phrase collocation mining by weighted automata over n-grams.

A phrase never crosses the end of a piece; everything is counted per language. The window of a word is its language, the word and
the up to four words after it in its piece, so each n-gram is the beginning of as many windows as it has occurrences.

1. Splitters: windows of a bounded random sample of documents (``SAMPLE``, or 16 a range if that is more) cut the order of all windows
   into ranges of about ``RANGE_BYTES`` of text. They balance the work; no result depends on them.
2. Every task cuts its texts into shards of ``SHARD_BYTES`` (long texts too, each shard sees the four words behind its
   end), sorts their windows, and builds one count transducer (``count_automata``) for each range that a shard has windows in.
   The shuffle moves transducers, not n-grams.
3. A range unites its transducers and sums their weights. N-grams of fewer than ``least`` occurrences are left behind, but for those that a
   splitter begins with: their windows are in several ranges, and their partial counts are summed before they are judged.
4. Frequent n-grams become one transducer a range, and the parts of all candidates are composed with the one of their range, which gives
   the parts' counts (each part is at least as frequent as its phrase, so none is missing).
5. Scores in exact decimals, the lowest cut of each phrase; phrases that stand in a longer one nearly as often as at all are dropped; the
   best ``top`` a language by one window with a limit before its shuffle.

A very common word or pair is spread over ranges by the words after it, and a window that recurs is one row a shard. Transducers
and splitters are the only tables that a task holds whole: some ``RANGE_BYTES`` and one splitter a range (40 bytes each). At 100 TB
raise ``range_bytes`` and ``shard_bytes`` together to what an executor holds, so that neither splitters nor transducers become too many.

Defined results: null texts are empty, null languages ``und``; texts without words add nothing; texts of any length count whole; repeated
rows count each; ties by occurrences, then by the phrase; other columns are ignored; an empty table gives an empty result.
"""

import bisect
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowcast.llm.count_automata import DEPTH, Transducer, prefixes, sort_rows
from flowcast.llm.frames import narrow, release, schema_of, slices, to_batches
from flowcast.sources.staging import stage

LEAST, SHARE, TOP, LONGEST = 100, 100, 2000, DEPTH - 1
SAMPLE, RANGE_BYTES, SHARD_BYTES = 50_000, 4_000_000, 8_000_000
PIECES = "range int, words array<binary>, states binary"
GRAMS = "lang string, phrase string, words int, f long"

# A-Z in lower case, tabs as spaces, every end of a piece as a line feed.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)
_GAP = re.compile(rb"[ \n]")
_BEHIND = re.compile(rb"(?: *[^ \n]+){0,%d}" % (LONGEST - 1))


def _units(lang, text, size):
    """Runs of a text: (language, bytes, end of the words that begin a window there)."""
    data, at = text.translate(_PLAIN), 0
    while at < len(data):
        gap = _GAP.search(data, at + size) if len(data) - at > size else None
        cut = gap.start() if gap else len(data)
        end = _BEHIND.match(data, cut).end() if gap else cut
        yield lang, data[at:end], cut - at
        at = cut


def windows(units):
    """(sorted words and languages, matrix of window rows by their numbers from 1) of some units."""
    data = b"\n".join(u[1] for u in units)
    offsets = np.cumsum([0] + [len(u[1]) + 1 for u in units])
    limit = offsets[:-1] + np.array([u[2] for u in units], np.int64)
    buffer = np.frombuffer(data, np.uint8)
    inside = (buffer != 32) & (buffer != 10)
    edge = np.flatnonzero(np.diff(inside, prepend=not inside[0])).astype(np.int32) if len(buffer) else np.zeros(0, np.int32)
    first = inside[edge] if len(edge) else np.zeros(0, bool)
    del inside
    runs = pa.BinaryArray.from_buffers(
        pa.binary(), len(edge), [None, pa.py_buffer(np.r_[edge, np.int32(len(buffer))]), pa.py_buffer(data)])
    start = edge[first]
    langs = pa.array([u[0] for u in units], pa.binary())
    words, codes = _ranked(pa.concat_arrays([runs.filter(pa.array(first)), langs]))
    del runs, edge, first
    piece = np.searchsorted(np.flatnonzero(buffer == 10).astype(np.int32), start).astype(np.int32)
    unit = (np.searchsorted(offsets, start, side="right") - 1).astype(np.int32)
    rows = np.zeros((len(start), DEPTH), np.int32)
    rows[:, 0] = codes[len(start):][unit]
    word = codes[:len(start)]
    for k in range(min(LONGEST, len(word))):
        rows[:len(word) - k, k + 1] = np.where(piece[k:] == piece[:len(word) - k], word[k:], 0)
    begins = start < limit[unit]
    return words, rows if begins.all() else rows[begins]


def _ranked(column):
    """(distinct values in byte order, number of each row's value from 1)."""
    coded = column.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int32)
    rank[order.to_numpy()] = np.arange(1, len(order) + 1)
    return coded.dictionary.take(order), rank[coded.indices.to_numpy()]


def _texts(docs, lang_col, text_col):
    return narrow(docs, lang=lang_col, text=text_col).select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def _shards(batches, size):
    units, held = [], 0
    for batch in slices(batches):
        langs = batch.column("lang").cast(pa.binary()).to_pylist()
        for lang, text in zip(langs, batch.column("text").cast(pa.binary()).to_pylist()):
            for unit in _units(lang, text, size):
                units.append(unit)
                held += len(unit[1])
                if held >= size:
                    yield units
                    units, held = [], 0
    if units:
        yield units


def _at(splitters, vocabulary, rows):
    """Where each splitter would stand among sorted rows."""
    def key(i):
        return tuple(vocabulary[w - 1] for w in rows[i].tolist() if w)
    return [bisect.bisect_left(range(len(rows)), s, key=key) for s in splitters]


def _transducers(splitters, shard_bytes, schema):
    """Of every shard one transducer a range, all in one batch."""
    def run(batches):
        for units in _shards(batches, shard_bytes):
            words, rows = windows(units)
            rows, counts = sort_rows(rows, np.ones(len(rows), np.int64))
            cuts = [0, *_at(splitters.value, words.to_pylist(), rows), len(rows)]
            ranges, ends, listed, states = [], [0], [], []
            for number, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                if a == b:
                    continue
                used, own = np.unique(rows[a:b], return_inverse=True)
                own = own.reshape(b - a, DEPTH) + (used[0] > 0)
                listed.append(used[used > 0] - 1)
                ranges.append(number)
                ends.append(ends[-1] + len(listed[-1]))
                states.append(Transducer.build(own, counts[a:b]).encode())
            if ranges:
                flat = words.take(pa.array(np.concatenate(listed))).cast(pa.binary())
                del rows, words
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ranges, pa.int32()), pa.ListArray.from_arrays(ends, flat).cast(schema.field("words").type),
                     pa.array(states, pa.binary())], schema=schema)
                del flat, states, listed
            release()
    return run


def _united(table):
    """Sorted words, rows and counts of all transducers of a range."""
    lists = table.column("words").combine_chunks()
    parts = [(Transducer.decode(s), n) for s, n in zip(
        table.column("states").to_pylist(), pc.list_value_length(lists).to_pylist())]
    rows, counts = Transducer.forest(parts).rows()
    del parts
    words, codes = _ranked(lists.flatten())
    return words, *sort_rows(np.r_[np.int32(0), codes][rows], counts)


def _joined(words, rows):
    """Words of each row, space-joined."""
    names = [b"", *words.to_pylist()]
    return [b" ".join(names[w] for w in row if w) for row in rows.tolist()]


def _frequent(splitters, least, schema):
    def run(key, table):
        words, rows, counts = _united(table)
        number = key[0].as_py()
        known = {w: n for n, w in enumerate(words.to_pylist(), 1)}
        edges = [[known.get(w, -1) for w in s] for s in splitters.value[max(number - 1, 0):number + 1]]
        columns = {"lang": [], "phrase": [], "words": [], "f": []}
        for d, (first, total) in enumerate(prefixes(rows, counts)):
            keep = (total >= least) | (d == 0)
            for edge in edges:      # n-grams whose windows may go on in the next range
                if len(edge) > d:
                    keep |= (rows[first, :d + 1] == edge[:d + 1]).all(axis=1)
            chosen = rows[first[keep], :d + 1]
            columns["lang"] += _joined(words, chosen[:, :1])
            columns["phrase"] += _joined(words, chosen[:, 1:])
            columns["words"] += [d] * len(chosen)
            columns["f"] += total[keep].tolist()
        cast = {"lang": pa.array(columns["lang"], pa.binary()).cast(pa.string()),
                "phrase": pa.array(columns["phrase"], pa.binary()).cast(pa.string())}
        del rows, counts, words, known
        release()
        return pa.Table.from_batches(to_batches({**columns, **cast}, schema), schema)
    return run


def _ranged(splitters, schema):
    """Adds the range of each (lang, phrase)."""
    def run(batches):
        for batch in batches:
            pairs = zip(batch.column("lang").cast(pa.binary()).to_pylist(), batch.column("phrase").cast(pa.binary()).to_pylist())
            at = [bisect.bisect_right(splitters.value, (lang, *phrase.split(b" "))) for lang, phrase in pairs]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], schema=schema)
    return run


def _sequences(table, known=None):
    """Rows of (lang, words of the phrase) by word number; a word out of ``known`` gets a number beyond."""
    pairs = list(zip(table.column("lang").cast(pa.binary()).to_pylist(), table.column("phrase").cast(pa.binary()).to_pylist()))
    split = [[lang, *phrase.split(b" ")] for lang, phrase in pairs]
    known = known or {w: n for n, w in enumerate(sorted({w for s in split for w in s}), 1)}
    rows = np.zeros((len(split), DEPTH), np.int64)
    for i, s in enumerate(split):
        rows[i, :len(s)] = [known.get(w, len(known) + 1) for w in s]
    return rows, known


def _composed(schema):
    def run(parts, grams):
        if not parts.num_rows:
            return pa.Table.from_batches([], schema)
        rows, known = _sequences(grams)
        order = np.lexsort(rows.T[::-1])
        rows, total = rows[order], grams.column("f").to_numpy()[order]
        # What an n-gram has beyond its continuations here: as weights of rows these give each state its full count.
        rest = total.copy()
        size, parent = (rows > 0).sum(axis=1), {}
        for i, row in enumerate(map(tuple, rows.tolist())):
            parent[row] = i
            up = parent.get((*row[:size[i] - 1], *(0,) * (DEPTH - size[i] + 1)))
            if up is not None:
                rest[up] -= total[i]
        weights = Transducer.build(rows, rest).compose(_sequences(parts, known)[0])
        return pa.Table.from_arrays([parts.column("lang"), parts.column("phrase"), pa.array(weights, pa.int64())], schema=schema)
    return run


def splitters_of(rows, range_bytes=RANGE_BYTES, shard_bytes=SHARD_BYTES):
    """Sorted windows that cut the order of all windows into ranges of about ``range_bytes`` of text."""
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    ranges = -(-size // range_bytes)
    if ranges < 2:
        return []
    wanted = max(SAMPLE, 16 * ranges)
    share = min(1.0, max(2000, wanted // 8) / n)
    stride = max(1, int(size * share / 6 / wanted))

    def run(batches):
        for units in _shards(batches, shard_bytes):
            words, found = windows(units)
            picked = found[::stride]
            yield pa.RecordBatch.from_arrays(
                [pa.array([[words[w - 1].as_py() for w in row if w] for row in picked.tolist()], pa.list_(pa.binary()))], ["window"])

    sample = rows.where(F.rand(7) < share).mapInArrow(run, "window array<binary>").distinct()
    found = sorted(tuple(bytes(w) for w in r.window) for r in sample.collect())
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


def frequent_phrases(docs, least=LEAST, lang_col="lang", text_col="text", range_bytes=RANGE_BYTES, shard_bytes=SHARD_BYTES):
    """((lang, phrase, words, f) of all n-grams of ``least`` occurrences, (lang, n) totals, splitters)."""
    spark = docs.sparkSession
    rows = _texts(docs, lang_col, text_col)
    splitters = spark.sparkContext.broadcast(splitters_of(rows, range_bytes, shard_bytes))
    pieces = rows.mapInArrow(_transducers(splitters, shard_bytes, schema_of(spark, PIECES)), PIECES)
    counted = pieces.groupBy("range").applyInArrow(_frequent(splitters, least, schema_of(spark, GRAMS)), GRAMS)
    summed = counted.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    grams = stage(summed.where((F.col("f") >= least) | (F.col("words") == 0)), "grams")
    return grams.where("words > 0"), grams.where("words = 0").select("lang", F.col("f").alias("n")), splitters


def part_counts(parts, grams, splitters):
    """(lang, phrase, f) of the wanted (lang, phrase) rows, by composition with the transducer of their range."""
    spark = parts.sparkSession
    kind = "lang string, phrase string"
    wanted = parts.mapInArrow(_ranged(splitters, schema_of(spark, kind + ", range int")), kind + ", range int")
    known = grams.select("lang", "phrase", "f")
    kind += ", f long"
    known = known.mapInArrow(_ranged(splitters, schema_of(spark, kind + ", range int")), kind + ", range int")
    return wanted.groupBy("range").cogroup(known.groupBy("range")).applyInArrow(_composed(schema_of(spark, kind)), kind)


def collocations(docs, least=LEAST, share=SHARE, top=TOP, lang_col="lang", text_col="text", **sizes):
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two to five words of every language.

    ``sizes`` are ``range_bytes`` and ``shard_bytes``; they change no result.
    """
    known, totals, splitters = frequent_phrases(docs, least, lang_col, text_col, **sizes)
    phrases = known.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    listed = phrases.withColumn("w", F.split("phrase", " "))

    def part(start, size):
        return F.array_join(F.slice("w", start, size), " ")

    cuts = listed.select("lang", "phrase", "a", "words", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.col("words")).alias("tail"))
    cuts = stage(cuts, "cuts")
    parts = cuts.select("lang", F.explode(F.array("head", "tail")).alias("phrase")).distinct()
    counts = stage(part_counts(parts, known, splitters), "parts")
    head = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tail = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    exact = F.expr("(cast(a AS decimal(38,0)) * 1000 * n) div (cast(l AS decimal(38,0)) * r)")
    scored = cuts.join(head, ["lang", "head"]).join(tail, ["lang", "tail"]).join(totals, "lang").withColumn("score", exact)
    lowest = scored.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # A longer phrase is no more frequent than the one a word shorter inside it, so that one decides.
    inside = listed.where("words > 2").select("lang", "a", F.explode(F.array(
        part(F.lit(1), F.col("words") - 1), part(F.lit(2), F.col("words") - 1))).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = lowest.join(inside, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle():
    """The same in DuckDB SQL: every n-gram counted as text."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS words, array_to_string(w[i:i + {k - 1}], ' ') AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM p)"
        for k in range(1, 6))
    return rf"""WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT coalesce(lang, 'und') AS lang,
  unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY 1),
g AS (SELECT lang, words, phrase, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, words, f AS a, string_split(phrase, ' ') AS w FROM g WHERE words > 1),
k AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS h, array_to_string(w[k + 1:], ' ') AS t
  FROM (SELECT *, unnest(range(1, words)) AS k FROM c)),
s AS (SELECT k.lang, k.phrase, a, k, x.f AS l, y.f AS r, n, CAST(1000::HUGEINT * a * n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM k JOIN g x ON x.lang = k.lang AND x.phrase = h JOIN g y ON y.lang = k.lang AND y.phrase = k.t JOIN t ON t.lang = k.lang),
b AS (SELECT lang, phrase, any_value(a) AS a, any_value(n) AS n, arg_min(l, (score, k)) AS l, arg_min(r, (score, k)) AS r, min(score) AS score
  FROM s GROUP BY ALL),
d AS (SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = b.lang AND c.phrase <> b.phrase
  AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * c.a >= 100 * b.a)),
o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score FROM d)
SELECT * FROM o WHERE rank <= 2000"""
