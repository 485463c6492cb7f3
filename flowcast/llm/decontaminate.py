"""Benchmark decontamination: a BM25 index of test items searched by every training passage.

The inverted index holds the test items. Term weights use document frequencies over all
training documents, counted for the index vocabulary only. Every document is cut into
overlapping passages of ``2 * L`` words every ``L`` words (``L``: the longest item and a quarter more), so each
possible copy of an item lies inside one passage. A passage is the query, all its distinct words
the terms. An item is retrieved if its score reaches ``THRESHOLD`` of its score against itself; scores
are divided by that, so one bound, 1, serves all items.

Block-max WAND finds them: terms are split into essential ones and the rest, whose maxima together stay below
the bound; a passage whose essential terms cannot lift any item over the bound is passed over in bulk.
The others walk the posting lists by pivots and block maxima. No candidate is capped.

Retrieved items are verified: words in shingles of five; the share of the question's and of the
answer's shingles (the last sentence is the answer) found in the passage. An item counts as leaked
if both parts, or the item as a whole, reach ``OVERLAP``.

The index is sent to the executors in shards of at most ``SHARD_ITEMS`` items and ``SHARD_CHARS`` characters; a
larger benchmark is searched shard after shard, with the same result.

Defined results: null texts are empty; items without words are never found; null ids are kept; repeated
rows are judged alike; an empty table of documents or items finds nothing and removes nothing.
"""

import bisect
import math
import re
from collections import Counter
from itertools import repeat
from itertools import repeat

import numpy as np
from pyspark.sql import functions as F

from flowcast.llm.frames import arrow_map, slices, texts

K1, B, THRESHOLD, OVERLAP, SHINGLE, BLOCK = 1.2, 0.75, 0.5, 0.8, 5, 8
SHARD_ITEMS, SHARD_CHARS = 20000, 32_000_000
HIT = "item_id long, score double, question_overlap double, answer_overlap double, item_overlap double"

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words_of(text):
    return _WORD.findall(text.lower())


def shingles(words):
    """The set of shingles; fewer words than a shingle holds: the whole sequence."""
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(SHINGLE))))


def parts(text):
    """Words of the question and of the answer; a single sentence is both."""
    pieces = [p for p in _SENTENCE.split(text.strip()) if words_of(p)]
    if len(pieces) < 2:
        return words_of(text), words_of(text)
    return words_of(" ".join(pieces[:-1])), words_of(pieces[-1])


def overlap(needle, words, within):
    """Share of a part's shingles in a passage. A part shorter than a shingle must stand there in one piece."""
    if not needle:
        return 0.0
    if len(needle) < SHINGLE:
        n = len(needle)
        return float(any(words[i:i + n] == needle for i in range(len(words) - n + 1)))
    own = shingles(needle)
    return len(own & within) / len(own)


class Index:
    """Posting lists of one shard of items, scores divided by each item's bound."""

    def __init__(self, items, frequency, documents):
        self.items = [(i, t) for i, t in items if words_of(t)]
        counts = [Counter(words_of(t)) for _, t in self.items]
        lengths = [sum(c.values()) for c in counts]
        mean = sum(lengths) / len(lengths) if lengths else 1.0
        self.longest = math.ceil(1.25 * max(lengths, default=1))
        self.terms = {t: i for i, t in enumerate(sorted({t for c in counts for t in c}))}
        idf = {t: math.log(1 + (documents - frequency.get(t, 0) + 0.5) / (frequency.get(t, 0) + 0.5)) for t in self.terms}
        lists = [[] for _ in self.terms]
        essential = [[] for _ in self.terms]
        self.need = np.zeros(len(self.items))
        for n, (count, length) in enumerate(zip(counts, lengths)):
            weight = {t: idf[t] * f * (K1 + 1) / (f + K1 * (1 - B + B * length / mean)) for t, f in count.items()}
            bound = THRESHOLD * sum(weight.values())
            rest = 0.0
            for t, w in sorted(weight.items(), key=lambda x: (x[1], x[0])):
                w /= bound
                lists[self.terms[t]].append((n, w))
                if rest + w < 0.5:    # together these stay below half of the bound
                    rest += w
                else:
                    essential[self.terms[t]].append((n, w))
            self.need[n] = 1 - rest - 1e-9
        self.postings = [([n for n, _ in p], [w for _, w in p]) for p in lists]
        self.tops = [[max(w[i:i + BLOCK]) for i in range(0, len(w), BLOCK)] for _, w in self.postings]
        self.top = [max(t) for t in self.tops]
        sizes = np.array([len(e) for e in essential] or [0])
        self.first = np.r_[0, np.cumsum(sizes)]
        self.essential_item = np.array([n for e in essential for n, _ in e], np.int64)
        self.essential_weight = np.array([w for e in essential for _, w in e])

    def search(self, terms):
        """{item: score} of all items scoring 1 or more, by block-max WAND."""
        found, at = {}, {t: 0 for t in terms}
        alive = [t for t in at if self.postings[t][0]]
        while alive:
            alive.sort(key=lambda t: self.postings[t][0][at[t]])
            total, pivot = 0.0, None
            for p, t in enumerate(alive):
                total += self.top[t]
                if total >= 1 - 1e-9:
                    pivot = p
                    break
            if pivot is None:
                break
            item = self.postings[alive[pivot]][0][at[alive[pivot]]]
            while pivot + 1 < len(alive) and self.postings[alive[pivot + 1]][0][at[alive[pivot + 1]]] == item:
                pivot += 1
            block_total, ends = 0.0, []
            for t in alive[:pivot + 1]:
                ids = self.postings[t][0]
                i = bisect.bisect_left(ids, item, at[t])
                if i < len(ids):
                    block_total += self.tops[t][i // BLOCK]
                    ends.append(ids[min(len(ids), (i // BLOCK + 1) * BLOCK) - 1])
            if block_total >= 1 - 1e-9:
                score = 0.0
                for t in alive[:pivot + 1]:
                    ids, ws = self.postings[t]
                    at[t] = bisect.bisect_left(ids, item, at[t])
                    if at[t] < len(ids) and ids[at[t]] == item:
                        score += ws[at[t]]
                        at[t] += 1
                if score >= 1 - 1e-9:
                    found[item] = score
                reach = item + 1
            else:  # no item up to the nearest block end, or the next list's item, can pass
                reach = min(ends) + 1 if ends else item + 1
                if pivot + 1 < len(alive):
                    reach = min(reach, self.postings[alive[pivot + 1]][0][at[alive[pivot + 1]]])
                reach = max(reach, item + 1)
            for t in alive[:pivot + 1]:
                at[t] = bisect.bisect_left(self.postings[t][0], reach, at[t])
            alive = [t for t in alive if at[t] < len(self.postings[t][0])]
        return found

    def passages(self, docs):
        """Numbers (document, passage) of all passages that some item may pass in, in bulk."""
        cell, term, base, starts = [], [], 0, []
        get = self.terms.get
        for words in docs:
            ids = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
            where = np.flatnonzero(ids >= 0)
            cell.append(base + where // self.longest)
            term.append(ids[where])
            starts.append(base)
            base += len(words) // self.longest + 2  # one cell between documents
        if not docs or not len(self.items):
            return
        cell, term = np.concatenate(cell), np.concatenate(term)
        size = self.first[term + 1] - self.first[term]
        cell, term = cell[size > 0], term[size > 0]
        both = np.r_[cell, np.maximum(cell - 1, 0)]        # passage n covers cells n and n + 1
        key = np.unique(both * len(self.terms) + np.r_[term, term])
        passage, term = key // len(self.terms), key % len(self.terms)
        size = self.first[term + 1] - self.first[term]
        row = np.repeat(np.arange(len(term)), size)
        spot = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.first[term], size)
        pair = passage[row] * len(self.items) + self.essential_item[spot]
        pair, back = np.unique(pair, return_inverse=True)
        lift = np.bincount(back, self.essential_weight[spot], len(pair))
        hit = np.unique(pair[lift >= self.need[pair % len(self.items)]] // len(self.items))
        doc = np.searchsorted(starts, hit, side="right") - 1
        yield from zip(doc.tolist(), (hit - np.array(starts)[doc]).tolist())

    def hits(self, docs):
        """For each document's words: {item id: (score, question, answer, item overlap)} of leaked items."""
        out = [{} for _ in docs]
        for d, p in self.passages(docs):
            words = docs[d][p * self.longest:(p + 2) * self.longest]
            terms = {self.terms[w] for w in words if w in self.terms}
            within = None
            for n, score in self.search(terms).items():
                within = within if within is not None else shingles(words)
                item, text = self.items[n]
                question, answer = parts(text)
                q, a, whole = (overlap(x, words, within) for x in (question, answer, words_of(text)))
                if min(q, a) >= OVERLAP or whole >= OVERLAP:
                    out[d][item] = max(out[d].get(item, (0.0,)), (score * THRESHOLD, q, a, whole))
        return out


def _frequencies(batch, vocabulary):
    seen, n = Counter(), 0
    for text in batch.column("text").to_pylist():
        seen.update(vocabulary.intersection(words_of(text)))
        n += 1
    return {"term": [*seen, ""], "n": [*seen.values(), n]}


def indexes(docs, items, id_col="item_id", text_col="text", doc_text="text"):
    """One index per shard of items, with statistics over all documents."""
    spark = docs.sparkSession
    rows = texts(items, id_col, text_col).select(F.col("id").cast("long").alias("id"), "text")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    shards = max(1, -(-size.n // SHARD_ITEMS), -(-(size.chars or 0) // SHARD_CHARS))
    shard = F.pmod(F.xxhash64("id", "text"), F.lit(shards))
    for number in range(shards):
        some = [(r.id, r.text) for r in rows.where(shard == number).orderBy("id", "text").collect()]
        vocabulary = frozenset(w for _, t in some for w in words_of(t))
        if not vocabulary:
            continue
        plain = docs.select(F.coalesce(docs[f"`{doc_text}`"], F.lit("")).alias("text"))
        counts = arrow_map(plain, "term string, n long", _frequencies, vocabulary)
        frequency = {r.term: r.n for r in counts.groupBy("term").agg(F.sum("n").alias("n")).collect()}
        yield spark.sparkContext.broadcast(Index(some, frequency, frequency.pop("", 0)))


def _leaks(batch, index):
    parts_ = [_leaks_in(part, index) for part in slices([batch])]
    return {n: [x for p in parts_ for x in p[n]] for n in parts_[0]}


def _leaks_in(batch, index):
    docs = [words_of(t) for t in batch.column("text").to_pylist()]
    ids = batch.column("id").to_pylist()
    rows = [(d, item, *values) for d, found in zip(ids, index.value.hits(docs)) for item, values in sorted(
        found.items(), key=lambda x: (x[0] is None, x[0]))]
    names = ("id", "item_id", "score", "question_overlap", "answer_overlap", "item_overlap")
    return dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}


def leaks(docs, items, id_col="doc_id", text_col="text", item_id="item_id", item_text="text"):
    """(id, item_id, score, overlaps): every leaked item of every document."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, {HIT}"
    out = docs.sparkSession.createDataFrame([], schema)
    for index in indexes(docs, items, item_id, item_text, text_col):
        out = out.unionAll(arrow_map(texts(docs, id_col, text_col), schema, _leaks, index))
    return out.withColumnRenamed("id", id_col)


def clean(docs, items, text_col="text", item_id="item_id", item_text="text"):
    """The rows without any leaked item, columns as they are. Nothing is shuffled."""
    place, kind = docs.columns.index(text_col), docs.schema
    names = [f"c{i}" for i in range(len(docs.columns))]
    out = docs.toDF(*names)
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, kind))
    for index in indexes(docs, items, item_id, item_text, text_col):
        def keep(batches, index=index):
            for batch in slices(batches, names[place]):
                found = index.value.hits([words_of(t or "") for t in batch.column(place).to_pylist()])
                yield batch.filter(_mask(not f for f in found))
        out = out.mapInArrow(keep, schema)
    return out.toDF(*docs.columns)


def _mask(flags):
    import pyarrow as pa
    return pa.array(list(flags), pa.bool_())
