import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from flowcast.llm import lexical_search as ls

from tests.llm.conftest import prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    """Every document scored for every item."""
    counts = [(i, Counter(cut(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n, total = len(counts), sum(s for _, _, s in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, size in counts:
            m = 10 + 90 * size * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in set(cut(text)) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, **more):
    found = ls.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                      spark.createDataFrame(items, "item_id long, text string"), **more)
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in found.collect()), key=str)


def corpus(seed, n):
    r = random.Random(seed)
    docs = [(i, prose(r.randint(0, n), r.randint(1, 120))) for i in range(n)]
    return docs + [(n + i, docs[5][1]) for i in range(40)]  # a group of copies: ties


def test_terms_of_all_bytes():
    text = "Ab1-cD_é2 \x00x\x7fy İZ" + "".join(map(chr, range(1, 400)))
    assert ls.terms_of(text) == cut(text)
    assert ls.terms_of("") == ls.terms_of(None) == ls.terms_of(" .") == []


def test_equals_scoring_every_document(spark, monkeypatch):
    docs, items = corpus(1, 400), [(i, prose(1000 + i, 25)) for i in range(30)] + [(99, corpus(1, 400)[5][1])]
    expected = brute(docs, items)
    assert run(spark, docs, items) == expected
    monkeypatch.setattr(ls, "BLOCK_CHARS", 600)     # many blocks of items
    assert run(spark, docs, items) == expected


@pytest.mark.parametrize("leaf", [0, 16, 256])
def test_small_shards_give_the_same(monkeypatch, leaf):
    monkeypatch.setattr(ls, "LEAF", leaf)
    docs = corpus(2, 200)
    vocabulary = sorted({t for _, x in docs for t in cut(x)})
    number = {t: i for i, t in enumerate(vocabulary)}
    query = np.array(sorted({number[t] for t in cut(docs[3][1]) if t in number}), np.int64)
    weights = np.array([ls.weight(len(docs), sum(t in cut(x) for _, x in docs)) for t in vocabulary])
    total = sum(len(cut(x)) for _, x in docs)
    results = []
    for size in (1, 7, 50, len(docs)):
        kept = []
        for at in range(0, len(docs), size):
            part = docs[at:at + size]
            counts = [sorted(Counter(number[t] for t in cut(x)).items()) for _, x in part]
            shard = ls.Shard(np.array([i for i, _ in part]), np.array([len(cut(x)) for _, x in part]),
                             np.array([t for c in counts for t, _ in c]), np.array([k for c in counts for _, k in c]),
                             [len(c) for c in counts], weights, len(docs), total)
            shard.search(query, 10, kept)
        results.append(sorted(kept))
    assert all(r == results[0] for r in results) and len(results[0]) == 10


def test_range_maxima_are_those_of_a_scan():
    r = np.random.default_rng(4)
    terms = np.repeat(np.arange(5), [1, 2, 9, 64, 33])
    sizes = np.bincount(np.concatenate([r.permutation(80)[:n] for n in (1, 2, 9, 64, 33)]), minlength=80)
    doc = np.concatenate([np.sort(r.permutation(80)[:n]) for n in (1, 2, 9, 64, 33)])
    by = np.argsort(doc, kind="stable")
    sizes = np.bincount(doc, minlength=80)
    shard = ls.Shard(np.arange(80), np.full(80, 10), terms[by], r.integers(1, 50, len(terms)), sizes, np.arange(1, 6) * 100, 80, 800)
    for _ in range(500):
        t, lo, hi = r.integers(5), *np.sort(r.integers(0, 81, 2))
        a, b = shard.ranges(np.array([t]), lo, hi)
        if b[0] > a[0]:
            assert shard.impact[shard.best(a, b)[0]] == shard.impact[a[0]:b[0]].max()


def test_far_fewer_documents_are_scored_than_there_are(monkeypatch):
    docs = [(i, prose(i, 40)) for i in range(3000)] + [(5000 + i, "zebra quartz " + prose(i, 10)) for i in range(30)]
    vocabulary = sorted({t for _, x in docs for t in cut(x)})
    number = {t: i for i, t in enumerate(vocabulary)}
    counts = [sorted(Counter(number[t] for t in cut(x)).items()) for _, x in docs]
    df = Counter(t for c in counts for t, _ in c)
    shard = ls.Shard(np.array([i for i, _ in docs]), np.array([len(cut(x)) for _, x in docs]),
                     np.array([t for c in counts for t, _ in c]), np.array([k for c in counts for _, k in c]), [len(c) for c in counts],
                     np.array([ls.weight(len(docs), df[t]) for t in range(len(vocabulary))]), len(docs), sum(len(cut(x)) for _, x in docs))
    seen, kept, plain = [], [], shard.best
    monkeypatch.setattr(shard, "best", lambda a, b: seen.append(1) or plain(a, b))
    shard.search(np.array(sorted(number[t] for t in ("zebra", "quartz", "the"))), 10, kept)
    assert {-late for _, late in kept} <= set(range(5000, 5030)) and len(seen) < 300


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "river market"), (3, "river market"), (None, "the"), (5, "?!")],
                                  "item_id long, text string").selectExpr("*", "1 AS rank", "'x' AS score")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in ls.search(odd, items).collect()), key=str)
    assert got == brute(rows, [(r.item_id, r.text) for r in items.collect()])
    assert ls.search(none, items).count() == 0 and ls.search(odd, items.limit(0)).count() == 0


def test_a_very_long_text_is_counted_whole(spark):
    docs = [(1, prose(1, 300000) + " zebra"), (2, "zebra zebra"), (3, prose(2, 50))]
    assert run(spark, docs, [(7, "zebra")]) == brute(docs, [(7, "zebra")])
