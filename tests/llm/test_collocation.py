import random
import re
from collections import Counter

import numpy as np
import pytest

from flowcast.llm import collocation as co
from flowcast.llm.count_automata import DEPTH, Transducer, prefixes, sort_rows

from tests.llm.conftest import prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(docs):
    """{lang: counts of all n-grams, as tuples}"""
    out = {}
    for lang, text in docs:
        count = out.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for i in range(len(words)):
                count.update(tuple(words[i:j]) for j in range(i + 1, min(i + 5, len(words)) + 1))
    return out


def brute(docs, least, share=100, top=2000):
    out = []
    for lang, f in grams(docs).items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        candidates = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        rows = []
        for g, a in candidates.items():
            if any(len(h) > len(g) and 100 * b >= share * a and any(h[i:i + len(g)] == g for i in range(len(h)))
                   for h, b in candidates.items()):
                continue
            score, k = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, first, rest) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, first, rest, n, -score))
    return sorted(out)


def corpus(seed, n):
    r = random.Random(seed)
    lines = [prose(seed + k, 9) for k in range(6)]
    docs = []
    for i in range(n):
        text = " ".join([prose(r.random(), r.randint(1, 60)), r.choice(lines), "of the " + prose(r.random(), 3), "é.ñ\tÉ x\r\nX  y"])
        docs.append((r.choice(["en", "fr", None, "x\ny"]), text))
    return docs + [("en", lines[0])] * 50 + [(None, None), ("en", ""), ("de", " .\n")]


def run(spark, docs, **more):
    found = co.collocations(spark.createDataFrame(docs, "lang string, text string").repartition(3), **more)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("sizes", [{}, {"range_bytes": 3000, "shard_bytes": 700}])
def test_equals_counting_every_phrase(spark, sizes):
    docs = corpus(1, 150)
    assert run(spark, docs, least=12, **sizes) == brute(docs, 12)


def test_share_and_top(spark):
    docs = corpus(2, 100)
    assert run(spark, docs, least=8, share=60, top=7, range_bytes=5000) == brute(docs, 8, 60, 7)


def test_a_hot_pair_and_one_long_text_are_counted_whole(spark):
    r = random.Random(5)
    docs = [("en", " ".join("hot pair " + r.choice("abcdefgh") for _ in range(4000))), ("en", "a " * 3000), ("en", "w" * 5000)]
    assert run(spark, docs, least=100, range_bytes=2000, shard_bytes=900) == brute(docs, 100)


def test_odd_rows(spark, odd, none):
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert sorted(tuple(r) for r in co.collocations(odd, least=40).collect()) == brute(rows, 40)
    assert co.collocations(none).count() == 0


def sample_rows(seed, n=400, words=6):
    r = np.random.default_rng(seed)
    rows = r.integers(1, words + 1, (n, DEPTH))
    ends = r.integers(1, DEPTH + 1, n)
    rows[np.arange(DEPTH)[None, :] >= ends[:, None]] = 0
    return sort_rows(rows, r.integers(1, 9, n))


@pytest.mark.parametrize("seed", range(8))
def test_a_transducer_gives_back_its_sequences(seed):
    rows, weights = sample_rows(seed, 10 ** (seed % 4))
    made = Transducer.decode(Transducer.build(rows, weights).encode())
    got = sort_rows(*made.rows())
    assert (got[0] == rows).all() and (got[1] == weights).all()
    counts = Counter()
    for row, w in zip(rows.tolist(), weights.tolist()):
        for d in range(1, DEPTH + 1):
            if row[d - 1]:
                counts[tuple(row[:d])] += w
    asked = [*counts, (7, 7), (1, 9), (1, 1, 1, 1, 1, 1)]
    table = np.zeros((len(asked), DEPTH), np.int64)
    for i, s in enumerate(asked):
        table[i, :len(s)] = s
    assert made.compose(table).tolist() == [counts[s] for s in asked]


def test_equal_states_are_merged():
    tails = [(2, 3, 4), (2, 5), (6,)]
    rows = np.zeros((30 * len(tails), DEPTH), np.int64)
    for i in range(30):
        for j, t in enumerate(tails):
            rows[i * len(tails) + j, :len(t) + 1] = (i + 10, *t)
    rows, weights = sort_rows(rows, np.ones(len(rows), np.int64))
    made = Transducer.build(rows, weights)
    assert len(made.words) == 30 + 5      # one copy of the tails for all thirty heads
    assert sum(len(first) for first, _ in prefixes(rows, weights)) == 30 * 6


def test_union_of_shards_is_the_transducer_of_all():
    parts = [sample_rows(seed) for seed in range(5)]
    rows, weights = Transducer.forest([(Transducer.build(*p), 6) for p in parts]).rows()
    rows, weights = sort_rows(np.where(rows > 0, (rows - 1) % 6 + 1, 0), weights)
    whole = sort_rows(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    assert (rows == whole[0]).all() and (weights == whole[1]).all()
    assert Transducer.build(rows, weights).encode() == Transducer.build(*whole).encode()


def test_exact_beyond_64_bits(spark):
    docs = [("en", "a b " * 5)] * 40
    (row, *_) = [r for r in run(spark, docs, least=100) if r[2] == "a b"] or [None]
    assert row is None or row[-1] == 1000 * row[3] * row[6] // (row[4] * row[5])
    big = spark.sql("SELECT (cast(900000000000 AS decimal(38,0)) * 1000 * 90000000000000) div (cast(1000000000 AS decimal(38,0)) * 100000000000) AS s")
    assert big.first().s == 900000000000 * 1000 * 90000000000000 // (1000000000 * 100000000000)
