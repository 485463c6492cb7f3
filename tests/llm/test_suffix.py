import hashlib
import random

import numpy as np
import pytest

from flowcast.llm import suffix_dedup
from tests.llm.conftest import prose


def plain(rows):
    """{id: (bytes, removed, spans, hash)} by a dictionary of every string of 50 bytes."""
    least = {}
    for d, t in rows:
        data = (t or "").encode()
        for i in range(len(data) - 49):
            w = data[i:i + 50]
            least[w] = min(least.get(w, d), d)
    out = {}
    for d, t in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 49):
            if least[data[i:i + 50]] < d:
                gone[i:i + 50] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[d] = (len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def corpus(n, seed):
    r, rows = random.Random(seed), []
    shared = [prose(900 + i, 30) for i in range(5)]
    for d in range(n):
        parts = [prose(d, r.randint(0, 60))]
        if r.random() < 0.5:
            parts.insert(r.randint(0, 1), r.choice(shared)[r.randint(0, 40):])
        if r.random() < 0.2:
            parts.append("ab" * r.randint(20, 60))
        if rows and r.random() < 0.2:
            old = r.choice(rows)[1]
            parts.append(old[r.randint(0, 30):][:r.randint(40, 200)])
        rows.append((d, " ".join(parts)))
    return rows + [(n, rows[0][1]), (n + 1, "é" * 40), (n + 2, "xé" + "é" * 39), (n + 3, None), (n + 4, "z" * 49), (n + 5, "z" * 50)]


@pytest.mark.parametrize("hot, block_bytes", [(2_000_000, 1 << 24), (2, 3000), (0, 1000)])
def test_equals_brute_force(spark, hot, block_bytes):
    rows = corpus(150, hot + 1)
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot, block_bytes=block_bytes)
    want = plain(rows)
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want
    assert sum(w[1] for w in want.values()) > 3000


def test_every_string_has_one_anchor_by_its_content():
    data = (prose(1, 300) + "aaaa" * 50 + prose(1, 300)).encode()
    edges = np.array([0, len(data)])
    h, place, first, last, _ = suffix_dedup.anchors(np.frombuffer(data, np.uint8), edges)
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    assert sorted(starts) == list(range(len(data) - 49))
    offset = {}
    for p, a, b in zip(place, first, last):
        for s in range(a, b + 1):
            assert offset.setdefault(data[s:s + 50], p - s) == p - s


def test_anchors_do_not_depend_on_chunks(monkeypatch):
    data = np.frombuffer(prose(2, 2000).encode(), np.uint8)
    edges = np.array([0, 5000, len(data)])
    one = suffix_dedup.anchors(data, edges)
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 997)
    assert all(np.array_equal(a, b) for a, b in zip(one, suffix_dedup.anchors(data, edges)))


def test_multikey_sort():
    rows = np.random.default_rng(1).integers(0, 3, (500, 20)).astype(np.uint8)
    order = suffix_dedup.multikey_sort(suffix_dedup.words_of(rows))
    assert [rows[i].tobytes() for i in order] == sorted(r.tobytes() for r in rows)


def test_odd_rows(odd, none):
    got = suffix_dedup.remove_repeats(odd, keep_bytes=True).collect()
    assert len(got) == odd.count()
    by = {(r.doc_id, r.n_bytes): r for r in got}
    assert all(r.n_removed == 0 for r in got if r.doc_id in (None, 0, 1, 2, 4, 9))
    assert [r.n_removed == r.n_bytes and r.kept == b"" for r in got if r.doc_id == 7] == [True]
    assert by[9, 100000].n_spans == 0
    assert suffix_dedup.remove_repeats(none).collect() == []
