import random

from flowcast.llm import decontaminate as d
from tests.llm.conftest import WORDS, prose


def items(n=30):
    r = random.Random(9)
    return [(i, " ".join(r.choice(WORDS) + str(r.randint(0, 9)) for _ in range(r.randint(12, 40))) + ". " + prose(i, 6)) for i in range(n)]


def test_search_equals_scoring_every_item():
    own, r = items(200), random.Random(1)
    index = d.Index(own, {w: r.randint(1, 50) for w in WORDS}, 100)
    exact = [{} for _ in own]
    for t, (ids, scores) in enumerate(index.postings):
        for n, w in zip(ids, scores):
            exact[n][t] = w
    some = 0
    for _ in range(300):
        base = r.choice(own)[1].split()
        words = d.words_of(" ".join(r.sample(base, r.randint(2, len(base))) + prose(r.random(), r.randint(0, 40)).split()))
        terms = {index.terms[w] for w in words if w in index.terms}
        want = {n: sum(w for t, w in e.items() if t in terms) for n, e in enumerate(exact)}
        got = index.search(terms)
        assert set(got) == {n for n, s in want.items() if s >= 1 - 1e-9}
        assert all(abs(got[n] - want[n]) < 1e-9 for n in got)
        some += len(got)
    assert some > 100


def brute(rows, own):
    out = set()
    for i, text in rows:
        words = d.words_of(text or "")
        within = d.shingles(words)
        for n, item in own:
            if d.words_of(item or ""):
                q, a = d.parts(item)
                if min(d.overlap(x, words, within) for x in (q, a)) >= d.OVERLAP or d.overlap(d.words_of(item), words, within) >= d.OVERLAP:
                    out.add((i, n))
    return out


def planted(own):
    rows = []
    for k in range(60):
        text = prose(100 + k, 300).split()
        if k % 3 == 0:
            at = (k * 7) % 250
            text[at:at] = own[k % len(own)][1].split()
        if k % 9 == 0:
            text += own[(k + 1) % len(own)][1].upper().replace(" ", " ,\n").split()
        if k % 5 == 1:
            text[5:5] = own[k % len(own)][1].split()[:12]
        rows.append((k, " ".join(text)))
    return rows


def test_leaks_equal_brute_force(spark):
    own = items()
    rows = planted(own)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(own, "item_id long, text string")
    got = d.leaks(docs, bench).collect()
    want = brute(rows, own)
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) >= 20
    kept = {r.doc_id for r in d.clean(docs, bench).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in want}


def test_shards_of_items_give_the_same(spark, monkeypatch):
    own = items(12)
    docs = spark.createDataFrame(planted(own), "doc_id long, text string")
    bench = spark.createDataFrame(own, "item_id long, text string")
    pairs = lambda: {(r.doc_id, r.item_id) for r in d.leaks(docs, bench).collect()}
    one = pairs()
    monkeypatch.setattr(d, "SHARD_ITEMS", 5)
    assert pairs() == one and one


def test_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "Word"), (3, "Word"), (None, prose(4)), (5, prose(4, 40))], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.leaks(odd, bench).collect()}
    assert got == {(4, None), (7, None), (4, 5), (7, 5)}
    out = d.clean(odd, bench)
    assert out.schema == odd.schema and sorted((r.doc_id for r in out.collect()), key=str) == [0, 1, 2, 3, 8, 9, None]
    assert d.leaks(none, bench).collect() == [] and d.clean(odd, bench.limit(0)).count() == odd.count()
