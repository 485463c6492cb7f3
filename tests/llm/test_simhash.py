import random
from itertools import combinations

import xxhash

from flowcast.llm import simhash
from flowcast.llm.components import components
from tests.llm.conftest import prose


def plain_print(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def plain_components(prints):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations(list(root), 2):
        if (a ^ b).bit_count() <= 2:
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in prints}


def test_fingerprints():
    for text in ["", " \t", "One", "one  two", "Ünï CODE words HERE\x0bok x", prose(1), prose(2, 2000)]:
        assert simhash.fingerprint(text.encode()) == plain_print(text)


def test_groups_equal_brute_force(spark):
    r, rows = random.Random(1), []
    for i in range(60):
        words = prose(i, 150).split()
        rows.append((len(rows), " ".join(words)))
        for _ in range(r.choice([0, 0, 1, 4])):
            words[r.randrange(150)] = "changed"
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows), ""), (len(rows) + 1, " ")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    prints = {d: plain_print(t) for d, t in rows}
    root, first = plain_components(set(prints.values())), {}
    for d, p in sorted(prints.items()):
        first.setdefault(root[p], d)
    assert {r.doc_id: (r.fp % 2 ** 64, r.component) for r in got} == {d: (p, first[root[p]]) for d, p in prints.items()}
    assert len(set(first.values())) < len(prints) - 5


def test_links_join_exactly_what_is_within_two_bits(spark):
    r = random.Random(2)
    prints = [r.getrandbits(64) for _ in range(40)]
    for p in list(prints):
        prints += [p ^ sum(1 << b for b in r.sample(range(64), k)) for k in (1, 2, 2, 3)]
    signed = [(p - 2 ** 64 if p >= 2 ** 63 else p,) for p in set(prints)]
    edges = simhash.links(spark.createDataFrame(signed, "fp long")).collect()
    assert all(((e.a ^ e.b) % 2 ** 64).bit_count() <= 2 for e in edges)
    linked = {r.node % 2 ** 64: r.root % 2 ** 64 for r in components(spark.createDataFrame(edges)).collect()}
    want = plain_components(set(prints))
    same = lambda m: {frozenset(p for p in set(prints) if m.get(p, p) == q) for q in {m.get(p, p) for p in set(prints)}}
    assert same(linked) == same(want)


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, 300), (300, 250), (7, 7)]
    out = components(spark.createDataFrame(edges, "a long, b long"))
    assert {(r.node, r.root) for r in out.collect()} == {(i, 0) for i in range(101)} | {(200, 200), (250, 200), (300, 200)}


def test_odd_rows(odd, none):
    got = {(r.doc_id, r.fp, r.component) for r in simhash.near_duplicates(odd).collect()}
    assert {c for d, f, c in got if d in (0, 1, 2)} == {0}
    assert {c for d, f, c in got if d in (4, 7)} == {4}
    assert {c for d, f, c in got if d is None} == {None}
    assert simhash.near_duplicates(none).collect() == [] and simhash.deduplicate(none).columns == none.columns


def test_one_document_of_each_group_stays(odd):
    out = simhash.deduplicate(odd)
    assert out.schema == odd.schema
    assert sorted((r.doc_id for r in out.collect()), key=str) == [0, 3, 4, 8, 9, None]


def test_rows_of_one_id_with_unlike_texts_stay_both(spark):
    a, b, c = (" ".join(f"{w}{i}" for i in range(60)) for w in ("river", "stone", "cloud"))
    rows = [(1, a, 1), (1, b, 2), (2, a, 3), (3, c, 4), (3, c, 5), (None, c, 6), (None, b, 7), (9, None, 8), (8, "", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key long")
    for parts in (1, 4):
        out = simhash.deduplicate(docs.repartition(parts))
        found = sorted(((r.doc_id, r.text, r.key) for r in out.collect()), key=str)
        assert out.columns == docs.columns
        assert [(i, t) for i, t, _ in found] == sorted([(1, a), (1, b), (3, c), (8, "")], key=str)
        assert parts == 1 or found == before
        before = found
