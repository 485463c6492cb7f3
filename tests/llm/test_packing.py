import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flowcast.llm import packing
from tests.llm.conftest import prose

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", " ", "One, two; three!", "a<|endoftext|>b", "A<|ENDOFTEXT|>B", "Ǆ Σίσυφος Σ", "É ́a", "x y z \x1cq", "it's I'M 'S don't'S",
         "日本語 12３ ０ 0", "\x00a\x0bb", "İstanbul ﬁ", "K Å q0w0 0", "Größe, Ñandú... (über)", prose(1), "wört," * 3000]


def exact(text, tokenizer=Tokenizer.from_file(PATH)):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_the_tokenizers(text):
    assert packing.tokenise(text.encode(), PATH) == np.array(exact(text), "<u4").tobytes()


@pytest.mark.parametrize("pair", ["H\u0331", "J\u030c", "T\u0308", "W\u030a", "Y\u030a", "T\u0344", "H\u0323\u0331", "E\u0301"])
def test_capitals_with_marks_are_composed_before_they_are_folded(pair):
    for text in (f"{pair}una", f"One {pair}adith, Two a{pair}B {pair.lower()}una X", f"{pair} É {pair}{pair}"):
        assert packing.tokenise(text.encode(), PATH) == np.array(exact(text), "<u4").tobytes()


def test_ids_do_not_depend_on_the_cache(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_BYTES", 3000)
    packing._WORDS.clear()
    for text in TEXTS * 2:
        assert packing.tokenise(text.encode(), PATH) == np.array(exact(text), "<u4").tobytes()
    packing._WORDS.clear()


def check_plan(plan, histogram, capacity):
    got = Counter()
    for config, copies in plan:
        assert copies > 0 and sum(s * k for s, k in config) <= capacity
        for s, k in config:
            got[s] += k * copies
    assert got == Counter(histogram)


@pytest.mark.parametrize("histogram", [
    {}, {1: 5}, {4096: 3}, {2049: 50, 1024: 60, 1023: 50, 3: 10}, {1366: 1000, 1365: 3000, 700: 500, 2048: 300}])
def test_plans(histogram):
    plan = packing.make_plan(histogram)
    check_plan(plan, histogram, 4096)
    check_plan(packing.best_fit(dict(histogram), 4096), histogram, 4096)
    assert sum(c for _, c in plan) <= sum(c for _, c in packing.best_fit(dict(histogram), 4096))


def test_a_plan_of_many_lengths_comes_from_the_program():
    histogram = {i: i % 7 + 1 for i in range(1, 4097, 3)}
    plan = packing.make_plan(histogram)
    check_plan(plan, histogram, 4096)
    assert sum(c for _, c in plan) <= 1.01 * sum(s * n for s, n in histogram.items()) / 4096 + 1


@pytest.mark.parametrize("sizes, most, scale", [((129, 64, 43, 17), 60, 1), (range(16, 257, 3), 9, 40)])
def test_the_program_is_near_its_dual_bound(sizes, most, scale):
    r = random.Random(7)
    sizes = np.array(sorted(sizes))
    demand = np.array([scale * r.randint(1, most) for _ in sizes], float)
    found, bound = packing.program(sizes, demand, 256)
    covered = Counter()
    for key, x in found.items():
        assert sum(sizes[j] * k for j, k in key) <= 256
        for j, k in key:
            covered[j] += k * x
    assert all(covered[j] >= demand[j] * (1 - 1e-9) for j in range(len(sizes)))
    assert sizes @ demand / 256 <= bound * (1 + 1e-9)
    assert bound <= sum(found.values()) * (1 + 1e-9) and sum(found.values()) <= 1.02 * bound + 1


def test_the_program_alone_is_near_the_bound():
    r = random.Random(3)
    sizes = Counter(max(1, int(r.lognormvariate(6.2, 1.0))) for _ in range(30000))
    sizes = {min(s, 4096): n for s, n in sizes.items()}
    left, classes = dict(sizes), {}
    for length in sorted(left, reverse=True):
        if length >= packing.LEAST_UNITS * 16:
            classes.setdefault(-(-length // 16), []).append(length)
    units = np.array(sorted(classes))
    demand = np.array([sum(sizes[n] for n in classes[c]) for c in units], float)
    found = packing.solve(units, demand, 256)
    covered = Counter()
    for key, x in found.items():
        assert sum(units[j] * k for j, k in key) <= 256
        for j, k in key:
            covered[j] += k * x
    assert all(covered[j] >= demand[j] - 1e-6 for j in range(len(units)))
    named = {tuple((int(units[j]), k) for j, k in key): x for key, x in found.items()}
    plan = packing.best_fit(left, 4096, packing.round_down(named, classes, left))
    check_plan(plan, sizes, 4096)
    assert sum(c for _, c in plan) <= 1.01 * sum(s * n for s, n in sizes.items()) / 4096 + 1


def test_pricing_is_optimal():
    r = np.random.default_rng(1)
    for _ in range(20):
        sizes = np.sort(r.choice(np.arange(2, 15), 4, replace=False))
        price = r.random(4)
        counts = packing.price_knapsack(sizes, price, np.full(4, 99), 24)
        best = max(price @ np.array([a, b, c, e]) for a in range(13) for b in range(13) for c in range(13) for e in range(13)
                   if sizes @ np.array([a, b, c, e]) <= 24)
        assert sizes @ counts <= 24 and abs(price @ counts - best) < 1e-9


def test_sequences(spark):
    rows = [(i, prose(i, random.Random(i).randint(0, 400))) for i in range(300)] + [(1000, prose(7, 20000)), (1001, None), (1001, None)] + [
        (2000 + i, "same words") for i in range(200)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH, capacity=512).collect()
    want = Counter()
    for i, t in rows:
        ids = exact(t)
        for n, a in enumerate(range(0, len(ids), 512)):
            piece = ids[a:a + 512]
            want[i, n, a, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    used = defaultdict(list)
    for r in got:
        used[r.sequence_id].append((r.offset, r.length))
    for parts in used.values():
        parts.sort()
        assert [a for a, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]] and sum(n for _, n in parts) <= 512
    assert len(used) <= -(-sum(r.length for r in got) // 512) + 2


def test_odd_rows(odd, none):
    got = packing.pack(odd, PATH).collect()
    assert Counter(r.doc_id for r in got if r.piece == 0) == Counter(r.doc_id for r in odd.collect())
    assert {r.length for r in got if r.doc_id in (0, 1, 2)} == {1}
    assert packing.pack(none, PATH).collect() == []
