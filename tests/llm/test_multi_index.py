import numpy as np
import pytest

from flowcast.llm import multi_index as m


def brute(ids, vectors, query, k=10):
    at = np.flatnonzero(ids == query)[0]
    others = np.flatnonzero(ids != query)
    dist = np.sqrt(((vectors[others].astype(float) - vectors[at].astype(float)) ** 2).sum(1))
    best = np.lexsort((ids[others], dist))[:k]
    return list(zip(ids[others][best].tolist(), dist[best].tolist()))


def frame(spark, ids, vectors, kind="float"):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)], f"vec_id long, embedding array<{kind}>")


def run(df, step=20, **more):
    out = {}
    for r in m.neighbours(df, lambda i: i % step == 0, **more).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_all_cells_give_brute_force_and_default_recall(spark):
    r = np.random.default_rng(1)
    ids, vectors = np.arange(1500), r.standard_normal((1500, 16)).astype(np.float32)
    vectors[700:900] = vectors[5]                     # a group of copies, all ties
    df = frame(spark, ids, vectors)
    want = {q: brute(ids, vectors, q) for q in range(0, 1500, 20)}
    assert run(df, visit=2.0, centroids=8) == want
    got = run(df)
    assert all(len(x) == 10 for x in got.values())
    share = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]
    assert np.mean(share) >= 0.9
    assert all(dict(brute(ids, vectors, q, 1499))[i] == d for q in (0, 20) for i, d in got[q])


def test_walk_goes_by_summed_distance():
    r = np.random.default_rng(3)
    first, second = r.random(7), r.random(5)
    weight = r.integers(0, 3, 35).tolist()
    order = sorted(range(35), key=lambda c: first[c // 5] + second[c % 5])
    assert m.walk(first, second, weight, 10 ** 9) == order
    short = m.walk(first, second, weight, 12)
    assert short == order[:len(short)] and sum(weight[c] for c in short) >= 12 > sum(weight[c] for c in short[:-1])


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [2.0, 2.0]), (1, [1.0, nan]), (2, [inf, 1.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [1.0]),
            (None, [1.0, 2.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (0, [9.0, 9.0]), (8, [1.0, 3.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, id int")
    got = run(df)
    assert set(got) == {0, 20}
    near = got[20]
    assert near[0] == (0, 1.0) and near[1:3] == [(7, 1.0), (7, 1.0)] and {i for i, _ in near} == {0, 7, 8}
    assert all(i != 0 for i, _ in got[0])


def test_empty_and_single(spark):
    assert run(frame(spark, [], [])) == {}
    assert run(frame(spark, [0], [[1.0, 1.0]])) == {}
    assert run(frame(spark, [0, 1], [[1.0], [3.0]])) == {0: [(1, 2.0)]}


@pytest.mark.parametrize("norm", [1e3, 1e6, 1e7])
def test_rounding_of_large_vectors_loses_no_neighbour(norm):
    r = np.random.default_rng(8)
    vectors = norm + 0.1 * r.standard_normal((400, 16))
    ids, cell = np.arange(400), np.zeros(400, np.int32)
    for q, near, dist in m.rerank(ids[:20], vectors[:20], np.ones((20, 1), bool), ids, cell, vectors, 10):
        assert list(zip(near.tolist(), dist.tolist())) == brute(ids, vectors, q)


def test_distances_beyond_the_range_of_squares():
    vectors = np.array([[1e200, 0.0], [1e200, 1.0], [-1e200, 3.0], [1e200, 2.0]])
    got = list(m.rerank(np.array([0]), vectors[:1], np.ones((1, 1), bool), np.arange(4), np.zeros(4, np.int32), vectors, 2))
    assert got[0][1].tolist() == [1, 3] and got[0][2].tolist() == [1.0, 2.0]
