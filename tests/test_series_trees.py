import itertools
import random

import pytest

from flowcast.models import series_trees as st


def brute(rows, features, depth, bins):
    """Nodes of one series' tree by plain recursion: {node: (feature, bin, m, mean)}."""
    lo = [min((r[f] for r in rows if r[f] is not None), default=None) for f in features]
    hi = [max((r[f] for r in rows if r[f] is not None), default=None) for f in features]

    def cell(r, i):
        v = r[features[i]]
        if v is None or hi[i] == lo[i]:
            return 0
        return max(0, min(bins - 1, int((v - lo[i]) * bins // (hi[i] - lo[i]))))

    out = {}

    def grow(part, node, left):
        m, t = len(part), sum(r["y"] for r in part)
        best = None
        for i in range(len(features)) if left else ():
            for b in range(bins - 1):
                a = [r["y"] for r in part if cell(r, i) <= b]
                c = [r["y"] for r in part if cell(r, i) > b]
                if a and c:
                    gain = sum(a) ** 2 / len(a) + sum(c) ** 2 / len(c)
                    if gain > t * t / m and (best is None or gain > best[0]) and any(cell(r, i) == b for r in part):
                        best = (gain, i, b)
        out[node] = (best and best[1], best and best[2], m, t / m)
        if best:
            grow([r for r in part if cell(r, best[1]) <= best[2]], 2 * node, left - 1)
            grow([r for r in part if cell(r, best[1]) > best[2]], 2 * node + 1, left - 1)

    grow(rows, 1, depth)
    return out


@pytest.fixture
def table(spark):
    r = random.Random(4)
    rows = [{"k": k, "a": float(r.randrange(9)), "b": r.choice([None, 1.0, 5.0, 7.0]), "y": float(r.randrange(50))}
            for k in ("x", "y", None) for _ in range(60)]
    rows += [{"k": "same", "a": 2.0, "b": None, "y": 3.0}] * 4
    return rows, spark.createDataFrame([tuple(r.values()) for r in rows], "k string, a double, b double, y double")


@pytest.mark.parametrize("depth", [1, 3])
def test_trees_equal_plain_recursion(table, depth):
    rows, df = table
    bounds, nodes = st.fit_trees(df, ["k"], "y", ["a", "b"], depth, bins=8)
    got = {}
    for n in nodes.collect():
        got.setdefault(n.k, {})[n.node] = (n.feature, n.bin, n.m, n.value)
    key = lambda r: r["k"] or ""
    for _, part in itertools.groupby(sorted(rows, key=key), key):
        part = list(part)
        assert got[part[0]["k"]] == brute(part, ["a", "b"], depth, 8)
    scored = st.predict_trees(df, bounds, nodes, ["k"], ["a", "b"], depth, 8).collect()
    leaf_error = sum((r.y - r.predicted) ** 2 for r in scored)
    mean = {k: n[1][3] for k, n in got.items()}
    assert len(scored) == len(rows) and leaf_error < sum((r.y - mean[r.k]) ** 2 for r in scored)


def test_ensemble_is_the_same_on_every_partitioning(table):
    _, df = table
    one, two = (st.fit_trees(df.repartition(n), ["k"], "y", ["a", "b"], 2, trees=5)[1] for n in (1, 7))
    rows = lambda t: sorted(map(repr, t.collect()))
    assert rows(one) == rows(two) and one.select("tree").distinct().count() == 5


def test_draws_follow_poisson(spark):
    out = spark.range(20000).select(st._draws("id", "id").alias("n")).groupBy("n").count().collect()
    share = {r.n: r["count"] / 20000 for r in out}
    assert abs(share[0] - 0.3679) < 0.02 and abs(share[1] - 0.3679) < 0.02 and abs(share[2] - 0.1839) < 0.02


def test_odd_rows(spark, table):
    _, df = table
    nan = float("nan")
    odd = spark.createDataFrame([("x", nan, None, 1.0), ("x", 1.0, 2.0, None), ("x", 1.0, 2.0, nan)], df.schema)
    bounds, nodes = st.fit_trees(odd, ["k"], "y", ["a", "b"])
    assert [(n.node, n.m, n.value, n.feature) for n in nodes.collect()] == [(1, 1, 1.0, None)]
    other = spark.createDataFrame([("new", 1.0, 1.0, 0.0), ("x", 9.0, None, 0.0)], df.schema)
    got = {r.k: r.predicted for r in st.predict_trees(other, bounds, nodes, ["k"], ["a", "b"]).collect()}
    assert got == {"new": None, "x": 1.0}
    bounds, nodes = st.fit_trees(df.limit(0), ["k"], "y", ["a", "b"])
    assert nodes.count() == 0
    with pytest.raises(ValueError):
        st.fit_trees(df, [], "y", ["a"])
    with pytest.raises(ValueError):
        st.fit_trees(df, ["k"], "y", ["a"], depth=0)


def test_direct_forecast_learns_a_daily_pattern(series):
    df = series({"p": [100.0 if i % 24 < 12 else 10.0 for i in range(24 * 20)], "q": [5.0] * 480}, kind="double")
    out = st.direct_forecast(df.withColumn("now", df.n), ["kind"], "ts_hour", "n", ["now"], [1, 5, 13, 24], depth=5)
    got = {(r.kind, r.horizon): r.predicted for r in out.collect()}
    assert got == {("p", 1): 100.0, ("p", 5): 100.0, ("p", 13): 10.0, ("p", 24): 10.0, **{("q", h): 5.0 for h in (1, 5, 13, 24)}}
    with pytest.raises(ValueError):
        st.direct_forecast(df, ["kind"], "ts_hour", "n", [], [0])


def test_pairs_beyond_the_end_have_no_target(series):
    pairs = st.horizon_pairs(series({"p": [1, 2, 3]}), ["kind"], "ts_hour", "n", [1, 2])
    assert sorted((r.n, r.horizon, r.target) for r in pairs.collect() if r.target is not None) == [(1, 1, 2.0), (1, 2, 3.0), (2, 1, 3.0)]
    assert pairs.count() == 6
