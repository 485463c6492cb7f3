from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flowcast.sources import audit
from flowcast.sources.staging import stage

SCHEMA = "id int, part string, v double"
ROW = st.tuples(st.none() | st.integers(0, 6), st.sampled_from(["a", "b", None]), st.sampled_from([None, 0.5, 1.5]))


def by_hand(left, right):
    groups = defaultdict(lambda: (Counter(), Counter()))
    for side, rows in enumerate((left, right)):
        for r in rows:
            groups[r[:2]][side][r] += 1
    out = {}
    for key, (a, b) in groups.items():
        n, m = sum(a.values()), sum(b.values())
        if a != b:
            kind = "missing" if not m else "added" if not n else "fewer" if m < n else "repeated" if m > n else "changed"
            out[key] = (kind, n, m)
    return out


def found(rows):
    return {(r.id, r.part): (r.kind, r.source_rows, r.copy_rows) for r in rows.collect()}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=14), st.lists(ROW, max_size=14))
def test_differences_by_hand(spark, left, right):
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    assert found(audit.audit_differences(a, b, ["id", "part"])) == by_hand(left, right)


def test_equal_and_empty_tables(spark):
    rows = spark.range(1000).selectExpr("cast(id as int) id", "string(id % 7) part", "id / 3 v")
    assert audit.audit_differences(rows, rows.repartition(5), ["id", "part"]).count() == 0
    assert audit.audit_differences(rows.limit(0), rows.limit(0), ["id", "part"]).count() == 0
    assert {r.kind for r in audit.audit_differences(rows, rows.limit(0), ["id", "part"]).collect()} == {"missing"}
    with pytest.raises(ValueError):
        audit.audit_differences(rows, rows.drop("v"), ["id"])


def test_only_differing_leaves_are_read_again(spark):
    rows = spark.range(20000).selectExpr("cast(id as int) id", "string(id % 7) part", "id / 3 v")
    other = rows.selectExpr("id", "part", "if(id = 77, -1.0D, v) v")
    trees = [stage(audit.digest_tree(df, ["id"]), "tree") for df in (rows, other)]
    assert audit.differing_nodes(*trees).count() == 1
    sizes = dict(trees[0].groupBy("level").count().collect())
    assert sizes[0] == 64 and sizes[1] <= 4096 and sizes[2] <= 20000
    assert {r.n for r in trees[0].groupBy("level").agg({"n": "sum"}).toDF("level", "n").collect()} == {20000}
    kept = audit.audit_differences(rows, other, ["id"], source_tree=trees[0]).collect()
    assert [(r.id, r.kind) for r in kept] == [(77, "changed")]
