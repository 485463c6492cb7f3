import random

import pytest
from pyspark.sql import functions as F

from flowcast.llm import license_join as lj

from tests.llm.conftest import prose


def brute(text):
    """Places and the set of (label, start, containment), every block against every template."""
    words = lj.words_of(text or "")
    places = sorted((label, i) for phrase, label in lj.PHRASES.items() for i in range(len(words))
                    if words[i:i + len(phrase.split())] == phrase.split())
    matches = set()
    for label, notice in lj.TEMPLATES:
        cut = lj.words_of(notice)
        tokens, size = set(cut), lj.size_class(cut)
        for start in range(0, max(len(words) - size - 1, 0) + 1, size):
            common = len(tokens & set(words[start:start + 2 * size]))
            if common * 5 >= len(tokens) * 4:
                matches.add((label, start, common / len(tokens)))
    return len(words), places, matches


def texts():
    """Notices whole, worn, cut and scattered between prose, in texts of all lengths."""
    r = random.Random(3)
    out = []
    for n in range(120):
        label, notice = r.choice(lj.TEMPLATES)
        words = notice.split()
        if n % 3:
            words = [w for w in words if r.random() > 0.25 * (n % 3 - 1) + 0.05]
        if n % 4 == 0:
            r.shuffle(words)
        if n % 5 == 0:
            words = [w.upper() for w in words]
        out.append(" ".join([prose(n, r.randint(0, 60)), *words, prose(n + 1, r.randint(0, 60))]))
    return out + ["CC BY cc-by", "all rights reserved", "All Rights\nReserved. all rights reserved all rights", "İ CC BY é", "\x00cc\x01by"]


def test_finds_every_block_that_brute_force_finds(spark):
    rows = texts()
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in lj.scan(docs).collect()}
    hits = 0
    for n, text in enumerate(rows):
        words, places, matches = brute(text)
        assert got[n].n_words == words
        assert sorted((p.label, p.start) for p in got[n].places) == places
        assert {(m.label, m.start, m.containment) for m in got[n].matches} == matches
        hits += len(matches)
    assert hits > 60


def test_digest_columns(spark):
    docs = spark.createDataFrame([(1, "x all rights reserved y"), (2, "Released under the MIT License."), (3, "the river")],
                                 "doc_id long, text string")
    rows = {r.doc_id: r for r in lj.digest(lj.scan(docs)).collect()}
    assert (rows[1].n_base, rows[1].first_word, rows[1].last_word, rows[1].labels, rows[1].score) == (1, 1, 1, "reserved", 1.0)
    assert (rows[2].n_base, rows[2].base_labels, rows[2].labels, rows[2].score) == (0, "", "mit", 1.0)
    assert (rows[3].first_word, rows[3].labels, rows[3].score) == (None, "", 0.0)


def test_odd_rows_each_have_a_result(spark, odd, none):
    got = lj.scan(odd).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[0].n_words == by_id[1].n_words == by_id[2].n_words == 0
    assert by_id[0].matches == [] and by_id[0].places == []
    assert sum(r.doc_id is None for r in got) == 1 and sum(r.doc_id == 4 for r in got) == 2
    assert lj.digest(lj.scan(none)).count() == 0


def test_a_very_long_text_is_searched_to_its_end(spark):
    notice = dict((label, t) for label, t in lj.TEMPLATES)["bsd"]
    text = " ".join([prose(1, 200000), notice])
    (row,) = lj.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert {m.label for m in row.matches} == {"bsd"}


def test_equal_texts_and_ties_give_one_label_each(spark):
    text = "Released under the MIT License. " * 3
    rows = lj.digest(lj.scan(spark.createDataFrame([(1, text)] * 3, "doc_id long, text string"))).collect()
    assert [r.labels for r in rows] == ["mit"] * 3


def test_no_templates_and_too_many(spark, odd):
    assert all(r.matches == [] for r in lj.scan(odd, []).collect())
    with pytest.raises(ValueError, match="templates"):
        lj.scan(odd, [("x", "word " * (lj.MOST_WORDS + 1))])


def test_plan_is_native_and_joins_only_prefixes(spark):
    docs = spark.createDataFrame([(1, "all rights reserved")], "doc_id long, text string").select(
        "doc_id", F.col("text"))
    plan = lj.digest(lj.scan(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "BroadcastHashJoin" in plan
