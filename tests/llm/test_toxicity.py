import random
import zlib

import numpy as np

from flowcast.llm import toxicity
from tests.llm.conftest import prose

BAD = ["nasty", "wretch", "lousyking", "lousyment", "lousyness", "grotty"]


def corpus(n=900):
    rows, labels = [], []
    for i in range(n):
        r, toxic = random.Random(i), i % 6 == 0
        words = prose(i, 60).split()
        if toxic:
            for _ in range(4):
                words.insert(r.randrange(60), r.choice(BAD))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic != (i % 50 == 7))))       # some labels are wrong
    return rows, labels


def run(spark, rows, labels, **more):
    return toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"),
                          spark.createDataFrame(labels, "doc_id long, toxic int"), **more).collect()


def test_held_out_rows_are_scored_well(spark):
    rows, labels = corpus()
    got = run(spark, rows, labels)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    right = [r.predicted == (r.doc_id % 6 == 0) for r in got if r.held_out]
    assert len(right) > 100 and sum(right) >= 0.99 * len(right)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_held_out_labels_are_never_read(spark):
    rows, labels = corpus(400)
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    score = lambda found: {r.doc_id: r.score for r in found}
    assert score(run(spark, rows, labels)) == score(run(spark, rows, turned))


def test_label_model_recovers_accuracies_and_a_correlation(spark):
    r = np.random.default_rng(2)
    y = r.random(20000) < 0.2
    accuracy = [(0.8, 0.05), (0.6, 0.1), (0.7, 0.02), (0.5, 0.3)]
    votes = np.stack([r.random(len(y)) < np.where(y, a, b) for a, b in accuracy], 1)
    votes = np.c_[votes, np.where(r.random(len(y)) < 0.9, votes[:, 3], r.random(len(y)) < 0.5)].astype(int)   # a copy of voter 3
    known = slice(0, 300)
    bits = (votes << np.arange(5)).sum(1)
    value, n = np.unique(bits, return_counts=True)
    patterns = spark.createDataFrame(list(zip(value.tolist(), n.tolist())), "votes long, n long")
    start = toxicity.moments(votes[known], np.ones(300), y[known].astype(float))
    prior, table, parent = toxicity.label_model(patterns, start, 5)
    assert parent[4] == 3 or parent[3] == 4
    assert abs(np.exp(prior[1]) - 0.2) < 0.04
    for j in (0, 1, 2):
        share = [np.exp(table[label, j, :, 1]) for label in (0, 1)]
        assert np.abs(share[1] - accuracy[j][0]).min() < 0.08 and np.abs(share[0] - accuracy[j][1]).min() < 0.05
    q = toxicity.posterior(votes, (prior, table, parent))
    assert ((q > 0.5) == y).mean() > 0.9


def test_scanner_knows_words_and_beginnings():
    scan = toxicity.Scanner(["0bad", "4badw", "0über", "5badwo"])
    assert scan("BAD. badwx") == [0, 1] and scan("badword") == [1, 3] and scan("xbad badw bad_") == []
    assert scan("ÜBER-bad") == [0, 2] and scan("") == [] and toxicity.Scanner([])("bad") == []


def test_without_labels_every_score_is_the_prior(spark):
    rows, _ = corpus(20)
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([], "doc_id long, toxic int"))
    assert {round(r.score, 9) for r in got.collect()} == {0.05}


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (3, None), (8, 0)], "doc_id long, toxic int")
    got = toxicity.score(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [True]
    assert toxicity.score(none, labels).collect() == []
