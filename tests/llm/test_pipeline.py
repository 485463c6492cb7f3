import os
from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from flowcast.llm import decontaminate, packing, pii_crf, queries, simhash
from tests.llm.test_simhash import plain_components, plain_print

SF = os.environ.get("TEST_SF_DIR", contract.SMOKE_DIR)
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="supplied tables not present")


def test_all_operators_and_the_pipeline_are_registered():
    names = contract.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(10 ** 9)
    rows = {r.doc_id: r for r in docs.collect()}
    step = dict(corpus_pipeline.STAGES)
    kept = step["language"](spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() == len(rows)      # all are in a known language
    kept = step["near_duplicates"](spark, docs, SF)
    prints = {i: plain_print(r.text) for i, r in rows.items()}
    root, first = plain_components(set(prints.values())), {}
    for i in sorted(prints):
        first.setdefault(root[prints[i]], i)
    assert Counter(kept.collect()) == Counter(rows[i] for i in first.values())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = step["decontamination"](spark, docs, SF)
    grams = {i: decontaminate.shingles(decontaminate.words_of(t)) for i, t in items}
    leaked = {d for d, r in rows.items() for own in [decontaminate.shingles(decontaminate.words_of(r.text))]
              if any(len(g & own) >= 0.8 * len(g) for g in grams.values())}
    assert leaked and {r.doc_id for r in kept.collect()} == set(rows) - leaked
    redacted = step["personal_data"](spark, docs, SF).collect()
    assert [r.doc_id for r in redacted] and all(not pii_crf.rule_spans(r.text) for r in redacted)
    assert sum(r.text != rows[r.doc_id].text for r in redacted) == sum(bool(pii_crf.rule_spans(r.text)) for r in rows.values())


def test_run_packs_what_the_stages_kept(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF)
    want = {r.doc_id: len(packing.tokenise((r.text or "").encode(), corpus_pipeline.public_tokenizers.path("word_bpe_49k.json"))) // 4
            for r in docs.collect()}
    length = Counter()
    for r in got:
        length[r.doc_id] += r.length
    assert length == want and simhash.BITS == 64


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_give_rows(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0
