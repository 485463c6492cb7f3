"""The registered queries of the operators, with their SQL where SQL can express them."""

import public_tokenizers
from pyspark.sql import functions as F

from flowcast.llm import (collocation, decontaminate, language, lexical_search, license_join, multi_index, packing, pii_crf,
                          secret_markov, simhash, suffix_dedup, toxicity, warc)
from flowcast.llm.frames import read

QUERIES, ORACLES = {}, {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def _joined(spans):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _span_digest(found, kinds, id_col="doc_id"):
    base = F.filter("spans", lambda s: ~s["added"])
    of_kind = lambda kind: F.filter(base, lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select(
        id_col, *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["added"])).cast("long").alias("n_added"))


@query
def op2_pii_crf(spark, sf_dir):
    """Personal data of all documents."""
    return _span_digest(pii_crf.detect(read(spark, sf_dir, "documents")), pii_crf.KINDS)


@query
def op4_secret_markov(spark, sf_dir):
    """Secrets of all documents."""
    return _span_digest(secret_markov.detect(read(spark, sf_dir, "documents")), secret_markov.KINDS[:3])


@query
def op10_warc(spark, sf_dir):
    """All pages written as archives and read back."""
    pages = read(spark, sf_dir, "pages")
    folder = warc.write(pages)
    return warc.read_records(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op1_decontaminate(spark, sf_dir):
    """Every document that holds a benchmark item, with the item, its score and overlaps."""
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op5_language(spark, sf_dir):
    """Language of all documents; ``lang`` is the declaration, ``source`` the host."""
    return language.identify(read(spark, sf_dir, "documents")).drop("row_key")


@query
def page_language(spark, sf_dir):
    """Language of all pages, by text, markup, address suffix and host."""
    pages = language.page_evidence(read(spark, sf_dir, "pages"))
    return language.identify(pages, "page_id", host_col="host", suffix_col="suffix").drop("row_key")


@query
def op6_packing(spark, sf_dir):
    """All documents packed into sequences of 4096 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_simhash(spark, sf_dir):
    """Fingerprint and component of all documents."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


@query
def op8_toxicity(spark, sf_dir):
    """Toxicity score of all documents."""
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op3_multi_index(spark, sf_dir):
    """Ten nearest neighbours found of every hundredth vector, among all vectors."""
    found = multi_index.neighbours(read(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query
def op9_suffix_dedup(spark, sf_dir):
    """Repeated strings of 50 bytes in all documents."""
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))


@query
def op13_license_join(spark, sf_dir):
    """License phrases and notices in all documents."""
    return license_join.digest(license_join.scan(read(spark, sf_dir, "documents")))


ORACLES["op13_license_join"] = license_join.oracle()


@query
def op12_lexical_search(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLES["op12_lexical_search"] = lexical_search.oracle()


@query
def op11_collocation(spark, sf_dir):
    """The best phrases of every language over all documents."""
    return collocation.collocations(read(spark, sf_dir, "documents"))


ORACLES["op11_collocation"] = collocation.oracle()
