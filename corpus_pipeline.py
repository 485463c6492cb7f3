"""Documents to packed training sequences: language, near duplicates, leaks, personal data, packing."""

import public_tokenizers

from flowcast.llm import decontaminate, language, packing, pii_crf, simhash


def keep_languages(spark, docs, sf_dir):
    """Rejects documents in no known language."""
    return language.accept(docs)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of near duplicates stays."""
    return simhash.deduplicate(docs)


def drop_leaks(spark, docs, sf_dir):
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark, docs, sf_dir):
    """Personal data gives way to a mark of its kind."""
    return pii_crf.redact(docs)


def pack_sequences(spark, docs, sf_dir):
    """Pieces of documents with their sequence and offset."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: Tokens, potentials and hashes with a seed are beyond SQL; brute-force tests stand in.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in turn over the documents; each is written and read again before the next."""
    from flowcast.sources.staging import stage
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
