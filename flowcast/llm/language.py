"""Language identification by Bayesian fusion of evidence.

For each document the posterior over languages combines

* the likelihood of its text: bytes in trigrams, hashed to ``BUCKETS`` classes, one multinomial per language, trained
  on all documents by their declared languages (declarations may be wrong now and then), tempered because
  neighbouring trigrams are not independent;
* the declared language (of the markup or the metadata): P(declared | language), estimated from
  how declarations agree with the texts, smoothed;
* the host prior: counts of the texts' posteriors, grouped by host, shrunk to those of the
  address suffix, which are shrunk to those of all documents. A document's own share is left out.

One more class, ``und``, has uniform trigrams and a small fixed prior; it wins where no language explains the
text. Trigrams with digits or signs are left out, so numbers and keys in a short text do not count against it. A document is
accepted if the languages other than ``und`` have a posterior of at least ``ACCEPT`` together, so a text in two languages
stays. A text without any letter is
``und``.

Every declared tag with at least ``LEAST_GRAMS`` trigrams of text is a language, however small its share and however many
there are. A tag with less text has no model, so a text under it that no language explains says nothing against its declaration:
the row keeps the declared tag as its language and is accepted, with the posterior of ``und`` as its probability. Where no tag has
a model, texts with letters are accepted. Counts come to the driver in blocks of ``BLOCK_TAGS`` languages; the table holds 256 KB
a language in each worker, and a row one posterior per language.

Defined results: a null text is the empty one; null declared, suffix or host mean no such evidence (all
null hosts do not form a host); null ids are kept; repeated rows repeat their results; an empty table gives
an empty table. Whole texts are counted and scored. Grouping is pre-aggregated, so one host may
hold any share of the rows; hosts are joined back on narrow rows.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from flowcast.llm.frames import narrow, schema_of, slices, to_batches
from flowcast.sources.staging import stage

BUCKETS, TEMPER, MOST, ACCEPT, KAPPA, UND_PRIOR = 1 << 16, 0.1, 200, 0.5, 20.0, 1e-4
LEAST_GRAMS, BLOCK_TAGS, HELD_TAGS = 10_000, 64, 256
UND = "und"
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32
_SPEAKS = np.ones(256, bool)  # digits and signs say nothing of a language
_SPEAKS[:128] = [chr(c) in " .,;:!?'-" or chr(c).isalpha() or 9 <= c <= 13 for c in range(128)]


def grams(texts):
    """Hashed trigrams of all texts of a batch in one array, and where each text starts."""
    raw = texts.cast(pa.large_binary())
    edges = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] else np.zeros(0, np.uint8)
    data = data[edges[0]:edges[-1]]
    speaks, data = _SPEAKS[data], _FOLD[data]
    edges = edges - edges[0]
    if len(data) < 3:
        return np.zeros(0, np.uint32), np.zeros(len(raw) + 1, np.int64)
    code = (data[:-2] * np.uint32(0x9E3779B1)) ^ (data[1:-1] * np.uint32(0x85EBCA6B)) ^ (data[2:] * np.uint32(0xC2B2AE35))
    code = (code * np.uint32(0x27D4EB2F)) >> np.uint32(16)
    keep = speaks[:-2] & speaks[1:-1] & speaks[2:]
    inner = edges[1:-1]
    for back in (1, 2):  # trigrams that would span two texts
        cut = inner - back
        keep[cut[(cut >= 0) & (cut < len(code))]] = False
    ends = np.r_[0, np.cumsum(keep)]
    return code[keep], ends[np.minimum(edges, len(code))]


def _sums(values, starts):
    """Sums between the starts; empty stretches give 0."""
    out = np.zeros(len(starts) - 1)
    full = np.flatnonzero(starts[1:] > starts[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, starts[full], dtype=np.float64)
    return out


def _gram_counts(batches, target):
    totals = {}
    for batch in slices(batches):
        code, starts = grams(batch.column("text"))
        tags = batch.column("declared").to_pylist()
        for tag in set(tags) - {None}:
            if tag not in totals and len(totals) >= HELD_TAGS:
                yield from _counted(totals, target)
                totals = {}
            mine = np.repeat(np.array([t == tag for t in tags]), np.diff(starts))
            totals[tag] = totals.get(tag, 0) + np.bincount(code[mine], minlength=BUCKETS)
    yield from _counted(totals, target)


def _counted(totals, target):
    for tag, n in totals.items():
        at = np.flatnonzero(n)
        yield from to_batches({"declared": [tag] * len(at), "bucket": at, "n": n[at]}, target)


def train(docs, text_col="text", declared_col="lang"):
    """Log-likelihoods per language and trigram class, from all documents.

    Languages are all declared tags with at least ``LEAST_GRAMS`` trigrams of text.
    """
    spark = docs.sparkSession
    rows = narrow(docs, text=text_col, declared=declared_col).withColumn("declared", F.col("declared").cast("string"))
    rows = rows.where(F.col("declared") != UND).withColumn("text", F.coalesce("text", F.lit("")))
    schema = "declared string, bucket int, n long"
    target = schema_of(spark, schema)
    counts = rows.mapInArrow(lambda it: _gram_counts(it, target), schema)
    counts = stage(counts.groupBy("declared", "bucket").agg(F.sum("n").alias("n")), "gram-counts")
    known = counts.groupBy("declared").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_GRAMS)
    tags = sorted(r.declared for r in known.select("declared").collect())
    blocks = [_log_shares(counts, tags[i:i + BLOCK_TAGS]) for i in range(0, len(tags), BLOCK_TAGS)]
    table = np.vstack([*blocks, np.full((1, BUCKETS), -np.log(BUCKETS) + 1.0, np.float32)])
    return {"tags": [*tags, UND], "table": table}


def _log_shares(counts, tags):
    """Smoothed log-shares of the trigram classes of some languages."""
    got = counts.where(F.col("declared").isin(tags)).toPandas()
    at = {t: i for i, t in enumerate(tags)}
    n = np.zeros((len(tags), BUCKETS))
    n[got["declared"].map(at).to_numpy(int), got["bucket"].to_numpy(int)] = got["n"]
    return np.log((n + 0.05) / (n.sum(1, keepdims=True) + 0.05 * BUCKETS)).astype(np.float32)


def _likelihoods(batch, model):
    """Tempered log-likelihoods per row; a text without letters has none but ``und``."""
    text = batch.column("text")
    code, starts = grams(text)
    size = np.diff(starts)
    scale = TEMPER * np.minimum(size, MOST) / np.maximum(size, 1)
    out = np.stack([_sums(row[code], starts) * scale for row in model["table"]], 1)
    blank = np.array([_LETTER.search(t) is None for t in text.to_pylist()], bool)
    out[blank] = -1e3
    if out.shape[1] > 1:
        out[blank, -1] = 0.0
    return out


def _scored(batches, model, target):
    for batch in slices(batches):
        columns = {n: batch.column(n) for n in target.names if n != "ll"}
        yield from to_batches(columns | {"ll": list(_likelihoods(batch, model))}, target)


def _softmax(array):
    top = F.array_max(array)
    grown = F.transform(array, lambda x: F.exp(x - top))
    total = F.aggregate(grown, F.lit(0.0), lambda a, x: a + x)
    return F.transform(grown, lambda x: x / total)


def _add(a, b):
    return F.zip_with(a, b, lambda x, y: x + y)


def _log(a):
    return F.transform(a, lambda x: F.log(F.greatest(x, F.lit(1e-12))))


def identify(docs, id_col="doc_id", text_col="text", declared_col="lang", host_col="source", suffix_col=None, model=None):
    """(id, language, probability, accepted) of every row, and ``row_key``, a hash of all its evidence."""
    spark = docs.sparkSession
    model = model or train(docs, text_col, declared_col)
    tags = model["tags"]
    none = F.lit(None).cast("string")
    rows = docs.select(
        docs[f"`{id_col}`"].alias("id"), F.coalesce(docs[f"`{text_col}`"], F.lit("")).alias("text"),
        (docs[f"`{declared_col}`"].cast("string") if declared_col else none).alias("declared"),
        (docs[f"`{host_col}`"].cast("string") if host_col else none).alias("host"),
        (docs[f"`{suffix_col}`"].cast("string") if suffix_col else none).alias("suffix"))
    rows = rows.withColumn("row_key", row_key(rows, "id", "text", "declared", "host"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, declared string, host string, suffix string, row_key string, ll array<double>"
    target = schema_of(spark, schema)
    scored = rows.mapInArrow(lambda it: _scored(it, model, target), schema)
    scored = stage(scored.withColumn("own", _softmax(F.col("ll"))), "language")

    size = len(tags)
    sums = [F.sum(F.col("own")[i]).alias(f"s{i}") for i in range(size)]
    vector = F.array(*[F.col(f"s{i}") for i in range(size)])
    everything = scored.agg(*sums).first()
    base = np.array([everything[i] or 0.0 for i in range(size)]) + 1.0
    base[-1] = UND_PRIOR * max(base[:-1].sum(), 1.0)
    base = (base / base.sum()).tolist()
    agree = scored.where("declared is not null").groupBy("declared").agg(*sums)
    hosts = scored.where("host is not null").groupBy("host", "suffix").agg(*sums, F.count(F.lit(1)).alias("n"))
    hosts = stage(hosts.select("host", "suffix", vector.alias("host_sum"), F.col("n").alias("host_n")), "hosts")
    suffixes = (hosts.where("suffix is not null").groupBy("suffix")
                .agg(*[F.sum(F.col("host_sum")[i]).alias(f"s{i}") for i in range(size)], F.sum("host_n").alias("suffix_n"))
                .select("suffix", vector.alias("suffix_sum"), "suffix_n"))
    shrunk = hosts.join(stage(suffixes, "suffixes"), "suffix", "left")
    flat = F.array(*[F.lit(x) for x in base])
    parent = F.when(F.col("suffix_n").isNull(), flat).otherwise(
        F.zip_with("suffix_sum", flat, lambda s, p: (s + KAPPA * p) / (F.col("suffix_n") + KAPPA)))
    shrunk = stage(shrunk.select("host", "suffix", "host_sum", "host_n", parent.alias("parent")), "host-priors")

    # P(declared | language), with half of one pseudo-document spread by the declarations' own frequency; a tag without a
    # model says nothing, since the texts under it would teach that it means und
    agree = stage(agree, "declared")
    seen = agree.agg(*[F.sum(f"s{i}") for i in range(size)]).first()
    seen = np.array([x or 0.0 for x in seen])
    weights = []
    for r in agree.where(F.col("declared").isin(tags[:-1])).collect():
        v = np.array([r[f"s{i}"] for i in range(size)])
        weights.append((r.declared, np.log((v + 0.5 * v.sum() / max(seen.sum(), 1)) / (seen + 0.5)).clip(-6, 0).tolist()))
    weights = spark.createDataFrame(weights, "tag string, weight array<double>")
    said = F.coalesce("weight", F.array(*[F.lit(0.0)] * size))
    scored = scored.join(F.broadcast(weights), F.col("declared") == F.col("tag"), "left").withColumn("said", said).drop("tag", "weight")
    joined = scored.join(shrunk, (scored["host"] == shrunk["host"]) & scored["suffix"].eqNullSafe(shrunk["suffix"]), "left")
    rest = F.zip_with("host_sum", "own", lambda s, o: F.greatest(s - o, F.lit(0.0)))
    prior = F.when(F.col("host_n").isNull(), flat).otherwise(
        F.zip_with(rest, "parent", lambda s, p: (s + KAPPA * p) / (F.col("host_n") - 1 + KAPPA)))
    # a column of its own, or each element of the sum below would compute all of it again
    untaught = F.col("declared").isNotNull() & ~F.trim("declared").isin("", UND) & ~F.col("declared").isin(tags)
    known = joined.select("id", "row_key", "ll", F.when(untaught, F.col("declared")).alias("untaught"),
                          _add(_add(F.col("ll"), F.col("said")), _log(prior)).alias("evidence"))
    post = known.select("id", "row_key", "ll", "untaught", _softmax(F.col("evidence")).alias("post"))
    names = F.array(*[F.lit(t) for t in tags])
    best = F.array_position("post", F.array_max("post")).cast("int")
    blank = F.col("ll")[0] <= -1e3
    language = F.when(best == size, F.coalesce("untaught", F.lit(UND))).otherwise(F.element_at(names, best))
    spared = F.col("untaught").isNotNull() | F.lit(size == 1)
    out = post.select(
        F.col("id").alias(id_col), F.when(blank, F.lit(UND)).otherwise(language).alias("language"),
        F.when(blank, F.lit(1.0)).otherwise(F.array_max("post")).alias("probability"),
        (~blank & (spared | ((best < size) & (1 - F.element_at("post", -1) >= ACCEPT)))).alias("accepted"), "row_key")
    return out


def row_key(df, *names):
    """A 96-bit key of the evidence in a row, nulls told from empty texts."""
    columns = [c for n in names for c in (df[n], df[n].isNull())]
    return F.concat_ws("-", F.hex(F.xxhash64(*columns)), F.hex(F.hash(*columns)))


def accept(docs, id_col="doc_id", text_col="text", declared_col="lang", host_col="source"):
    """The accepted rows, columns as they are.

    Rejected rows are few as a rule: their keys are written first, so Spark sees their size and ships
    them or, if there are many, joins by key.
    """
    found = identify(docs, id_col, text_col, declared_col, host_col)
    gone = stage(found.where(~F.col("accepted")).select(F.col("row_key").alias("gone")).distinct(), "rejected")
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = {c: names[i] for i, c in enumerate(docs.columns)}
    inner = docs.toDF(*names)
    view = inner.select(F.col(at[id_col]).alias("id"), F.coalesce(at[text_col], F.lit("")).alias("text"),
                        F.col(at[declared_col]).cast("string").alias("declared"),
                        F.col(at[host_col]).cast("string").alias("host"), *names)
    keyed = view.select(*names, row_key(view, "id", "text", "declared", "host").alias("key"))
    return keyed.join(gone, F.col("key") == F.col("gone"), "left_anti").select(*names).toDF(*docs.columns)


def page_evidence(pages, id_col="page_id", url_col="url", html_col="html"):
    """Pages as rows of evidence: visible text, declared markup language, address suffix and host."""
    html = F.coalesce(pages[f"`{html_col}`"], F.lit(""))
    host = F.lower(
        F.regexp_extract(F.coalesce(pages[f"`{url_col}`"], F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    host = F.when(host == "", F.lit(None)).otherwise(host)
    declared = F.lower(F.regexp_extract(html, r"(?i)<html(?=\s)[^<>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    visible = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    visible = F.regexp_replace(visible, r"&[A-Za-z0-9#]{1,10};", " ")
    return pages.select(
        pages[f"`{id_col}`"].alias("page_id"), visible.alias("text"),
        F.when(declared != "", declared).alias("lang"), host.alias("host"),
        F.when(host.isNotNull(), F.regexp_extract(host, r"([^.]+)$", 1)).alias("suffix"))
