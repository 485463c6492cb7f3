"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier.

1. Candidate cues are mined from a bounded sample of labelled training rows (``SAMPLE`` documents, those with the
   smallest hash of their id): whole words (lexicon) and beginnings of words (patterns) that stand mostly in
   documents labelled toxic. At most ``CUES`` are kept, and a greedy cover picks up to ``VOTERS`` of them as voters; style
   voters (shouting, rows of exclamation marks, rows of signs) and one for "no cue at all" join them.
2. Every whole text is scanned once for all cues with one automaton; what follows works on the few cue numbers
   of each document.
3. The label model is generative: a hidden label, votes that depend on it (accuracies), and votes that depend on
   each other as well (correlations: a spanning forest by conditional mutual information). It starts
   from the training labels and is fitted by expectation maximisation to the vote patterns of all documents, grouped and
   counted by Spark; each round brings back sums of fixed size.
4. A logistic regression over all cues is fitted to the posterior labels of the sample, and scores every document.

Labels with ``crc32(id as text) mod 5 = 0`` are never read. Language, source and id are no inputs.

Defined results: a null text is the empty one and gets a score like any other; a row with a null id is held out;
repeated rows repeat their results; several labels of one document count as their maximum. Without any usable training label every
score is the same prior, 0.05.
"""

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from flowcast.llm.frames import arrow_map, narrow, schema_of, texts, to_batches
from flowcast.sources.staging import stage

SAMPLE, CUES, VOTERS, FOLDS = 20000, 2000, 28, 5
LEAST, PRECISION, PREFIXES, ROUNDS, PRIOR = 5, 0.6, (4, 5), 6, 0.05
STYLES = ("shouting", "exclaiming", "signs")
_WORD = re.compile(r"\w+")
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))


def cues_of(text):
    """All words and beginnings of words of a text, as (kind, string) keys; kind 0 is a whole word."""
    words = set(_WORD.findall(text.lower()))
    found = {"0" + w for w in words if len(w) >= 3}
    for n in PREFIXES:
        found.update(f"{n}{w[:n]}" for w in words if len(w) > n)
    return found


def styles_of(text):
    """Numbers of the style voters that fire."""
    data = text.encode()
    letters = len(data) - len(data.translate(None, _LETTERS))
    upper = len(data) - len(data.translate(None, _UPPER))
    return [i for i, fires in enumerate((
        letters >= 20 and upper > 0.6 * letters, text.count("!!") >= 3,
        sum(map(text.count, ("***", "###", "$$$", "%%%", "&&&"))) >= 5)) if fires]


def _mine(batches, target):
    seen = [Counter(), Counter()]
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            seen[toxic].update(cues_of(text))
    cues = list(seen[0].keys() | seen[1].keys())
    yield from to_batches({"cue": cues, "toxic": [seen[1][c] for c in cues], "clean": [seen[0][c] for c in cues]}, target)


class Scanner:
    """Finds the numbers of the cues in a text with one automaton."""

    def __init__(self, cues):
        import ahocorasick
        self.machine = ahocorasick.Automaton()
        self.shortest = {}
        for i, cue in enumerate(cues):
            self.machine.add_word(cue[1:], (*self.machine.get(cue[1:], ()), (i, int(cue[0]), len(cue) - 1)))
        if cues:
            self.machine.make_automaton()
        self.empty = not cues

    def __call__(self, text):
        if self.empty:
            return []
        found, low = set(), text.lower()
        for end, values in self.machine.iter(low):
            for number, kind, length in values:
                begin = end - length + 1
                if number not in found and (not begin or not _inner(low[begin - 1])):
                    after = end + 1 < len(low) and _inner(low[end + 1])
                    if after if kind else not after:  # a beginning goes on, a word ends
                        found.add(number)
        return sorted(found)


def _inner(c):
    return c.isalnum() or c == "_"


def _scan(batches, cues, target):
    scan = Scanner(cues)
    for batch in batches:
        rows = [scan(t) + [len(cues) + s for s in styles_of(t)] for t in batch.column("text").to_pylist()]
        yield from to_batches({"id": batch.column("id"), "cues": rows}, target)


def scan(docs, cues, id_col="doc_id", text_col="text"):
    """(id, cues): the numbers of the cues and styles in every text."""
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, cues array<int>"
    target = schema_of(docs.sparkSession, schema)
    return texts(docs, id_col, text_col).mapInArrow(lambda it: _scan(it, cues, target), schema)


def held_out(id_col):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(True))


def training_rows(labels, label_id="doc_id", label_col="toxic", sample=SAMPLE):
    """At most ``sample`` training labels, chosen by the hash of the id."""
    rows = narrow(labels, id=label_id, toxic=label_col).where(~held_out("id") & F.col("toxic").isNotNull())
    return (rows.groupBy("id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
            .orderBy(F.xxhash64("id"), "id").limit(sample))


def mine(labelled):
    """The strongest cues of the labelled sample, at most ``CUES``."""
    schema = "cue string, toxic long, clean long"
    target = schema_of(labelled.sparkSession, schema)
    counts = (labelled.mapInArrow(lambda it: _mine(it, target), schema)
              .groupBy("cue").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
              .where((F.col("t") >= LEAST) & (F.col("t") >= PRECISION * (F.col("t") + F.col("c")))))
    return [r.cue for r in counts.orderBy(F.desc(F.col("t") - 2 * F.col("c")), "cue").limit(CUES).collect()]


def choose_voters(rows, toxic, cues):
    """Numbers of the cues that together cover most toxic documents of the sample, several times over."""
    gain = np.array([1.0 if t else -2.0 for t in toxic])
    member = [[] for _ in range(cues)]
    for d, found in enumerate(rows):
        for c in found:
            if c < cues:
                member[c].append(d)
    member = [np.array(m, int) for m in member]
    chosen = []
    for _ in range(VOTERS):
        value = [gain[m].sum() if len(m) and c not in chosen else -1.0 for c, m in enumerate(member)]
        best = int(np.argmax(value)) if value else -1
        if best < 0 or value[best] < LEAST / 2:
            break
        chosen.append(best)
        gain[member[best]] *= np.where(gain[member[best]] > 0, 0.5, 1.0)
    return chosen


def forest(joint, single, total):
    """Parent of each voter (or -1): a spanning forest of the strongest conditional dependences."""
    size = single.shape[1]
    info = np.zeros((size, size))
    for y in range(2):
        share = total[y] / total.sum()
        p11 = (joint[y] + 0.1) / (total[y] + 0.4)
        p1 = (single[y] + 0.2) / (total[y] + 0.4)
        for a in (0, 1):
            for b in (0, 1):
                p = {(1, 1): p11, (1, 0): p1[:, None] - p11, (0, 1): p1[None, :] - p11,
                     (0, 0): 1 - p1[:, None] - p1[None, :] + p11}[a, b].clip(1e-9)
                q = np.outer(p1 if a else 1 - p1, p1 if b else 1 - p1).clip(1e-9)
                info += share * p * np.log(p / q)
    parent, inside = np.full(size, -1), {0}
    while len(inside) < size:
        value, j, k = max((info[j, k], -j, -k) for j in range(size) if j not in inside for k in inside)
        inside.add(-j)
        parent[-j] = -k if value > 1e-4 else -1
    return parent


def fit_tables(joint, single, total, parent):
    """log P(label) and log P(vote j | label, vote of j's parent), smoothed."""
    size = single.shape[1]
    table = np.zeros((2, size, 2, 2))  # label, voter, parent's vote, vote
    for y in range(2):
        one = (single[y] + 0.5) / (total[y] + 1.0)
        for j in range(size):
            k = parent[j]
            if k < 0:
                on = np.array([one[j], one[j]])
            else:
                both, only = joint[y, j, k], single[y, j] - joint[y, j, k]
                on = np.array([(only + one[j]) / (total[y] - single[y, k] + 1.0), (both + one[j]) / (single[y, k] + 1.0)])
            table[y, j, :, 1], table[y, j, :, 0] = np.log(on.clip(1e-6, 1 - 1e-6)), np.log1p(-on.clip(1e-6, 1 - 1e-6))
    return np.log((total + 0.5) / (total.sum() + 1.0)), table


def posterior(votes, model):
    """P(toxic | votes) for a matrix of votes."""
    prior, table, parent = model
    score = np.tile(prior, (len(votes), 1))
    for j in range(votes.shape[1]):
        above = votes[:, parent[j]] if parent[j] >= 0 else np.zeros(len(votes), int)
        for y in range(2):
            score[:, y] += table[y, j, above, votes[:, j]]
    return 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -50, 50)))


def votes_of(rows, voters, cues):
    """Matrix of votes; the last voter fires if nothing but styles was found."""
    at = {c: j for j, c in enumerate([*voters, *range(cues, cues + len(STYLES))])}
    votes = np.zeros((len(rows), len(at) + 1), int)
    for d, found in enumerate(rows):
        for c in found:
            if c in at:
                votes[d, at[c]] = 1
        votes[d, -1] = not any(c < cues for c in found)
    return votes


def moments(votes, weight, q):
    """Sums the model is fitted to, by label: pairs, single votes, totals."""
    w = np.stack([weight * (1 - q), weight * q])
    return np.stack([votes.T @ (v[:, None] * votes) for v in w]), w @ votes, w.sum(1)


def _expect(batches, model, size, target):
    total = np.zeros(2 * size * size + 2 * size + 2)
    for batch in batches:
        mask, n = batch.column("votes").to_numpy(), batch.column("n").to_numpy().astype(float)
        votes = (mask[:, None] >> np.arange(size)) & 1
        total += np.concatenate([x.ravel() for x in moments(votes, n, posterior(votes, model))])
    yield from to_batches({"at": np.arange(len(total)), "value": total}, target)


def label_model(patterns, start, size):
    """Fit the model to (votes as bits, n) of all documents, from the moments of the labelled ones."""
    spark = patterns.sparkSession
    joint, single, total = start
    parent = forest(*start)
    model = (*fit_tables(*start, parent), parent)
    schema = "at int, value double"
    target = schema_of(spark, schema)
    for _ in range(ROUNDS):
        now = model
        sums = patterns.mapInArrow(lambda it: _expect(it, now, size, target), schema)
        flat = np.zeros(2 * size * size + 2 * size + 2)
        for r in sums.groupBy("at").agg(F.sum("value").alias("value")).collect():
            flat[r["at"]] = r["value"]
        j, s, t = np.split(flat, [2 * size * size, 2 * size * size + 2 * size])
        # the labelled documents anchor which of the two hidden values is the toxic one
        moment = (j.reshape(2, size, size) + joint, s.reshape(2, size) + single, t + total)
        parent = forest(*moment)
        model = (*fit_tables(*moment, parent), parent)
    return model


def logistic(rows, target, size, penalty=0.3, rounds=150):
    """Weights (the last one the constant) of a logistic regression on soft labels."""
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    cue = np.array([c for r in rows for c in r], int)
    weight, speed, rate = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    weight[-1] = np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3))
    for step in range(1, rounds + 1):
        z = np.bincount(doc, weight[cue], len(rows)) + weight[-1]
        error = 1 / (1 + np.exp(-z)) - target
        grad = np.append(np.bincount(cue, error[doc], size) + penalty * weight[:-1], error.sum()) / len(rows)
        speed, rate = 0.9 * speed + 0.1 * grad, 0.99 * rate + 0.01 * grad ** 2
        weight -= 0.2 * (speed / (1 - 0.9 ** step)) / (np.sqrt(rate / (1 - 0.99 ** step)) + 1e-8)
    return weight


def _score(batches, weight, target):
    for batch in batches:
        z = [float(weight[found].sum() + weight[-1]) for found in batch.column("cues").to_pylist()]
        yield from to_batches({"id": batch.column("id"), "score": 1 / (1 + np.exp(-np.clip(z, -50, 50)))}, target)


def score(docs, labels, id_col="doc_id", text_col="text", label_id="doc_id", label_col="toxic", sample=SAMPLE):
    """(id, held_out, score, predicted) of every row."""
    spark = docs.sparkSession
    picked = stage(training_rows(labels, label_id, label_col, sample), "toxic-labels")  # bounded: may be broadcast
    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts(docs, id_col, text_col)
    known = picked.select(F.col("id").alias("key"), "toxic")
    labelled = stage(rows.join(F.broadcast(known), F.col("id") == F.col("key")).select("id", "text", "toxic"), "toxic-sample")
    cues = mine(labelled)
    found = stage(scan(docs, cues, id_col, text_col), "toxic-cues")
    schema = f"id {kind}, score double"
    target = schema_of(spark, schema)
    sampled = found.join(F.broadcast(known), F.col("id") == F.col("key")).select("cues", "toxic").toPandas()  # bounded
    if cues and len(sampled):
        matrix, toxic = sampled["cues"].tolist(), sampled["toxic"].to_numpy(float)
        voters = choose_voters(matrix, toxic, len(cues))
        votes = votes_of(matrix, voters, len(cues))
        size = votes.shape[1]
        bits = found.select(_bits(voters, len(cues)).alias("votes")).groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
        model = label_model(stage(bits, "toxic-votes"), moments(votes, np.ones(len(votes)), toxic), size)
        weight = logistic(matrix, posterior(votes, model), len(cues) + len(STYLES))
    else:
        weight = np.append(np.zeros(len(cues) + len(STYLES)), np.log(PRIOR / (1 - PRIOR)))
    out = found.mapInArrow(lambda it: _score(it, weight, target), schema)
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _bits(voters, cues):
    """The votes of a document as one long, from its cue numbers."""
    order = [*voters, *range(cues, cues + len(STYLES))]
    bit = lambda c, j: F.when(F.array_contains("cues", c), F.lit(1 << j)).otherwise(F.lit(0))
    total = F.when(F.exists("cues", lambda c: c < cues), F.lit(0)).otherwise(F.lit(1 << len(order)))
    for j, c in enumerate(order):
        total = total.bitwiseOR(bit(c, j).cast("long"))
    return total.cast("long")
