"""Secrets by rules plus two character Markov models.

Rules find assignments to secret-like names, access keys and long hexadecimal runs. Further
tokens are judged by two order-2 Markov models over characters, one of random strings and
one of ordinary identifiers: a token whose log-likelihood ratio per character and in total
is high enough is reported as kind ``random``.

Training uses labelled samples. Of a bounded sample of documents (``SAMPLE_DOCS``, those with the smallest hash of their id, so
the choice does not depend on the partitioning) the values the rules found are random strings and all other tokens ordinary. As prose holds few
identifiers, both classes get ``GENERATED`` more: keys drawn from usual alphabets, and names in camel, snake and kebab case, with numbers, dates and
paths, made of the sample's frequent words and of common words of programs. One word in five is held out: the rate a character that a
token must reach is what all but 2 in 1000 names of held-out words stay below (``calibrate``), at least ``MIN_RATE``. Both models are
smoothed towards their alphabets.

A run of token characters is judged without what rules found in it; if the whole does not pass, its parts between ``=``, then
``/``, then ``_`` and ``-`` are. So a key behind a long ordinary name is found, in time linear in the run.

Defined results: a null text is the empty one; rows are independent, repeated rows repeat
their results; a null id is kept; an empty table gives an empty table. All patterns run in
time linear in the text, however long.
"""

import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from flowcast.llm.frames import arrow_map, texts

KINDS = ("assign", "access", "hex", "random")
SPAN = "array<struct<kind:string,start:int,end:int,added:boolean>>"
SAMPLE_DOCS = 5000
MIN_LENGTH, MIN_TOTAL, MIN_RATE = 16, 25.0, 0.8
GENERATED, VOCABULARY = 4000, 4000

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24}[0-9a-f]*+")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d}[A-Za-z0-9+/_=-]*+" % MIN_LENGTH)
_WORD = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{4}[A-Za-z0-9+/_=-]*+")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
# Words that names in programs are made of, beside those of the sample.
COMMON = ("get set add max min user name list item count index value key file path size time date type data config server client request "
          "response account customer order connection pool handler manager service message status version update delete create default").split()
_PARTS = [re.compile(p) for p in (r"[^=]+", r"[^=/]+", r"[^=/_-]+")]
SIZE = len(ALPHABET) + 1  # the last one opens a token
_CODE = np.full(128, SIZE - 1)
_CODE[[ord(c) for c in ALPHABET]] = range(SIZE - 1)


def rule_spans(text):
    """(kind number, start, end, value) of every rule match, by start, then kind."""
    found = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        found = [(0, *m.span(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(1, *m.span(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(2, *m.span(), m[0]) for m in _HEX.finditer(text)]
    found.sort(key=lambda s: (s[1], s[0]))
    return found


def codes(token):
    """Transition numbers of a token: (two characters before, character)."""
    c = _CODE[np.frombuffer(token.encode("ascii"), np.uint8)]
    one, two = np.r_[SIZE - 1, c[:-1]], np.r_[SIZE - 1, SIZE - 1, c[:-2]] if len(c) > 1 else np.array([SIZE - 1])
    return (two[:len(c)] * SIZE + one) * SIZE + c


def _transitions(batch):
    """Counts of transitions per class over the tokens of a batch."""
    totals = [np.zeros(SIZE ** 3, np.int64) for _ in range(2)]
    for text in batch.column("text").to_pylist():
        base = rule_spans(text)
        covered = [(a, b) for _, a, b, _ in base]
        secret = [re.sub(r"[^A-Za-z0-9+/_=-]", "", v) for *_, v in base if any(c.isdigit() for c in v)]
        plain, i = [], 0
        for m in _WORD.finditer(text):
            while i < len(covered) and covered[i][1] <= m.start():
                i += 1
            if i == len(covered) or covered[i][0] >= m.end():
                plain.append(m[0])
        for cls, tokens in enumerate((plain, secret)):
            got = [codes(t) for t in tokens if t]
            if got:
                np.add.at(totals[cls], np.concatenate(got), 1)
    cls, code = np.nonzero(np.stack(totals))
    return {"cls": cls, "code": code, "n": np.stack(totals)[cls, code]}


def held_out(word):
    """Whether a word is kept from training, for the threshold and for tests: one in five."""
    return zlib.crc32(word.encode()) % 5 == 0


def random_strings(n, seed):
    """Labelled samples of random strings: keys of 16 to 48 characters."""
    r = random.Random(seed)
    lower, upper, digits = ALPHABET[:26], ALPHABET[26:52], ALPHABET[52:62]
    kinds = [lower + upper + digits] * 3 + [lower + upper + digits + "+/", lower + upper + digits + "_-", lower + digits, upper + digits]
    return ["".join(r.choices(r.choice(kinds), k=r.randint(16, 48))) for _ in range(n)]


def identifiers(n, words, seed):
    """Labelled samples of ordinary names, made of ``words``; one in eight is a number, as dates and counters are."""
    r, out = random.Random(seed), []
    for _ in range(n if words else 0):
        if r.random() < 0.125:
            out.append("".join(r.choices("0123456789", k=r.randint(4, 24))))
            continue
        some = r.choices(words, k=r.randint(2, 5))
        kind = r.randrange(6)
        if kind < 2:
            name = "".join(w if i == 0 and kind else w.capitalize() for i, w in enumerate(some))
        else:
            name = "_-_/"[kind - 2].join(w.upper() if kind == 4 else w for w in some)
        glue = "_" if kind in (2, 4) else "-" if kind == 3 else "/" if kind == 5 else ""
        tail = r.choice(["", "", "", str(r.randrange(10)), str(r.randrange(1000)), str(r.randint(1990, 2040)), f"v{r.randrange(10)}",
                         f"{r.randint(1990, 2040)}{glue}q{r.randint(1, 4)}", f"20{r.randrange(10, 40)}{r.randint(1, 12):02}{r.randint(1, 28):02}"])
        out.append(name + glue + tail if tail else name)
    return out


def vocabulary(sample):
    """The sample's most frequent words, at most ``VOCABULARY``, those inside names apart, and the common ones of programs."""
    words = F.explode(F.expr("transform(regexp_extract_all(text, '[A-Z]?[a-z]{2,13}', 0), w -> lower(w))")).alias("w")
    counted = sample.select(words).groupBy("w").count().orderBy(F.desc("count"), "w").limit(VOCABULARY)
    return sorted({r["w"] for r in counted.collect()} | set(COMMON))


def best_rate(token, ratio):
    """The highest rate a character among the parts of a token that are long and likely enough to be judged."""
    return max([rate for rate, _, _ in _judged(token, ratio)], default=0.0)


def calibrate(ratio, words, n=GENERATED):
    """The rate that all but 2 in 1000 names of held-out words stay below, at least ``MIN_RATE``."""
    rates = sorted(best_rate(t, ratio) for t in identifiers(n, [w for w in words if held_out(w)], 3))
    return max(MIN_RATE, rates[int(len(rates) * 0.998)] + 0.01) if rates else MIN_RATE


def train(docs, id_col="doc_id", text_col="text", sample_docs=SAMPLE_DOCS):
    """Log-likelihood ratio per transition, as one table of SIZE^3 numbers."""
    return train_and_calibrate(docs, id_col, text_col, sample_docs)[0]


def train_and_calibrate(docs, id_col="doc_id", text_col="text", sample_docs=SAMPLE_DOCS):
    """(ratio per transition, least rate a character).

    Counts are bounded by the number of transitions and words by ``VOCABULARY``, so what is collected never grows.
    """
    rows = texts(docs, id_col, text_col)
    picked = (rows.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample_docs)
              .select(F.col("id").alias("picked")))
    sample = rows.join(F.broadcast(picked), F.col("id").eqNullSafe(F.col("picked")), "left_semi")
    counts = (arrow_map(sample, "cls int, code int, n long", _transitions)
              .groupBy("cls", "code").agg(F.sum("n").alias("n")).toPandas())
    n = np.zeros((2, SIZE ** 3))
    n[counts["cls"], counts["code"]] = counts["n"]
    words = vocabulary(sample)
    for cls, tokens in enumerate((identifiers(GENERATED, [w for w in words if not held_out(w)], 1), random_strings(GENERATED, 2))):
        if tokens:
            np.add.at(n[cls], np.concatenate([codes(t) for t in tokens]), 1)
    n[0] = np.sqrt(n[0])     # few words make most ordinary tokens: unheard transitions of other words must not cost too much
    n = n.reshape(2, SIZE * SIZE, SIZE)
    pair = n.reshape(2, SIZE, SIZE, SIZE).sum(1)           # one character before
    single = pair.sum(1)
    flat = np.where(np.isin(np.arange(SIZE), [SIZE - 1]), 0.0, 1.0) / (SIZE - 1)
    model = []
    for cls in range(2):
        p1 = (single[cls] + 50 * flat) / (single[cls].sum() + 50)
        p2 = (pair[cls] + 20 * p1) / (pair[cls].sum(1, keepdims=True) + 20)
        weight = 200.0 if cls else 5.0                      # secrets have no memory: lean on p1
        below = p1[None, :] if cls else np.tile(p2, (SIZE, 1))
        model.append((n[cls] + weight * below) / (n[cls].sum(1, keepdims=True) + weight))
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.log(model[1]) - np.log(model[0])
    ratio = np.nan_to_num(ratio, nan=0.0, posinf=0.0, neginf=0.0).astype(np.float32).ravel()
    return ratio, calibrate(ratio, words)


def score(token, ratio):
    """Log-likelihood ratio of a token, random against ordinary."""
    return float(ratio[codes(token)].sum())


def _judged(token, ratio):
    """(rate, start, end) of the token and its parts, coarse to fine, where long and likely enough to be judged."""
    whole = [(0, len(token))]
    for cuts in (None, *_PARTS):
        for a, b in whole if cuts is None else (m.span() for m in cuts.finditer(token)):
            part = token[a:b]
            if b - a < MIN_LENGTH or part.isdigit():
                continue
            total = score(part, ratio)
            if total >= MIN_TOTAL * (1 if any(c.isdigit() for c in part) else 2):
                yield total / (b - a), a, b


def random_spans(token, ratio, rate):
    """(start, end) of the random strings in a token: the coarsest parts that pass, none inside another."""
    found = []
    for r, a, b in _judged(token, ratio):
        if r >= rate and not any(x <= a and b <= y for x, y in found):
            found.append((a, b))
    return sorted(found)


def _left(a, b, base, i):
    """What the base spans, from number ``i`` on, leave of a run."""
    while a < b:
        while i < len(base) and base[i][2] <= a:
            i += 1
        if i == len(base) or base[i][1] >= b:
            yield a, b
            return
        if base[i][1] > a:
            yield a, base[i][1]
        a = base[i][2]


def spans_of(text, ratio, rate=MIN_RATE):
    """All spans of one text as (kind, start, end, added), by start, then kind."""
    base = rule_spans(text)
    found = [(k, a, b, False) for k, a, b, _ in base]
    i = 0
    for m in _TOKEN.finditer(text):
        while i < len(base) and base[i][2] <= m.start():
            i += 1
        for a, b in _left(*m.span(), base, i):
            if b - a >= MIN_LENGTH:
                found += [(3, a + x, a + y, True) for x, y in random_spans(text[a:b], ratio, rate)]
    found.sort(key=lambda s: (s[1], s[0]))
    return found


def _detect(batch, ratio, rate):
    return {"id": batch.column("id"),
            "spans": [[{"kind": KINDS[k], "start": a, "end": b, "added": added}
                       for k, a, b, added in spans_of(text, ratio, rate)]
                      for text in batch.column("text").to_pylist()]}


def detect(docs, id_col="doc_id", text_col="text", model=None):
    """(id, spans): every span with kind, start, end (code points) and whether the models added it."""
    ratio, rate = train_and_calibrate(docs, id_col, text_col) if model is None else model
    kind = docs.schema[id_col].dataType.simpleString()
    found = arrow_map(texts(docs, id_col, text_col), f"id {kind}, spans {SPAN}", _detect, ratio, rate)
    return found.withColumnRenamed("id", id_col)
