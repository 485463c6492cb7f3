"""Personal data by rules plus a skip-chain conditional random field.

Rules find e-mail addresses, IP numbers, card numbers and phone numbers. The field then
labels every other *mention* (a run of words holding digits or ``@``) of the same document.
Neighbouring mentions share chain potentials; distant mentions that repeat or resemble each
other (same letters and digits, same last seven digits, same local part) share skip
potentials. Loopy sum-product passing spreads the labels, so that ``(203) 555-8282`` counts
as a phone number in a document that also has ``+1 (203) 555-8282``.

The potentials are log-odds from counts over all documents: how often the rules give a label
to a mention of one shape, how labels follow each other, and how often linked mentions that
both have a label agree. Mentions the rules leave out count as unlabelled, not as negatives,
so their evidence is clipped (``CLIP``) and a link can outweigh it.

Defined results: a null text is the empty one and has no spans; rows are independent, so
repeated rows give repeated results; a null id is kept; an empty table gives an empty table.
Work is linear in the length of a text: every pattern starts at the edge of a run, and links
go to the previous mention of a key only, never to all pairs.
"""

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from flowcast.llm.frames import arrow_map, sliced_map, texts

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
SPAN = "array<struct<kind:string,start:int,end:int,added:boolean>>"
CLIP, SKIP_MIN, ROUNDS, ACCEPT = 2.0, 7, 20, 0.5

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[@0-9]")
_MENTION = re.compile(r"(?<!\S)[^\s@0-9]*+[@0-9]\S*+(?: (?=[^\s@0-9]*+[@0-9])\S++)*+")
_TRIM = "\"'.,;:!?<>[]{}|#$%&*"


def _emails(text):
    if "@" not in text:
        return
    done = 0
    for m in _AT.finditer(text):
        start = at = m.start()
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at:
            yield start, m.end()
            done = m.end()


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _byte(part):
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def rule_spans(text):
    """(kind number, start, end) of every rule match, by kind and start."""
    found = [(0, a, b) for a, b in _emails(text)]
    if not _MARK.search(text):
        return found
    found += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                found.append((3, *m.span()))
    return found


def mentions(text, spans):
    """(start, end, label or -1) of every mention, rule matches first cut out, in text order."""
    if not _MARK.search(text):
        return []
    out, taken = [], sorted((a, b, k) for k, a, b in spans)
    edge = 0
    for a, b, k in taken:  # overlapping matches: the earlier one is the mention
        if a >= edge:
            out.append((a, b, k))
            edge = b
    fixed, i = list(out), 0
    for m in _MENTION.finditer(text):
        a, b = m.span()
        while i < len(fixed) and fixed[i][1] <= a:
            i += 1
        j = i
        while j < len(fixed) and fixed[j][0] < b:
            _free(text, a, fixed[j][0], out)
            a = max(a, fixed[j][1])
            j += 1
        _free(text, a, b, out)
    out.sort()
    return out


def _free(text, a, b, out):
    piece = text[a:b]
    kept = piece.lstrip(_TRIM + " ")
    a += len(piece) - len(kept)
    kept = kept.rstrip(_TRIM + " ")
    if kept and _MARK.search(kept):
        out.append((a, a + len(kept), -1))


def shape(word):
    """A bounded class of a mention: what it is made of and how many digits it has."""
    digits = sum("0" <= c <= "9" for c in word)
    marks = "".join(c for c in "@+(.-" if c in word)
    letters = any(c.isalpha() for c in word)
    return f"{min(digits, 20)}{marks}{'a' if letters else ''}"


def link_keys(word, label):
    """What makes two mentions similar."""
    low = word.lower()
    plain = "".join(filter(str.isalnum, low))
    digits = "".join(c for c in low if "0" <= c <= "9")
    keys = []
    if len(plain) >= 5:
        keys.append("=" + plain)
    if len(digits) >= SKIP_MIN and "@" not in low:
        keys.append("#" + digits[-SKIP_MIN:])
    local = low.split("@", 1)[0].strip(".")
    if len(local) >= 5 and (label == 0 or "@" not in low):
        keys.append("@" + local)
    return keys


def graph(text, nodes):
    """Chain links of adjacent mentions and skip links to the previous one of each key."""
    chain = [(i - 1, i) for i in range(1, len(nodes))
             if nodes[i][0] - nodes[i - 1][1] <= 2]
    last, skip = {}, set()
    for i, (a, b, label) in enumerate(nodes):
        for key in link_keys(text[a:b], label):
            if key in last:
                skip.add((last[key], i))
            last[key] = i
    return chain, sorted(skip)


def _count(batch):
    """Feature counts of a batch: what the rules say of each shape, chain pair and skip pair."""
    seen = Counter()
    for text in batch.column("text").to_pylist():
        spans = rule_spans(text)
        nodes = mentions(text, spans)
        if not nodes:
            continue
        for a, b, label in nodes:
            seen["shape", shape(text[a:b]), label] += 1
        chain, skip = graph(text, nodes)
        for i, j in chain:
            seen["chain", str(nodes[i][2]), nodes[j][2]] += 1
        for i, j in skip:
            if nodes[i][2] >= 0 and nodes[j][2] >= 0:
                seen["skip", str(nodes[i][2] == nodes[j][2]), 0] += 1
    what, value, label = zip(*seen) if seen else ((), (), ())
    return {"what": list(what), "value": list(value), "label": list(label), "n": list(seen.values())}


def train(docs, text_col="text", id_col="doc_id"):
    """Potentials from counts over all documents.

    The counts are grouped by a bounded set of shapes (at most 21 digit counts, 32 sets of
    marks, letters or not, 5 labels), so what comes to the driver does not grow with the data.
    """
    counts = arrow_map(texts(docs, id_col, text_col), "what string, value string, label int, n long", _count)
    rows = counts.groupBy("what", "value", "label").agg(F.sum("n").alias("n")).collect()
    by = {(r.what, r.value, r.label): r.n for r in rows}
    shapes = {}
    for (what, value, label), n in by.items():
        if what == "shape":
            shapes.setdefault(value, np.zeros(OTHER + 1))[label if label >= 0 else OTHER] += n
    prior = np.append(np.full(OTHER, 0.05), 0.8)
    node = {s: np.clip(np.log((v + prior) / (v.sum() + prior.sum())) - np.log(prior), -CLIP, CLIP)
            for s, v in shapes.items()}
    pair = np.ones((OTHER + 1, OTHER + 1))
    for (what, value, label), n in by.items():
        if what == "chain":
            pair[int(value) if int(value) >= 0 else OTHER, label if label >= 0 else OTHER] += n
    chain = np.log(pair / pair.sum()) - np.log(np.outer(pair.sum(1), pair.sum(0)) / pair.sum() ** 2)
    same, other = by.get(("skip", "True", 0), 0) + 20, by.get(("skip", "False", 0), 0) + 0.2
    skip = float(np.clip(math.log(same / other), 3.0, 8.0))
    return {"node": node, "prior": np.log(prior), "chain": np.clip(chain, -1.0, 1.0), "skip": skip}


def infer(text, nodes, model):
    """Marginals per mention by loopy sum-product; rule matches are observed."""
    chain, skip = graph(text, nodes)
    if not skip or all(k >= 0 for *_, k in nodes) or all(k < 0 for *_, k in nodes):
        return None  # nothing that a link could change
    n, states = len(nodes), OTHER + 1
    local = np.empty((n, states))
    for i, (a, b, label) in enumerate(nodes):
        if label >= 0:
            local[i] = -50.0
            local[i, label] = 0.0
        else:
            local[i] = model["prior"] + model["node"].get(shape(text[a:b]), 0.0)
    edges = np.array(chain + skip)
    table = np.empty((len(edges), states, states))
    table[:len(chain)] = model["chain"]
    table[len(chain):] = model["skip"] * np.eye(states)
    table[len(chain):, OTHER, OTHER] = model["skip"] * 0.5  # two mentions may well both be nothing
    source, target = np.r_[edges[:, 0], edges[:, 1]], np.r_[edges[:, 1], edges[:, 0]]
    factor = np.concatenate([table, table.transpose(0, 2, 1)])
    back = np.r_[np.arange(len(edges)) + len(edges), np.arange(len(edges))]
    sent = np.zeros((len(source), states))
    for _ in range(ROUNDS):
        belief = local.copy()
        np.add.at(belief, target, sent)
        out = belief[source] - sent[back]
        grid = out[:, :, None] + factor
        top = grid.max(1)
        new = top + np.log(np.exp(grid - top[:, None, :]).sum(1))
        new -= new.max(1, keepdims=True)
        moved = np.abs(new - sent).max()
        sent = 0.5 * sent + 0.5 * new
        if moved < 1e-3:
            break
    belief = local.copy()
    np.add.at(belief, target, sent)
    belief = np.exp(belief - belief.max(1, keepdims=True))
    return belief / belief.sum(1, keepdims=True)


def spans_of(text, model):
    """All spans of one text as (kind, start, end, added), by kind and start."""
    base = rule_spans(text)
    found = [(k, a, b, False) for k, a, b in base]
    if base:
        nodes = mentions(text, base)
        marginal = infer(text, nodes, model)
        if marginal is not None:
            for (a, b, label), p in zip(nodes, marginal):
                kind = int(p.argmax())
                if label < 0 and kind != OTHER and p[kind] >= ACCEPT:
                    found.append((kind, a, b, True))
            found.sort()
    return found


def _detect(batch, model):
    spans = [[(KINDS[k], a, b, added) for k, a, b, added in spans_of(text, model)]
             for text in batch.column("text").to_pylist()]
    return {"id": batch.column("id"),
            "spans": [[dict(zip(("kind", "start", "end", "added"), s)) for s in row] for row in spans]}


def detect(docs, id_col="doc_id", text_col="text", model=None):
    """(id, spans): every span with kind, start, end (code points) and whether the field added it."""
    model = model or train(docs, text_col, id_col)
    found = sliced_map(texts(docs, id_col, text_col), f"id {_type(docs, id_col)}, spans {SPAN}", _detect, model)
    return found.withColumnRenamed("id", id_col)


def _type(df, name):
    return df.schema[name].dataType.simpleString()


def _redact(batch, model):
    out = []
    for text in batch.column("text").to_pylist():
        if text is None:
            out.append(None)
            continue
        parts, edge = [], 0
        for a, b, k in sorted((a, b, k) for k, a, b, _ in spans_of(text, model)):
            if b <= edge:
                continue
            parts += [text[edge:max(a, edge)], f"[{KINDS[k].upper()}]"]
            edge = b
        out.append("".join([*parts, text[edge:]]) if parts else text)
    columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    return columns | {"text": out}


def redact(docs, text_col="text", id_col="doc_id", model=None):
    """The same rows and columns; every span in the text gives way to ``[KIND]``. Null stays null."""
    model = model or train(docs, text_col, id_col)
    names = docs.columns
    place = names.index(text_col)
    inner = docs.toDF(*["text" if i == place else f"c{i}" for i in range(len(names))])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema)
    return sliced_map(inner, schema, _redact, model).toDF(*names)
