"""Best-fit packing of tokenised documents into sequences of at most ``CAPACITY`` tokens.

1. Documents become token ids, cut into pieces of ``CAPACITY`` only where they are longer.
2. The histogram of piece lengths (at most ``CAPACITY`` numbers, whatever the data) is a cutting-stock problem. Its
   configuration linear program (lengths grouped to units, short pieces left out as fillers) is solved by
   multiplicative weights: every length has a price, a knapsack dynamic program finds the configurations of the
   highest total price around each length and the dual bound, and prices and shares of configurations are balanced
   against each other until the cover is within ``GAP`` of the bound. Multiplicities are rounded within what is there;
   what rounding leaves and the fillers go by best fit, longest first, in bulk per length.
3. A plan maps (length, rank among pieces of that length) to (sequence, offset) in closed form. Ranks are dealt in
   blocks of pieces, so a length that a third of all pieces share is no bottleneck: counts by block and length,
   running sums over blocks, ranks inside blocks.

Defined results: a null text is the empty one, a piece of just the closing id. Null ids and repeated rows are
packed like any other row. An empty table gives an empty table.

A text is tokenised word by word (between ASCII white space) with a cache per worker: the tokenizer splits at white
space and normalises within words only, so the ids of a text are the ids of its words in order.
"""

import bisect
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowcast.llm.frames import release, schema_of, slices, texts, to_batches
from flowcast.sources.staging import stage

CAPACITY, CLOSING = 4096, 1
UNITS, LEAST_UNITS = 256, 16
ROUNDS, STEPS, RATE, GAP, LEAST_SHARE = 40, 1000, 0.2, 0.005, 1e-4
CACHE_BYTES, WORD_BYTES, BLOCK_PIECES, MIN_BLOCKS = 48 << 20, 230, 50_000, 64


# UTF-8 bytes of lower-case Latin letters, then signs. In byte-level vocabularies bytes C3 and A1-BF stand for the character of
# their number, 80-A0 for U+0122 on and AD for U+0143. A vocabulary that spells the trial words otherwise takes the general way.
_SIMPLE = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]*)")
_BYTE_LETTERS = {c: 0x0122 + c - 0x80 for c in range(0x80, 0xA1)} | {0xAD: 0x0143}
_TRIALS = ("abc", "thesisthe", *map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]), ".,;:!?", "$$$", "%%%,", "(-/@[`{~")


class _Words(dict):
    """word -> its ids, both as bytes, in two generations of at most ``CACHE_BYTES`` each.

    ``WORD_BYTES`` is what an entry takes beside its word and ids. A full generation takes the place of the older one,
    from which words still in use come back.
    """

    def __init__(self, path):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.older, self.held = {}, 0
        self.mark = self.ids("0")
        self.plain = all(self.spell(w.encode()) == self.ids(w).tobytes() for w in _TRIALS)

    def ids(self, text):
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def spell(self, piece):
        text = piece.decode() if piece.isascii() else piece.decode("latin-1").translate(_BYTE_LETTERS)
        return b"".join([t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(text)])

    def learn(self, words):
        if self.held > CACHE_BYTES:
            self.older, self.held = dict(self), 0
            self.clear()
        new = []
        for word in {w for w in words if w not in self}:
            if word in self.older:
                self[word] = self.older[word]
            else:
                new.append(word)
            self.held += WORD_BYTES + 2 * len(word)
        if self.plain:
            for word in new:
                simple = _SIMPLE.fullmatch(word)
                if simple:  # letters, then signs: two pieces for the model, as its splitter would make them
                    letters, signs = simple.groups()
                    for part in (letters, signs):
                        if part and part not in self:
                            self[part] = self.older.get(part) or self.spell(part)
                    if signs:
                        self.held += WORD_BYTES
                        self[word] = self[letters] + self[signs]
        new = [w for w in new if w not in self]
        for word in new if len(self.mark) != 1 else [w for w in new if b"0" in w or b"<|" in w]:
            self[word] = self.ids(word.decode()).tobytes()
        # the others in one text, a digit between them: a digit is a token of its own, found in none of these words
        together = [w for w in new if w not in self]
        for i in range(0, len(together), 5000):
            part = together[i:i + 5000]
            ids = self.ids((b" 0 ".join(part) + b" 0").decode())
            ends = np.flatnonzero(ids == self.mark[0]) * 4
            data = ids.tobytes()
            for word, a, b in zip(part, [0, *(ends[:-1] + 4).tolist()], ends.tolist()):
                self[word] = data[a:b]


_WORDS = {}
# a capital that a mark may follow: composed before it is folded it may give other ids, since not every pair has both cases
_MARKED = re.compile(rb"[A-Z][\x80-\xff]")


def _folded(data):
    """The words of a UTF-8 text, A-Z folded where that cannot change their ids."""
    if b"<|" in data:
        return data.split()
    if data.isascii() or not _MARKED.search(data):
        return data.lower().split()
    return [w if _MARKED.search(w) else w.lower() for w in data.split()]


def tokenise(data, path):
    """Ids of a UTF-8 text and the closing id, as little-endian bytes.

    The tokenizer folds case, so A-Z are folded first, for fewer different words; where a special token could
    stand, they are not, since those are matched before, nor in words where a sign beyond ASCII follows one of
    them directly, since the tokenizer composes marks before it folds. Only ASCII white space splits; other kinds of
    it are left to the tokenizer.
    """
    known = _WORDS.get(path)
    if known is None:
        known = _WORDS[path] = _Words(path)
    words = _folded(data)
    try:
        body = b"".join(map(known.__getitem__, words))
    except KeyError:
        known.learn(words)
        body = b"".join(map(known.__getitem__, words))
    return body + CLOSING.to_bytes(4, "little")


def _pieces(batches, path, capacity, target):
    for batch in slices(batches):
        rows = []
        for i, text in zip(batch.column("id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
            ids = tokenise(text, path)
            for n, start in enumerate(range(0, len(ids), 4 * capacity)):
                piece = ids[start:start + 4 * capacity]
                rows.append((i, n, start // 4, len(piece) // 4, zlib.crc32(piece)))
        yield from to_batches(dict(zip(target.names, zip(*rows))) if rows else {n: [] for n in target.names}, target)
    release()


def pieces(docs, path, id_col="doc_id", text_col="text", capacity=CAPACITY):
    """(id, piece, start, length, ids_crc32) of every piece."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long"
    target = schema_of(docs.sparkSession, schema)
    return texts(docs, id_col, text_col).mapInArrow(lambda it: _pieces(it, path, capacity, target), schema)


def price_rooms(sizes, prices, capacity):
    """(highest total price, counts per size) for every room from 0 to ``capacity``, by dynamic programming."""
    best, counts = np.zeros(capacity + 1), np.zeros((capacity + 1, len(sizes)), np.int64)
    for room in range(1, capacity + 1):
        best[room], counts[room] = best[room - 1], counts[room - 1]
        n = np.searchsorted(sizes, room, side="right")
        if n:
            gain = prices[:n] + best[room - sizes[:n]]
            i = gain.argmax()
            if gain[i] > best[room]:
                best[room], counts[room] = gain[i], counts[room - sizes[i]]
                counts[room, i] += 1
    return best, counts


def price_knapsack(sizes, prices, most, capacity):
    """Counts per size of the configuration with the highest total price."""
    return np.minimum(price_rooms(sizes, prices, capacity)[1][capacity], most).astype(np.int64)


def balance(cover, share, weight):
    """Shares of configurations and weights of lengths that answer each other, by optimistic multiplicative weights.

    ``cover`` is (configuration, length): the part of the length's demand that one copy covers. Configurations gain by
    what they cover at the present weights, lengths lose weight by how far they are covered, each step counting the
    last change twice. The averages of the second half are returned.
    """
    gain, covered = cover @ weight, share @ cover
    rate = RATE / (gain @ share)
    log_share, log_weight = np.log(np.maximum(share, 1e-30)), np.log(np.maximum(weight, 1e-30))
    shares, weights = np.zeros_like(share), np.zeros_like(weight)
    for step in range(STEPS):
        gain_now, covered_now = cover @ weight, share @ cover
        log_share += rate * (2 * gain_now - gain)
        log_weight -= rate * (2 * covered_now - covered)
        gain, covered = gain_now, covered_now
        share, weight = np.exp(log_share - log_share.max()), np.exp(log_weight - log_weight.max())
        share, weight = share / share.sum(), weight / weight.sum()
        if step >= STEPS // 2:
            shares, weights = shares + share, weights + weight
    return shares / shares.sum(), weights / weights.sum()


def program(sizes, demand, capacity):
    """({configuration: multiplicity} covering the demand, lower bound of any such cover).

    Every round prices each length by its weight over its demand; one dynamic program gives the best configuration
    around every length, and its highest price the dual bound. Shares and weights are balanced over the configurations
    found so far. Rounds end once what the shares leave uncovered costs at most ``GAP`` of the bound, after ``ROUNDS``
    at the latest; that rest is covered by filling configurations, one length or more done with each. Work depends on
    the number of lengths, never on the number of pieces. Where long pieces prevail the last round may come first: 3 %
    above the bound were seen for equally many pieces of all 241 lengths from 16 units.
    """
    lengths = np.arange(len(sizes))
    configs = np.diag(np.minimum(capacity // sizes, np.ceil(demand))).astype(float)
    share, weight = np.full(len(sizes), 1 / len(sizes)), sizes * demand / (sizes @ demand)
    bound, scales = 0.0, np.linspace(0.9, 1.05, 61)
    for _ in range(ROUNDS):
        best, counts = price_rooms(sizes, weight / demand, capacity)
        bound = max(bound, 1 / best[capacity])
        fresh = counts[capacity - sizes].astype(float)
        fresh[lengths, lengths] += 1
        held = share > LEAST_SHARE / len(share)
        known = dict(zip(map(bytes, configs[held]), share[held]))
        configs = np.unique(np.vstack([configs[held], np.minimum(fresh, np.ceil(demand))]), axis=0)
        share = np.array([known.get(bytes(c), 0.0) for c in configs])
        share = 0.7 * share / share.sum() + 0.3 / len(configs)
        share, weight = balance(configs / demand, share, weight)
        rest = np.maximum(0, demand - scales[:, None] * bound * (share @ configs))
        cost = scales * bound + rest @ np.maximum(sizes / capacity, weight / demand * bound)
        at = cost.argmin()
        if cost[at] <= (1 + GAP) * bound:
            break
    found = {}

    def take(config, amount):
        key = tuple((int(j), int(config[j])) for j in np.flatnonzero(config)[::-1])
        found[key] = found.get(key, 0.0) + float(amount)

    for config, amount in zip(configs, share * scales[at] * bound):
        take(config, amount)
    left = rest[at]
    while (left > 1e-9 * demand).any():
        open_ = left > 1e-9 * demand
        config = np.where(open_, price_knapsack(sizes, np.where(open_, sizes, 0.0), np.ceil(demand), capacity), 0)
        used = config > 0
        amount = (left[used] / config[used]).min()
        take(config, amount)
        left = np.where(open_, left - config * amount, 0.0)
    # what floating point left open, at most 1e-9 of a demand
    grow = 1 + 2e-9
    return {key: x * grow for key, x in found.items()}, bound


def solve(sizes, demand, capacity):
    """{configuration: multiplicity} covering the demand."""
    return program(sizes, demand, capacity)[0]


def round_down(found, classes, left):
    """[(configuration of lengths, copies)] in whole multiplicities, taken out of ``left``.

    Configurations stand in order of their lengths, and each gets the whole steps that the running sum of
    multiplicities makes over it, as far as pieces are left: neighbours share their fractions, so little is lost.
    """
    queue = {c: [n for n in lengths if left[n]] for c, lengths in classes.items()}
    stock = {c: sum(left[n] for n in lengths) for c, lengths in queue.items()}
    bins, due = [], 0.5
    for key, amount in sorted(found.items(), reverse=True):
        due += amount
        copies = min([int(due), *(stock[c] // k for c, k in key)])
        due -= int(due)
        if not copies:
            continue
        groups = [((), copies)]
        for c, k in key:
            stock[c] -= k * copies
            for _ in range(k):      # one piece of the class in every copy, longest lengths first
                dealt = []
                for config, n in groups:
                    while n:
                        length = queue[c][0]
                        some = min(n, left[length])
                        dealt.append((config + ((length, 1),), some))
                        left[length] -= some
                        n -= some
                        if not left[length]:
                            queue[c].pop(0)
                groups = dealt
        bins += groups
    return bins


def best_fit(left, capacity, bins=()):
    """[(configuration, copies)] of best fit decreasing over a histogram {length: pieces}, in bulk.

    ``bins`` are open already and are filled up like any other.
    """
    done, open_, rooms = [], {}, []

    def put(config, room, copies):
        if copies:
            if room not in open_:
                open_[room] = []
                bisect.insort(rooms, room)
            open_[room].append((config, copies))

    for config, copies in bins:
        put(config, capacity - sum(s * k for s, k in config), copies)
    for length in sorted((n for n in left if left[n]), reverse=True):
        n = left[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                config, copies = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
            else:
                room, config, copies = capacity, (), n
            fit = room // length
            full = min(copies, n // fit)
            put(config + ((length, fit),), room - fit * length, full)
            n -= full * fit
            rest = copies - full
            if n and rest:  # the last, not quite filled
                some = min(n, fit)
                put(config + ((length, some),), room - some * length, 1)
                n -= some
                rest -= 1
            if config:
                put(config, room, rest)
    for room in rooms:
        done += open_[room]
    return done


def reopen(bins, left):
    """The bins without their last, shortest piece, which goes back to ``left`` where a bin has others.

    The program knows lengths by class only; the piece that closes a bin is better chosen by its exact length.
    """
    out = []
    for config, copies in bins:
        if len(config) > 1:
            left[config[-1][0]] += copies
            config = config[:-1]
        out.append((config, copies))
    return out


def make_plan(histogram, capacity=CAPACITY):
    """[(configuration, copies)]: every piece of the histogram exactly once.

    The program covers pieces of at least ``LEAST_UNITS / UNITS`` of the capacity. More than ``UNITS`` different lengths
    are rounded to whole units of ``capacity / UNITS`` tokens, and the last piece of each configuration is chosen
    by its exact length: it is longer than all rounding in its configuration, so no bin overflows. Last pieces,
    shorter ones and what rounding leaves fill up by best fit.
    """
    least = LEAST_UNITS * max(1, capacity // UNITS)
    left, classes = dict(histogram), {}
    unit = 1 if sum(n >= least for n in left) <= UNITS else max(1, capacity // UNITS)
    for length in sorted(left, reverse=True):
        if length >= least:
            classes.setdefault((length + unit // 2) // unit, []).append(length)
    bins = []
    if classes:
        sizes = np.array(sorted(classes))
        demand = np.array([sum(histogram[n] for n in classes[c]) for c in sizes], float)
        found = {tuple((int(sizes[j]), k) for j, k in key): x
                 for key, x in solve(sizes, demand, capacity // unit).items()}
        bins = round_down(found, classes, left)
        if unit > 1:
            bins = reopen(bins, left)
    return best_fit(left, capacity, bins)


def slots(plan):
    """Arrays of (length, first rank, first sequence, pieces per sequence, first offset), sorted."""
    rows, taken, sequence = [], {}, 0
    for config, copies in plan:
        offset = 0
        for length, k in config:
            rank = taken.get(length, 0)
            rows.append((length, rank, sequence, k, offset))
            taken[length] = rank + k * copies
            offset += k * length
        sequence += copies
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(batches, table, target):
    key = table[:, 0] << 46 | table[:, 1]
    for batch in batches:
        columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        length, rank = columns["length"].to_numpy(), columns.pop("rank").to_numpy()
        row = table[np.searchsorted(key, length << 46 | rank, side="right") - 1]
        inner = rank - row[:, 1]
        columns["sequence_id"] = row[:, 2] + inner // row[:, 3]
        columns["offset"] = row[:, 4] + inner % row[:, 3] * length
        yield from to_batches(columns, target)


def pack(docs, path, id_col="doc_id", text_col="text", capacity=CAPACITY):
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    spark = docs.sparkSession
    cut = stage(pieces(docs, path, id_col, text_col, capacity), "pieces")
    rows = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``capacity`` rows
    histogram = {r.length: r.n for r in rows}
    table = slots(make_plan(histogram, capacity))
    blocks = max(MIN_BLOCKS, -(-sum(histogram.values()) // BLOCK_PIECES))
    dealt = cut.withColumn("block", F.pmod(F.xxhash64("id", "piece", "start", "ids_crc32"), F.lit(blocks)).cast("int"))
    sizes = dealt.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    base = sizes.select("length", "block", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(W.partitionBy("length", "block").orderBy("id", "piece", "ids_crc32"))
    ranked = dealt.withColumn("inside", inside).join(base, ["length", "block"]).select(
        "id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("inside") - 1).alias("rank"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    target = schema_of(spark, schema)
    return ranked.mapInArrow(lambda it: _place(it, table, target), schema).withColumnRenamed("id", id_col)
