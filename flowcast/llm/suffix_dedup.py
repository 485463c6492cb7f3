"""Removal of repeated strings of ``WINDOW`` bytes with a distributed, sparse suffix array.

A byte goes if a string of WINDOW bytes that covers it also starts in a document with a smaller id. Sorting every
suffix of the corpus would shuffle each byte many times over, so the array is sparse: a string of WINDOW bytes is
represented by one of its inner positions, its *anchor*, the GRAM-byte piece with the smallest hash in it (the
leftmost of equal ones). The choice depends on the string alone, so equal strings have equal anchors, at equal offsets, in all documents;
every string has exactly one. About one position in 14 is an anchor.

1. Documents are dealt to blocks by a hash. Each block lists the hashes of its anchor pieces, packed, to buckets;
   buckets reply which occur in more than one block. Anchors whose piece occurs once in the corpus are done.
2. The others become suffix records: the bytes a string of this anchor can reach, on either side, with the document.
   Equal records of a block are merged to the smallest document. Records are range-partitioned by their leading bytes with sampled
   splitters. A boundary never parts equal leading GRAM bytes, so strings that may match meet in one bucket.
3. Buckets sort the suffixes by multikey sort (8 bytes at a time, only ties go on), and the reversed left parts likewise;
   neighbours are compared to longest common prefixes. A string at offset o of its anchor is equal in two records if
   their suffixes agree on WINDOW - o bytes and their left parts on o bytes, so two runs of prefix lengths give its class exactly.
   Every string of a class but those of its smallest document is marked.
4. Marked strings return to their blocks, and documents are cut.

A piece that very many different records share (``HOT``, a memory bound that ordinary data does not reach) is treated
string by string instead: every string is a record of its own, dealt by a hash of its bytes and merged within blocks, so that even
such a group is spread, and complete. Whole texts enter three times from one shuffle, which Spark reuses.

Defined results: a null text is the empty one. Rows with a null id neither lose bytes nor take any from others.
Repeated rows have equal ids, so neither is smaller; both lose what smaller documents hold. Texts shorter than WINDOW stay whole. An
empty table gives an empty table.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from flowcast.llm.frames import narrow, schema_of

WINDOW, GRAM = 50, 24
REACH = WINDOW - GRAM            # an anchor starts at offset 0..REACH of its string
SPAN = REACH + WINDOW            # bytes its strings can cover
BLOCK_BYTES, RANGES, HOT = 8 << 20, 4, 2_000_000
SLICE = 1 << 13                  # rows of bytes at a time
SAMPLE_DOCS, SAMPLE_HEADS = 512, 64
_TABLE = np.random.default_rng(50).integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ROW = np.random.default_rng(24).integers(0, 1 << 63, SPAN + 2, dtype=np.uint64) | np.uint64(1)
_CHUNK = 1 << 16
_LOW = np.uint64((1 << 40) - 1)


def _power(n):
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def gram_hashes(data):
    """A mixed 64-bit hash of the GRAM bytes from every position."""
    h1 = _TABLE[data]
    h2 = h1[:-1] * _power(1) + h1[1:]
    h4 = h2[:-2] * _power(2) + h2[2:]
    h8 = h4[:-4] * _power(4) + h4[4:]
    h16 = h8[:-8] * _power(8) + h8[8:]
    h = h16[:-8] * _power(8) + h8[16:]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def anchors(data, edges):
    """(hash, position, first start, last start, document) of every anchor of concatenated documents."""
    found = []
    size = len(data) - WINDOW + 1
    valid = np.zeros(max(size, 0), bool)
    for a, b in zip(edges[:-1], edges[1:]):
        if b - a >= WINDOW:
            valid[a:b - WINDOW + 1] = True
    step = _CHUNK - REACH
    for at in range(0, size, step):
        part = data[at:at + _CHUNK + GRAM - 1]
        ok = np.flatnonzero(valid[at:min(at + step, size)])
        if not len(ok):
            continue
        h = gram_hashes(part)
        m = (h & ~np.uint64(0xFFFF)) | np.arange(len(h), dtype=np.uint64)
        for width in (1, 2, 4, 8):
            m = np.minimum(m[:-width], m[width:])
        m = np.minimum(m[:-(REACH + 1 - 16)], m[REACH + 1 - 16:])
        place = (m[ok] & np.uint64(0xFFFF)).astype(np.int64)
        new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (ok[1:] != ok[:-1] + 1)])
        found.append((h[place[new]], place[new] + at, ok[new] + at, ok[np.r_[new[1:] - 1, len(ok) - 1]] + at))
    if not found:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none, none
    h, place, first, last = (np.concatenate(x) for x in zip(*found))
    # a run that goes on in the next chunk is one
    new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (first[1:] != last[:-1] + 1)])
    last = last[np.r_[new[1:] - 1, len(last) - 1]]
    place = place[new]
    return h[new], place, first[new], last, np.searchsorted(edges, place, side="right") - 1


def load(table):
    """Distinct documents of a block: ids, keys, bytes, edges; and which of them each row is."""
    ids, keys = table.column("id").to_numpy(), table.column("key").to_numpy()
    order = np.lexsort((keys, ids))
    new = np.r_[True, (ids[order][1:] != ids[order][:-1]) | (keys[order][1:] != keys[order][:-1])][:len(order)]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    first = order[new]
    texts = table.column("text").combine_chunks()
    texts = texts.take(pa.array(first)).cast(pa.large_binary())
    sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[:len(first) + 1])
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    edges = np.r_[0, np.cumsum(sizes)].astype(np.int64)
    return ids[first], keys[first], data[:edges[-1]], edges, which


def multikey_sort(words):
    """Order of rows of 64-bit words: by the first word, only ties by the next, and so on."""
    order = np.argsort(words[:, 0], kind="stable")
    new = np.r_[True, words[order[1:], 0] != words[order[:-1], 0]][:len(order)]
    for depth in range(1, words.shape[1]):
        run = np.cumsum(new)
        tied = np.flatnonzero(~new | np.r_[~new[1:], False])
        if not len(tied):
            break
        rows = order[tied]
        inner = np.lexsort((words[rows, depth], run[tied]))
        order[tied] = rows[inner]
        value = words[order[tied], depth]
        differs = np.r_[True, (value[1:] != value[:-1]) | (run[tied][1:] != run[tied][:-1])]
        new[tied] |= differs
    return order


def words_of(rows):
    """Rows of bytes as big-endian 64-bit words, zeros at the end."""
    width = -(-rows.shape[1] // 8) * 8
    wide = np.zeros((len(rows), width), np.uint8)
    wide[:, :rows.shape[1]] = rows
    return wide.view(">u8").astype(np.uint64)


def common_prefix(rows, order):
    """Longest common prefix of each row with the one before it in order (0 for the first)."""
    out = np.zeros(len(order), np.int64)
    for lo in range(1, len(order), SLICE):
        hi = min(lo + SLICE, len(order))
        differ = rows[order[lo:hi]] != rows[order[lo - 1:hi - 1]]
        out[lo:hi] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def covered(context, doc, low, high):
    """Which strings (record, offset) also lie in a record of a smaller document."""
    n = len(doc)
    marks = np.zeros((n, REACH + 1), bool)
    if not n:
        return marks
    right, left = context[:, REACH:], np.ascontiguousarray(context[:, REACH - 1::-1] if REACH else context[:, :0])
    by_right, by_left = multikey_sort(words_of(right)), multikey_sort(words_of(left))
    right_common, left_common = common_prefix(right, by_right), common_prefix(left, by_left)
    for offset in range(REACH + 1):
        rows = np.flatnonzero((low <= offset) & (offset <= high))
        if len(rows) < 2:
            continue
        right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
        right_class[by_right] = np.cumsum(right_common < WINDOW - offset)
        left_class[by_left] = np.cumsum(left_common < offset)
        key = right_class[rows] * (n + 1) + left_class[rows]
        order = np.argsort(key, kind="stable")
        begins = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
        least = np.minimum.reduceat(doc[rows][order], begins)
        smallest = np.repeat(least, np.diff(np.r_[begins, len(order)]))
        marks[rows[order], offset] = doc[rows][order] > smallest
    return marks


def _gram_key(h, buckets):
    bucket = ((h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    return bucket, (h & _LOW).astype(np.uint64)


def _pack40(values, tail):
    """Ascending 40-bit numbers as differences, byte plane by byte plane, which compresses well, and a byte for each."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return np.vstack([steps.view(np.uint8).reshape(-1, 8)[:, :5].T, tail[None, :]]).tobytes()


def _unpack40(data):
    planes = np.frombuffer(data, np.uint8).reshape(6, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :5] = planes[:5].T
    return np.cumsum(wide.view("<u8").ravel().astype(np.uint64), dtype=np.uint64), planes[5]


def _pack_documents(ids, keys):
    """The distinct (id, key) pairs, and for each row which of them it is."""
    pair = np.empty(len(ids), [("id", "<i8"), ("key", "<i8")])
    pair["id"], pair["key"] = ids, keys
    known, at = np.unique(pair, return_inverse=True)
    return known.tobytes(), at.ravel().astype("<u4").tobytes()


def _unpack_documents(known, at):
    pairs = [np.frombuffer(k, [("id", "<i8"), ("key", "<i8")])[np.frombuffer(a, "<u4")] for k, a in zip(known, at)]
    both = np.concatenate(pairs) if pairs else np.empty(0, [("id", "<i8"), ("key", "<i8")])
    return both["id"], both["key"]


def _list_grams(table, buckets, target):
    """A block's anchor pieces, packed per bucket, with the logarithm of how often each occurs."""
    _, _, data, edges, _ = load(table)
    h, n = np.unique(anchors(data, edges)[0], return_counts=True)
    bucket, value = _gram_key(h, buckets)
    order = np.lexsort((value, bucket))
    value, tail = value[order], np.ceil(np.log2(n[order])).astype(np.uint8)
    numbers, begins = np.unique(bucket[order], return_index=True)
    ends = np.r_[begins[1:], len(order)]
    return pa.table({"bucket": numbers, "block": np.full(len(numbers), table.column("block")[0].as_py()),
                     "grams": [_pack40(value[a:b], tail[a:b]) for a, b in zip(begins, ends)]}, target)


def _find_shared(table, hot, target):
    """For every block the pieces of a bucket that another block has as well; the tail marks hot ones."""
    got = [_unpack40(g) for g in table.column("grams").to_pylist()]
    source = np.repeat(np.arange(len(got)), [len(v) for v, _ in got])
    value, logs = np.concatenate([v for v, _ in got]), np.concatenate([t for _, t in got])
    order = np.argsort(value, kind="stable")
    value, source, logs = value[order], source[order], logs[order]
    begins = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
    size = np.diff(np.r_[begins, len(value)])
    total = np.add.reduceat(2.0 ** logs, begins)
    keep = np.repeat(size > 1, size) | (np.repeat(total > hot, size))
    value, source, tail = value[keep], source[keep], np.repeat(total > hot, size)[keep].astype(np.uint8)
    order = np.lexsort((value, source))
    value, tail = value[order], tail[order]
    rows, begins = np.unique(source[order], return_index=True)
    ends = np.r_[begins[1:], len(order)]
    blocks = table.column("block").to_numpy()
    return pa.table({"block": blocks[rows], "bucket": np.full(len(rows), table.column("bucket")[0].as_py()),
                     "grams": [_pack40(value[a:b], tail[a:b]) for a, b in zip(begins, ends)]}, target)


def _contexts(data, place, low, high):
    """The bytes strings of each anchor reach, others zero."""
    out, column = np.empty((len(place), SPAN), np.uint8), np.arange(SPAN)
    for a in range(0, len(place), SLICE):
        b = slice(a, a + SLICE)
        at = np.clip(place[b, None] - REACH + column[None, :], 0, max(len(data) - 1, 0))
        inside = (column[None, :] >= REACH - high[b, None]) & (column[None, :] < SPAN - low[b, None])
        out[b] = data[at] * inside
    return out


def _records(table, replies, gram_buckets, buckets, splitters, target):
    """Suffix records of a block by range bucket, and the strings already known to repeat."""
    ids, keys, data, edges, _ = load(table)
    h, place, first, last, document = anchors(data, edges)
    _, back, n = np.unique(h, return_inverse=True, return_counts=True)
    bucket, value = _gram_key(h, gram_buckets)
    own = (bucket.astype(np.uint64) << np.uint64(40)) | value
    shared, hot = np.zeros(len(h), bool), np.zeros(len(h), bool)
    if replies.num_rows:
        got = [_unpack40(g) for g in replies.column("grams").to_pylist()]
        numbers = replies.column("bucket").to_numpy().astype(np.uint64)
        known = np.concatenate([(b << np.uint64(40)) | v for b, (v, _) in zip(numbers, got)])
        tail = np.concatenate([t for _, t in got])
        order = np.argsort(known)
        known, tail = known[order], tail[order]
        spot = np.minimum(np.searchsorted(known, own), len(known) - 1)
        shared = known[spot] == own
        hot = shared & (tail[spot] == 1)
    keep = np.flatnonzero(shared | (n[back] > 1))
    place, hot, document = place[keep], hot[keep], document[keep]
    low, high = place - last[keep], place - first[keep]
    if hot.any():  # one record per string
        rows = np.flatnonzero(hot)
        size = high[rows] - low[rows] + 1
        each = np.repeat(rows, size)
        offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low[rows], size)
        cold = np.flatnonzero(~hot)
        place, document = np.r_[place[cold], place[each]], np.r_[document[cold], document[each]]
        low, high = np.r_[low[cold], offset], np.r_[high[cold], offset]
        hot = np.r_[np.zeros(len(cold), bool), np.ones(len(each), bool)]
    kept, spans = [], []
    code = np.zeros(len(place), np.uint64)
    for a in range(0, len(place), SLICE):
        b = slice(a, a + SLICE)
        context = _contexts(data, place[b], low[b], high[b])
        code[b] = (context * _ROW[:SPAN]).sum(1) + low[b].astype(np.uint64) * _ROW[SPAN] + high[b].astype(np.uint64) * _ROW[SPAN + 1]
    code ^= code >> np.uint64(31)
    order = np.lexsort((ids[document], code))
    begins = np.r_[True, code[order][1:] != code[order][:-1]][:len(order)]
    head = order[np.flatnonzero(begins)][np.cumsum(begins) - 1] if len(order) else order
    for a in range(0, len(order), SLICE):
        mine, lead = order[a:a + SLICE], head[a:a + SLICE]
        later = np.flatnonzero(ids[document[mine]] > ids[document[lead]])
        x, y = mine[later], lead[later]
        same = (low[x] == low[y]) & (high[x] == high[y]) & (
            _contexts(data, place[x], low[x], high[x]) == _contexts(data, place[y], low[y], high[y])).all(1)
        spans.append(x[same])
        stays = np.ones(len(mine), bool)
        stays[later[same]] = False
        kept.append(mine[stays])
    none = np.zeros(0, np.int64)
    kept, spans = (np.concatenate(x) if x else none for x in (kept, spans))
    base = edges[document]
    block = table.column("block")[0].as_py()
    out = {name: [] for name in target.names}

    def add(number, kind, rows, context):
        out["bucket"].append(number)
        out["block"].append(block)
        out["marked"].append(kind)
        out["context"].append(context.tobytes())
        known, which = _pack_documents(ids[document[rows]], keys[document[rows]])
        out["documents"].append(known)
        out["which"].append(which)
        out["place"].append((place[rows] - base[rows]).astype("<u4").tobytes())
        out["low"].append(low[rows].astype(np.uint8).tobytes())
        out["high"].append(high[rows].astype(np.uint8).tobytes())

    if len(spans):
        add(block % buckets, True, spans, np.zeros(0, np.uint8))
    cold, warm = kept[~hot[kept]], kept[hot[kept]]
    context = _contexts(data, place[cold], low[cold], high[cold])
    order = multikey_sort(words_of(context[:, REACH:REACH + GRAM])) if len(cold) else cold
    cold, context = cold[order], context[order]
    heads = np.ascontiguousarray(context[:, REACH:REACH + GRAM]).view(f"S{GRAM}").ravel()
    cuts = np.r_[0, np.searchsorted(heads, splitters), len(cold)]
    for number in range(len(cuts) - 1):
        a, b = cuts[number], cuts[number + 1]
        if b > a:
            add(number, False, cold[a:b], context[a:b])
    if len(warm):
        context = _contexts(data, place[warm], low[warm], high[warm])
        number = (code[warm] % np.uint64(buckets)).astype(np.int64)
        for one in np.unique(number):
            rows = np.flatnonzero(number == one)
            add(int(one), False, warm[rows], context[rows])
    return pa.table(out, target)


def _compare(table, target):
    """Sort and compare the suffixes of a range bucket; strings to remove go back to their blocks."""
    n = [len(x) for x in table.column("low").to_pylist()]
    join = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
    ids, keys = _unpack_documents(table.column("documents").to_pylist(), table.column("which").to_pylist())
    place = join("place", "<u4").astype(np.int64)
    low, high = join("low", np.uint8).astype(np.int64), join("high", np.uint8).astype(np.int64)
    block = np.repeat(table.column("block").to_numpy(), n)
    marked = np.repeat(table.column("marked").to_numpy(zero_copy_only=False), n)
    open_ = np.flatnonzero(~marked)
    marks = covered(join("context", np.uint8).reshape(-1, SPAN), ids[open_], low[open_], high[open_])
    wide = np.zeros((len(open_), REACH + 3), np.int8)
    wide[:, 1:-1] = marks
    edge = np.diff(wide, axis=1)
    row, begin = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1] - 1          # offsets begin..end are marked
    rows = np.r_[open_[row], np.flatnonzero(marked)]
    start = np.r_[place[open_[row]] - end, (place - high)[marked]]
    stop = np.r_[place[open_[row]] - begin, (place - low)[marked]] + WINDOW
    order = np.argsort(block[rows], kind="stable")
    rows, start, stop = rows[order], start[order], stop[order]
    numbers, begins = np.unique(block[rows], return_index=True)
    ends = np.r_[begins[1:], len(rows)]
    cut = lambda x, kind: [x[a:b].astype(kind).tobytes() for a, b in zip(begins, ends)]
    packed = [_pack_documents(ids[rows][a:b], keys[rows][a:b]) for a, b in zip(begins, ends)]
    return pa.table({"block": numbers, "documents": [d for d, _ in packed], "which": [w for _, w in packed],
                     "start": cut(start, "<u4"), "length": cut(stop - start, np.uint8)}, target)


def _cut(table, spans, target):
    """Documents of a block without the marked bytes."""
    ids, keys, data, edges, which = load(table)
    cover = np.zeros(len(data) + 1, np.int32)
    if spans.num_rows:
        join = lambda name, kind: np.frombuffer(b"".join(spans.column(name).to_pylist()), kind).astype(np.int64)
        pair = np.empty(len(ids), [("id", "<i8"), ("key", "<i8")])
        pair["id"], pair["key"] = ids, keys
        want_id, want_key = _unpack_documents(spans.column("documents").to_pylist(), spans.column("which").to_pylist())
        want = np.empty(len(want_id), pair.dtype)
        want["id"], want["key"] = want_id, want_key
        start = edges[np.searchsorted(pair, want)] + join("start", "<u4")
        np.add.at(cover, start, 1)
        np.add.at(cover, start + join("length", np.uint8), -1)
    gone = np.cumsum(cover[:-1]) > 0
    rows = []
    for a, b in zip(edges[:-1], edges[1:]):
        g = gone[a:b]
        kept = data[a:b][~g].tobytes()
        rows.append((b - a, int(g.sum()), int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()), kept))
    n, removed, runs, kept = (list(x) for x in zip(*rows))
    pick = lambda x: [x[i] for i in which]
    out = {"id": ids[which], "n_bytes": pick(n), "n_removed": pick(removed), "n_spans": pick(runs),
           "kept_sha256": pick([hashlib.sha256(k).hexdigest() for k in kept])}
    if "kept" in target.names:
        out["kept"] = pick(kept)
    return pa.table(out, target)


def _heads(batches, target):
    for batch in batches:
        for text in batch.column("text").to_pylist():
            data = np.frombuffer(text, np.uint8)
            h, place, *_ = anchors(data, np.array([0, len(data)]))
            pick = np.argsort(h, kind="stable")[:SAMPLE_HEADS]
            yield from pa.table({"head": [data[p:p + GRAM].tobytes() for p in place[pick]]}, target).to_batches()


def splitters(rows, buckets):
    """Cut points between range buckets: evenly spaced heads of suffixes of a bounded sample."""
    spark = rows.sparkSession
    picked = rows.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(
        max(SAMPLE_DOCS, buckets // 16)).select(F.col("id").alias("picked"))
    sample = rows.join(F.broadcast(picked), F.col("id") == F.col("picked")).select("text")
    target = schema_of(spark, "head binary")
    heads = sorted({bytes(r["head"]) for r in sample.mapInArrow(lambda it: _heads(it, target), "head binary").collect()})
    cuts = sorted({heads[len(heads) * i // buckets] for i in range(1, buckets)}) if heads else []
    return np.array(cuts, f"S{GRAM}")


def remove_repeats(docs, id_col="doc_id", text_col="text", block_bytes=BLOCK_BYTES, hot=HOT, keep_bytes=False):
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row; ``keep_bytes`` adds the bytes that stay."""
    spark = docs.sparkSession
    rows = narrow(docs, id=id_col, text=text_col).select(
        F.col("id").cast("long").alias("id"), F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("text"))
    known = rows.where("id is not null")
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // block_bytes))
    ranges = RANGES * blocks
    cuts = splitters(known, ranges)
    gram_buckets = max(min(blocks, int(spark.conf.get("spark.sql.shuffle.partitions"))), blocks // 4)
    schema = lambda ddl: (ddl, schema_of(spark, ddl))

    dealt = (known.withColumn("key", F.xxhash64("id", "text"))
             .withColumn("block", F.pmod("key", F.lit(blocks)).cast("int")).repartition(blocks, "block"))
    ddl, t1 = schema("bucket int, block int, grams binary")
    grams = dealt.groupBy("block").applyInArrow(lambda table: _list_grams(table, gram_buckets, t1), ddl)
    ddl, t2 = schema("block int, bucket int, grams binary")
    replies = grams.groupBy("bucket").applyInArrow(lambda table: _find_shared(table, hot, t2), ddl)
    ddl, t3 = schema("bucket int, block int, marked boolean, context binary, documents binary, which binary, place binary, low binary, high binary")
    records = dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        lambda table, got: _records(table, got, gram_buckets, ranges, cuts, t3) if table.num_rows else pa.table({n: [] for n in t3.names}, t3), ddl)
    ddl, t4 = schema("block int, documents binary, which binary, start binary, length binary")
    spans = records.groupBy("bucket").applyInArrow(lambda table: _compare(table, t4), ddl)
    ddl, t5 = schema("id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes)
    out = dealt.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(
        lambda table, got: _cut(table, got, t5) if table.num_rows else pa.table({n: [] for n in t5.names}, t5), ddl)
    whole = rows.where("id is null").select(
        "id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"), *(["text"] * keep_bytes))
    return out.unionAll(whole).withColumnRenamed("id", id_col)
