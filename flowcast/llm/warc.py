"""A deterministic, sharded writer of gzipped WARC 1.1 archives, and its reader.

Records are sorted by page id within shards that are contiguous ranges of ids. The ranges come
from sampled splitters: the ids with the smallest hashes (``SAMPLE`` of them), sorted, cut
evenly. So files depend on the data and the parameters alone, not on task order, partitioning
or retries. Each shard rolls to a new file once the compressed size reaches ``roll_bytes``.
Headers, lengths and digests are made anew from the payload, dates are fixed by parameter.

Equal payloads: the record with the smallest page id is a ``response``, the others are
``revisit`` records that name it. Only payloads of at least ``min_revisit_bytes`` take part.

Commit: a task writes to temporary names with a random part and returns manifest rows; the
manifest of the tasks that succeeded is written by Spark; then files get their final names,
one move each (repeatable: a file already moved is checked and skipped), and ``_SUCCESS`` goes last.
Leftovers of lost attempts keep temporary names that no manifest lists, and are never read.

Defined results: a null payload or address is an empty one; a null page id sorts first, has
the record id ``null`` and is always a response; repeated rows are all written, and all rows with
the smallest id of a group are responses; an empty table gives no archive but a
committed, empty manifest. No record is split or cut; one record is held in memory at a time.
"""

import base64
import hashlib
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import functions as F

from flowcast.llm.frames import narrow, schema_of, to_batches
from flowcast.sources.staging import scratch_path, stage

SAMPLE = 20000
ROLL_BYTES = 64 << 20
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "shard int, part int, temp string, name string, records long, bytes long, sha256 string"
RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, url string, payload binary")
_PAGE = "urn:page:"


def digest(payload):
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def marked(pages, id_col, payload_col, url_col, min_revisit_bytes):
    """Page rows with payload, digest and the id of the response they repeat.

    Equal payloads meet by SHA-256 in a pre-aggregated grouping of digests. Only groups of two
    and more are joined back; they are staged first, so that their size is known: small ones are
    broadcast by Spark, others joined with adaptive splitting of hot digests.
    """
    rows = narrow(pages, page_id=id_col, url=url_col, html=payload_col).select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce(F.encode("html", "utf-8"), F.lit(b"")).alias("html"))
    rows = rows.withColumn("strong", F.sha2("html", 256))
    first = (rows.where(F.octet_length("html") >= min_revisit_bytes).groupBy("strong")
             .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
             .where("copies > 1").drop("copies"))
    first = stage(first, "payloads")
    return rows.join(first, "strong", "left").select(
        "page_id", "url", "html", "strong",
        F.when(F.col("first_id") < F.col("page_id"), F.col("first_id")).alias("refers_to"))


def splitters(ids, shards, sample):
    """Sorted cut points between shards, from the ids with the smallest hashes (a bounded sample)."""
    picked = sorted(r[0] for r in ids.where("page_id is not null").distinct()
                    .orderBy(F.xxhash64("page_id"), "page_id").limit(sample).collect())
    return sorted({picked[len(picked) * i // shards] for i in range(1, shards)}) if picked else []


def _header(kind, page_id, url, payload_bytes, sha, refers_to, length, block_sha):
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_PAGE}{'null' if page_id is None else page_id}>",
             f"WARC-Date: {DATE}"]
    if url:
        lines.append("WARC-Target-URI: " + "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in url))
    lines += [f"WARC-Payload-Digest: sha1:{sha}", f"WARC-Block-Digest: sha1:{block_sha}",
              f"X-Payload-Length: {payload_bytes}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{_PAGE}{'null' if refers_to is None else refers_to}>"]
    content = "application/http; msgtype=response"
    return ("\r\n".join([*lines, f"Content-Type: {content}", f"Content-Length: {length}"]) + "\r\n\r\n").encode()


def record_bytes(kind, page_id, url, payload, sha, refers_to):
    """One gzip member: header, HTTP head, payload (none for a revisit)."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if kind == "revisit" else head + payload
    raw = _header(kind, page_id, url, len(payload), sha, refers_to, len(block), digest(block)) + block + b"\r\n\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


class _Shard:
    """Files of one shard, written under temporary names and rolled by compressed size."""

    def __init__(self, fs, folder, shard, roll):
        self.fs, self.folder, self.shard, self.roll = fs, folder, shard, roll
        self.part, self.out, self.rows = 0, None, []

    def add(self, data):
        if self.out is None:
            self.temp = f"_temporary/{self.shard:06d}-{self.part:05d}-{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.temp}", compression=None)
            self.n = self.size = 0
            self.hash = hashlib.sha256()
        self.out.write(data)
        self.hash.update(data)
        self.n, self.size = self.n + 1, self.size + len(data)
        if self.size >= self.roll:
            self.close()

    def close(self):
        if self.out is not None:
            self.out.close()
            self.rows.append((self.shard, self.part, self.temp, f"pages-{self.shard:06d}-{self.part:05d}.warc.gz",
                              self.n, self.size, self.hash.hexdigest()))
            self.part, self.out = self.part + 1, None


def _filesystem(uri):
    """The file system and plain path of a folder in the shared store."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _write(batches, folder, roll, target):
    fs, place = _filesystem(folder)
    shard, rows = None, []
    for batch in batches:
        for number, page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
            if shard is None or shard.shard != number:
                if shard is not None:
                    shard.close()
                    rows += shard.rows
                shard = _Shard(fs, place, number, roll)
            kind = "response" if refers_to is None else "revisit"
            shard.add(record_bytes(kind, page_id, url, html, digest(html), refers_to))
    if shard is not None:
        shard.close()
        rows += shard.rows
    yield from to_batches(dict(zip(target.names, zip(*rows))) if rows else {n: [] for n in target.names}, target)


def _commit(batches, folder):
    """Give files their final names; a file that has its name already is only checked."""
    fs, place = _filesystem(folder)
    for batch in batches:
        for row in batch.to_pylist():
            temp, name = f"{place}/{row['temp']}", f"{place}/{row['name']}"
            if fs.get_file_info(name).type == pafs.FileType.NotFound:
                fs.move(temp, name)
            if fs.get_file_info(name).size != row["bytes"]:
                raise IOError(f"{name} is not the file of the manifest")
        yield batch


def write(pages, folder=None, id_col="page_id", payload_col="html", url_col="url", shards=None,
          roll_bytes=ROLL_BYTES, min_revisit_bytes=0, sample=SAMPLE):
    """Write all rows as archives and commit them; returns the folder.

    The payload is shuffled once, to its shard, and sorted there on disk if need be. ``shards``
    is the number of ranges, by default the session's number of shuffle partitions.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    fs, place = _filesystem(folder)
    fs.create_dir(f"{place}/_temporary", recursive=True)
    rows = marked(pages, id_col, payload_col, url_col, min_revisit_bytes)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = np.array(splitters(narrow(pages, page_id=id_col), shards, sample), np.int64)
    shard_of = F.pandas_udf(lambda ids: pd.Series(np.searchsorted(cuts, ids, side="right")), "int")
    dealt = rows.withColumn("shard", shard_of(F.coalesce("page_id", F.lit(-2 ** 63))))
    dealt = (dealt.repartitionById(len(cuts) + 1, "shard")
             .sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "strong", "url")
             .select("shard", "page_id", "url", "html", "refers_to"))
    target = schema_of(spark, MANIFEST)
    files = dealt.mapInArrow(lambda it: _write(it, folder, roll_bytes, target), MANIFEST)
    files.write.parquet(f"{folder}/_manifest_new")
    written = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest_new")
    written.mapInArrow(lambda it: _commit(it, folder), MANIFEST).write.parquet(f"{folder}/_manifest")
    with fs.open_output_stream(f"{place}/_SUCCESS"):
        pass
    return folder


def _members(stream):
    """The decompressed gzip members of a stream, one at a time."""
    data, unpack, parts = stream.read(1 << 20), None, []
    while data:
        unpack = unpack or zlib.decompressobj(31)
        parts.append(unpack.decompress(data))
        data = unpack.unused_data
        if unpack.eof:
            yield b"".join(parts)
            unpack, parts = None, []
        data = data or stream.read(1 << 20)
    if unpack is not None:
        raise IOError("an archive ends inside a record")


def parse(raw):
    """The fields of RECORD of one record; lengths and digests are checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n" or digest(block) != fields["WARC-Block-Digest"][5:]:
        raise IOError(f"damaged record {fields['WARC-Record-ID']}")
    kind, sha = fields["WARC-Type"], fields["WARC-Payload-Digest"][5:]
    payload = block.partition(b"\r\n\r\n")[2]
    if kind == "response" and (digest(payload) != sha or len(payload) != int(fields["X-Payload-Length"])):
        raise IOError(f"damaged payload {fields['WARC-Record-ID']}")
    page = {k: None if k not in fields or fields[k] == f"<{_PAGE}null>" else int(fields[k][len(_PAGE) + 1:-1])
            for k in ("WARC-Record-ID", "WARC-Refers-To")}
    return {"page_id": page["WARC-Record-ID"], "payload_bytes": int(fields["X-Payload-Length"]),
            "payload_digest": sha, "record_type": kind, "refers_to": page["WARC-Refers-To"],
            "url": fields.get("WARC-Target-URI", ""), "payload": payload if kind == "response" else None}


def read_records(spark, folder, payloads=False):
    """All records of a committed folder; the manifest names the files, tasks stream them.

    ``payloads`` adds the payload bytes of responses.
    """
    fs, place = _filesystem(folder)
    if fs.get_file_info(f"{place}/_SUCCESS").type == pafs.FileType.NotFound:
        raise FileNotFoundError(f"{folder} is not committed")
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest").select("name")
    schema = RECORD if payloads else RECORD.rpartition(", ")[0]
    target = schema_of(spark, schema)

    def run(batches):
        fs, place = _filesystem(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with fs.open_input_stream(f"{place}/{name}", compression=None) as stream:
                    rows, size = [], 0
                    for raw in _members(stream):
                        rows.append(parse(raw))
                        size += len(raw)
                        if size > 8 << 20:
                            yield from to_batches({n: [r[n] for r in rows] for n in target.names}, target)
                            rows, size = [], 0
                    yield from to_batches({n: [r[n] for r in rows] for n in target.names}, target)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(n, "name").mapInArrow(run, schema)
