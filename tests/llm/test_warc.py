import base64
import gzip
import hashlib
import io
from collections import Counter

import pytest

from flowcast.llm import warc
from flowcast.sources.staging import scratch_path

PAGES = [(i, f"http://h{i % 3}.example.com/{i}", f"<html>{'page' if i % 4 else 'same'} {i if i % 4 else ''}</html>" * 5) for i in range(40)]
ODD = [(100, None, None), (101, "", ""), (102, "http://x/\r\nEvil: 1", "\r\n\r\nWARC/1.1\r\n"), (103, "u", "é" * 3000), (None, "n", "same"),
       (5, PAGES[5][1], PAGES[5][2]), (104, "big", "a<b>" * 300000)]
SCHEMA = "page_id long, url string, html string"


def sha(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def plain(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= least:
            first[html or ""] = min(first.get(html or "", i), i)
    out = Counter()
    for i, _, html in rows:
        target = first.get(html or "")
        again = i is not None and target is not None and target < i
        out[i, len((html or "").encode()), sha(html), "revisit" if again else "response", target if again else None] += 1
    return out


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*r, "x") for r in PAGES + ODD], SCHEMA + ", shard string").repartition(5)


def files(folder):
    fs, place = warc._filesystem(folder)
    names = sorted(f.base_name for f in fs.get_file_info(warc.pafs.FileSelector(place)) if f.base_name.endswith(".warc.gz"))
    return {n: fs.open_input_stream(f"{place}/{n}", compression=None).read() for n in names}


@pytest.mark.parametrize("least, roll", [(0, 1 << 26), (200, 2000)])
def test_round_trip(spark, pages, least, roll):
    folder = warc.write(pages, shards=4, roll_bytes=roll, min_revisit_bytes=least)
    got = warc.read_records(spark, folder, payloads=True).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == plain(PAGES + ODD, least)
    assert Counter(bytes(r.payload) for r in got if r.payload is not None) <= Counter((h or "").encode() for *_, h in PAGES + ODD)
    assert {r.url for r in got if r.page_id == 102} == {"http://x/%0D%0AEvil: 1"}


def test_files_depend_on_the_data_alone(spark, pages):
    one = files(warc.write(pages, shards=3, roll_bytes=3000))
    two = files(warc.write(pages.repartition(2, "url"), shards=3, roll_bytes=3000))
    assert one == two and len(one) > 3
    for data in one.values():  # standard gzip reads them, and records stand in order of ids
        text = io.TextIOWrapper(gzip.GzipFile(fileobj=io.BytesIO(data)), "utf-8", newline="").read()
        ids = [int(line[24:-1]) for line in text.split("\r\n") if line.startswith("WARC-Record-ID: <urn:page:") and "null" not in line
               for line in [line.replace("WARC-Record-ID: <urn:page:", " " * 24)]]
        assert ids == sorted(ids)


def test_uncommitted_folders_are_not_read(spark):
    with pytest.raises(FileNotFoundError):
        warc.read_records(spark, scratch_path(spark, "nothing"))


def test_commit_can_be_repeated(spark, pages):
    folder = warc.write(pages, shards=2)
    manifest = spark.read.parquet(f"{folder}/_manifest_new")
    assert manifest.mapInArrow(lambda it: warc._commit(it, folder), warc.MANIFEST).count() == manifest.count()


def test_damage_is_seen():
    raw = gzip.decompress(warc.record_bytes("response", 1, "u", b"<p>text", warc.digest(b"<p>text"), None))
    assert warc.parse(raw)["page_id"] == 1
    with pytest.raises(IOError):
        warc.parse(raw.replace(b"<p>text", b"<p>tezt"))


def test_empty_table(spark):
    folder = warc.write(spark.createDataFrame([], SCHEMA))
    assert warc.read_records(spark, folder).collect() == []
