import os

import pytest

from flowcast.operators import match as mt
from flowcast.sources import releases as rl

DOCS = [("m1", "a"), ("m2", None)]


def frames(spark, tag):
    return {"one": spark.createDataFrame([(1, tag), (2, None)], "id long, tag string"),
            "two": spark.createDataFrame([], "id long, tags array<string>")}


def tags(tables):
    return {r.tag for r in tables["one"].collect()}


def test_round_trip_and_newest(spark, tmp_path):
    root = f"file://{tmp_path}/r"
    saved = rl.save_release(frames(spark, "a"), root, "day-1")
    assert tags(saved) == {"a", None} and saved["two"].schema == frames(spark, "a")["two"].schema and saved["two"].count() == 0
    rl.save_release(frames(spark, "b"), root, "day-2")
    assert tags(rl.read_release(spark, root)) == {"b", None}
    assert tags(rl.read_release(spark, root, "day-1")) == {"a", None}
    assert rl.release_views(spark, root, prefix="rv_") == ["rv_one", "rv_two"]
    assert spark.sql("SELECT count(*) AS n FROM rv_one").first().n == 2


def test_rerun_repeats_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/r"
    rl.save_release(frames(spark, "a"), root, "day-1")
    before = sorted(os.listdir(tmp_path / "r"))
    assert tags(rl.save_release(frames(spark, "other"), root, "day-1")) == {"a", None}
    assert sorted(os.listdir(tmp_path / "r")) == before


def test_cut_off_save_leaves_the_old_tables(spark, tmp_path):
    root = f"file://{tmp_path}/r"
    rl.save_release(frames(spark, "a"), root, "day-1")
    broken = frames(spark, "b")
    broken["two"] = broken["one"].selectExpr("id", "raise_error('lost') AS tags")
    with pytest.raises(Exception, match="lost"):
        rl.save_release(broken, root, "day-2")
    assert tags(rl.read_release(spark, root)) == {"a", None}
    with pytest.raises(FileNotFoundError):
        rl.read_release(spark, root, "day-2")
    rl.save_release(frames(spark, "b"), root, "day-2")
    assert tags(rl.read_release(spark, root)) == {"b", None} and rl.read_release(spark, root)["one"].count() == 2
    gone = rl.sweep_releases(spark, root)
    assert len(gone) == 2 and tags(rl.read_release(spark, root)) == {"b", None}
    with pytest.raises(FileNotFoundError):
        rl.read_release(spark, root, "day-1")


def test_a_taken_number_is_not_overwritten(spark, tmp_path):
    path = f"file://{tmp_path}/00000001.json"
    assert rl._commit(spark, path, "first") and not rl._commit(spark, path, "second")
    assert (tmp_path / "00000001.json").read_text() == "first" and not [n for n in os.listdir(tmp_path) if n.endswith(".tmp")]


def test_names_and_empty_releases(spark, tmp_path):
    with pytest.raises(ValueError):
        rl.save_release(frames(spark, "a"), f"file://{tmp_path}", "../up")
    with pytest.raises(ValueError):
        rl.save_release({}, f"file://{tmp_path}", "x")
    with pytest.raises(FileNotFoundError):
        rl.read_release(spark, f"file://{tmp_path}/none")


def test_match_tables_together(spark, tmp_path):
    docs = spark.createDataFrame([], f"match_id string, {mt.MATCH_SCHEMA}")
    saved = mt.save_match_release(docs, f"file://{tmp_path}/m", "empty")
    assert set(saved) == set(mt.TABLES) and all(t.count() == 0 for t in saved.values())
