"""Several tables saved together, all or nothing.

A release is written to a folder of its own, and becomes visible by one rename of its manifest. Until then readers see the
release before it, whatever was lost on the way; a save that is started again after its commit does nothing.
"""

import json
import re
import uuid

from pyspark.sql import types as T

from flowcast.session import delete_path
from flowcast.sources.writers import quoted

_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def _fs(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _children(spark, path):
    fs, place = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def _commit(spark, path, text):
    """Write a small text under a temporary name and rename it; False if the name is taken."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs, final = _fs(spark, path)
    temporary = hadoop.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(temporary, False)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    context = hadoop.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(context.makeQualified(temporary), context.makeQualified(final), options)
    except Exception:
        fs.delete(temporary, False)
        if fs.exists(final):
            return False
        raise
    return True


def _manifests(spark, root):
    """Committed manifests in order of their number."""
    out = []
    for name in _children(spark, f"{root}/_manifests"):
        if re.fullmatch(r"[0-9]{8}\.json", name):
            lines = spark.read.text(f"{root}/_manifests/{name}", wholetext=True).first()
            out.append((int(name[:8]), json.loads(lines["value"])))
    return out


def save_release(tables, root, release, fmt="parquet"):
    """Save ``tables`` = {name: DataFrame} as one release under ``root``; returns {name: DataFrame} read from it.

    A ``release`` already committed is not written again, whatever ``tables`` hold. One that was cut off is written anew beside
    what it left. Of two writers of one release the first to commit wins and both return its rows.
    """
    for name in [release, *tables]:
        if not _NAME.fullmatch(name):
            raise ValueError(f"{name!r} is no name for a folder")
    if not tables:
        raise ValueError("a release needs at least one table")
    spark = next(iter(tables.values())).sparkSession
    known = _manifests(spark, root)
    if not any(m["release"] == release for _, m in known):
        folder = f"{release}-{uuid.uuid4().hex}"
        entries = {}
        for name, table in tables.items():
            table.write.format(fmt).mode("error").save(f"{root}/{folder}/{name}")
            entries[name] = {"path": f"{folder}/{name}", "schema": json.loads(table.schema.json())}
        text = json.dumps({"release": release, "format": fmt, "folder": folder, "tables": entries}, sort_keys=True)
        fs, place = _fs(spark, f"{root}/_manifests")
        fs.mkdirs(place)
        number = known[-1][0] + 1 if known else 1
        while not _commit(spark, f"{root}/_manifests/{number:08d}.json", text):
            known = _manifests(spark, root)
            if any(m["release"] == release for _, m in known):
                break
            number = known[-1][0] + 1
    return read_release(spark, root, release)


def read_release(spark, root, release=None):
    """The tables of a committed release by name, of the newest one by default."""
    known = _manifests(spark, root)
    found = [m for _, m in known if release in (None, m["release"])]
    if not found:
        raise FileNotFoundError(f"no committed release{f' {release!r}' if release else ''} under {root}")
    manifest = found[-1] if release is None else found[0]
    return {name: spark.read.format(manifest["format"]).schema(T.StructType.fromJson(entry["schema"])).load(f"{root}/{entry['path']}")
            for name, entry in manifest["tables"].items()}


def release_views(spark, root, release=None, prefix=""):
    """Session views of a release's tables; all of one release, since the manifest is read once."""
    tables = read_release(spark, root, release)
    for name, table in tables.items():
        table.createOrReplaceTempView(quoted(prefix + name))
    return [prefix + name for name in tables]


def sweep_releases(spark, root, keep=1):
    """Delete all but the newest ``keep`` releases, and what saves left that never committed.

    Run it while nobody writes or reads older releases. Manifests go first, so none ever points at missing files.
    """
    if keep < 1:
        raise ValueError("keep at least one release")
    known = _manifests(spark, root)
    stay = {m["folder"] for _, m in known[-keep:]}
    for number, _ in known[:-keep]:
        delete_path(spark, f"{root}/_manifests/{number:08d}.json")
    gone = [name for name in _children(spark, root) if name != "_manifests" and name not in stay]
    for name in gone:
        delete_path(spark, f"{root}/{name}")
    for name in _children(spark, f"{root}/_manifests"):
        if name.endswith(".tmp"):
            delete_path(spark, f"{root}/_manifests/{name}")
    return gone
