"""Session helper for local runs, and the shared folder every job stages through."""

import atexit
import os
import shutil

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(name="flowcast", cpus=None, **conf):
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    settings = dict(DEFAULTS)
    settings["spark.sql.shuffle.partitions"] = str(cpus)
    settings["spark.driver.memory"] = "12g"
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark):
    """Folder all executors can reach, for staged tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where driver and
    executors are one process, may do without: it gets a folder of its own beside Spark's
    local files, deleted when the process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    local = context.getConf().get("spark.local.dir", "/tmp").split(",")[0]
    folder = f"{local}/flowcast-{context.applicationId}"
    context.setCheckpointDir(folder)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return context.getCheckpointDir().rstrip("/")


def delete_path(spark, path):
    """Remove a file or folder through Spark's own file systems."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def shuffle_partitions(spark):
    """The session's number of shuffle partitions.

    For steps that expand rows after a shuffle: the adaptive planner merges partitions
    by their size before the expansion, unless a number is asked for.
    """
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
