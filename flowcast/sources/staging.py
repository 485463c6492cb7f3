"""Staged tables: cut a long lineage by writing it once to the shared folder."""

import uuid
from contextlib import contextmanager

from flowcast.session import delete_path, shared_dir

_SCOPES = []


@contextmanager
def staging(spark):
    """A scope for staged tables: on leaving it, all that was staged inside is deleted.

    Results are lazy, so write or collect them inside. Without a scope staged tables stay until
    the shared folder is cleaned, or, in a local session, until the process ends.
    """
    actions = []
    _SCOPES.append(actions)
    try:
        yield
    finally:
        _SCOPES.remove(actions)
        for undo in reversed(actions):
            undo()


def on_release(undo):
    """Run ``undo`` when the innermost open scope ends; nothing without one."""
    if _SCOPES:
        _SCOPES[-1].append(undo)


def scratch_path(spark, label):
    """A fresh path under the shared folder, deleted by the innermost open scope."""
    path = f"{shared_dir(spark)}/flowcast/{label}-{uuid.uuid4().hex}"
    on_release(lambda: delete_path(spark, path))
    return path


def stage(df, label):
    """Write ``df`` once as Parquet and read it back.

    Later steps that need the rows several times then neither repeat the work
    before this point nor depend on any executor that did it. The files give the
    planner exact sizes, so small staged tables broadcast by themselves.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
