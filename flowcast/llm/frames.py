"""Small helpers the operators share: narrow inputs and Arrow maps over texts."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F


SLICE_BYTES = 2 << 20


def narrow(df, **columns):
    """Only the named columns, renamed: ``narrow(docs, id="doc_id", text="text")``.

    Columns of the caller that an operator does not use never reach its shuffles, and
    their names cannot clash with its own.
    """
    return df.select(*[df[f"`{name}`"].alias(alias) for alias, name in columns.items()])


def texts(df, id_col, text_col):
    """(id, text) with a null text read as the empty one."""
    return (narrow(df, id=id_col, text=text_col)
            .withColumn("text", F.coalesce("text", F.lit(""))))


def arrow_map(df, schema, rows, *args):
    """Apply ``rows(batch, *args) -> dict of columns`` to every Arrow batch."""
    target = schema_of(df.sparkSession, schema)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from to_batches(rows(batch, *args), target)

    return df.mapInArrow(run, schema)


def slices(batches, name="text", size=SLICE_BYTES):
    """The batches in runs of rows with about ``size`` bytes of text, at least one row each.

    Bounds what a step that unfolds texts holds at a time, however long the rows of a batch are.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(lengths) // size
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def release():
    """Gives freed memory back to the system: Python workers are used again by later stages."""
    import ctypes
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)    # where the C library has it
    if trim:
        trim(0)


def sliced_map(df, schema, rows, *args):
    """``arrow_map`` through slices of some ``SLICE_BYTES`` of the column ``text``; memory is released at the end."""
    target = schema_of(df.sparkSession, schema)

    def run(batches):
        for batch in slices(batches):
            yield from to_batches(rows(batch, *args), target)
        release()

    return df.mapInArrow(run, schema)


def schema_of(spark, ddl):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


def to_batches(columns, schema):
    table = pa.Table.from_arrays(
        [pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], (pa.Array, pa.ChunkedArray))
         else columns[f.name].cast(f.type) for f in schema], schema=schema)
    return table.to_batches()


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
