"""Ordinal ids for dimension values."""

from pyspark.sql import functions as F

from flowcast.functions.calendar import as_column
from flowcast.operators.windows import global_row_index
from flowcast.sources.staging import stage


def position_in(c, values):
    """1-based position in a declared list, NULL if absent; no join."""
    found = F.array_position(F.array(*[F.lit(v) for v in values]), as_column(c))
    return F.nullif(found, F.lit(0).cast("bigint"))


def dimension_table(df, column, id_name):
    """Distinct values with ids from 1 in value order, for any number of values."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return stage(global_row_index(values, [column], id_name), "dimension")


def with_dimension_id(df, column, id_name, dimension=None):
    """Add the id of ``column``'s value.

    The dimension is a staged table, so the planner knows its size: it is broadcast
    while small, and otherwise joined by shuffle with adaptive skew splitting.
    """
    dimension = dimension_table(df, column, id_name) if dimension is None else dimension
    return df.join(dimension, column, "left").select(*df.columns, id_name)
