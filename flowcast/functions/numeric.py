"""Small numeric helpers, NULL-safe under ANSI mode."""

from functools import reduce
from operator import add

from pyspark.sql import functions as F

from flowcast.functions.calendar import as_column


def clip_below(c, floor=0.0):
    """Values under ``floor`` become ``floor``; NULL stays NULL."""
    c = as_column(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(floor)))


def filled(c, value=0):
    return F.coalesce(as_column(c), F.lit(value))


def row_total(columns):
    """Sum across columns of one row."""
    return reduce(add, [as_column(c) for c in columns])


def by_case(c, table, default=None):
    """Constant picked by the value of ``c`` from a declared dict."""
    c = as_column(c)
    out = F.lit(default)
    for key, value in table.items():
        out = F.when(c == F.lit(key), F.lit(value)).otherwise(out)
    return out
