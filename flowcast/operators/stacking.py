"""Unions with a tag."""

from functools import reduce

from pyspark.sql import functions as F


def stack_tagged(parts, tag):
    """Union by name of {tag value: DataFrame}; absent columns become NULL."""
    tagged = [df.withColumn(tag, F.lit(value)) for value, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def stack(*parts):
    """Union by name, columns an input lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
