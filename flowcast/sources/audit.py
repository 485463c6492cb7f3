"""Check a written copy against its source without sorting or collecting either."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcast.sources.staging import stage


def _hashable(df):
    columns = []
    for field in df.schema.fields:
        column = F.col("`" + field.name.replace("`", "``") + "`")
        if isinstance(field.dataType, T.MapType):
            column = F.array_sort(F.map_entries(column))
        columns.append(column)
    return columns


def audit_copy(source, copy):
    """One row: row counts, files of the copy, and whether schema and content agree.

    Both sides are reduced per file before anything is shuffled. The hash sum needs
    no order and no join, and decimal(38,0) holds it for any row count.
    """
    # Names and types in order; files read back as nullable at every level.
    same_schema = source.dtypes == copy.dtypes

    def side(df, tag, file):
        return df.select(
            F.lit(tag).alias("side"),
            file.alias("file"),
            F.xxhash64(*_hashable(df)).cast("decimal(38,0)").alias("h"),
        )

    both = side(source, "source", F.lit("")).unionByName(side(copy, "copy", F.input_file_name()))
    per_file = both.groupBy("side", "file").agg(
        F.count("*").alias("n"), F.sum("h").alias("h")
    )

    def of(tag, column):
        return F.coalesce(F.sum(F.when(F.col("side") == tag, F.col(column))), F.lit(0))

    return per_file.agg(
        of("source", "n").alias("source_rows"),
        of("copy", "n").alias("copy_rows"),
        F.count_if(F.col("side") == "copy").alias("copy_files"),
        F.lit(same_schema).alias("schema_equal"),
        ((of("source", "n") == of("copy", "n")) & (of("source", "h") == of("copy", "h"))).alias(
            "content_equal"
        ),
    )


LEVELS = (6, 12, 18)


def digest_tree(df, keys, levels=LEVELS):
    """(level, node, n, h): rows and hash sum of every node of a hash tree over the rows of ``df``.

    A row falls to a node of each level by the first bits of its key's hash, so level 0 has at most 2^levels[0] nodes
    and the last 2^levels[-1], whatever the rows. Leaves are summed before the shuffle, upper levels from the leaves.
    The tree is small and can be kept beside a table, to compare copies later without reading it again.
    """
    leaves = df.select(
        _node(keys, levels[-1]).alias("node"), F.xxhash64(*_hashable(df)).cast("decimal(38,0)").alias("h")
    ).groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("h"))
    nodes = F.explode(F.array(*[
        F.struct(F.lit(i).alias("level"), F.shiftright("node", levels[-1] - bits).alias("node"))
        for i, bits in enumerate(levels)]))
    return leaves.select(nodes.alias("_at"), "n", "h").groupBy("_at.level", "_at.node").agg(
        F.sum("n").alias("n"), F.sum("h").cast("decimal(38,0)").alias("h"))


def _node(keys, bits):
    return F.shiftrightunsigned(F.xxhash64(*[F.col(k) for k in keys]), 64 - bits)


def differing_nodes(left, right, levels=LEVELS):
    """The leaves (``node``) in which two trees differ, found from the top down.

    A level is compared only below nodes that differ in the level above.
    """
    found = None
    for i, bits in enumerate(levels):
        a, b = (t.filter(F.col("level") == i).select("node", "n", "h") for t in (left, right))
        if found is not None:
            up = F.shiftright("node", bits - levels[i - 1])
            a, b = (t.withColumn("_up", up).join(found, "_up", "left_semi").drop("_up") for t in (a, b))
        both = a.withColumn("s", F.lit(1)).unionByName(b.withColumn("s", F.lit(-1)))
        differs = both.groupBy("node").agg(F.sum(F.col("s") * F.col("n")).alias("n"), F.sum(F.col("s") * F.col("h")).alias("h"))
        found = differs.filter("n <> 0 OR h <> 0").select(F.col("node").alias("_up"))
    return found.withColumnRenamed("_up", "node")


def audit_differences(source, copy, keys, levels=LEVELS, source_tree=None):
    """One row per key whose rows differ: its columns, kind, source_rows and copy_rows.

    ``kind`` is "missing" or "added" for keys of one side only, "fewer" or "repeated" for another number of rows, else
    "changed". Both tables are reduced to hash trees first; only rows of differing leaves are grouped by key,
    to a number and a hash sum, so a key of any number of rows is one row per task. Null keys are keys like any other.
    Columns are compared in order, by type and value; a NULL equals a NULL. ``source_tree`` is a kept ``digest_tree``.
    """
    if source.dtypes != copy.dtypes:
        raise ValueError("the copy has other columns or types")
    keys = list(keys)
    tree = source_tree if source_tree is not None else digest_tree(source, keys, levels)
    nodes = stage(differing_nodes(stage(tree, "tree"), stage(digest_tree(copy, keys, levels), "tree"), levels), "nodes")

    def suspects(df, side):
        row = F.xxhash64(*_hashable(df)).cast("decimal(38,0)").alias("_h")
        kept = df.select(*keys, row, _node(keys, levels[-1]).alias("node")).join(nodes, "node", "left_semi")
        return kept.withColumn("_side", F.lit(side))

    def of(side, column):
        return F.coalesce(F.sum(F.when(F.col("_side") == side, column)), F.lit(0))

    rows = suspects(source, "source").unionByName(suspects(copy, "copy"))
    sums = rows.groupBy(*keys).agg(
        of("source", F.lit(1)).alias("source_rows"), of("copy", F.lit(1)).alias("copy_rows"),
        (of("source", F.col("_h")) != of("copy", F.col("_h"))).alias("_changed"))
    a, b = F.col("source_rows"), F.col("copy_rows")
    kind = (F.when(b == 0, "missing").when(a == 0, "added").when(b < a, "fewer").when(b > a, "repeated")
            .when(F.col("_changed"), "changed"))
    return sums.select(*keys, kind.alias("kind"), "source_rows", "copy_rows").filter("kind IS NOT NULL")
