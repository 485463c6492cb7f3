"""Nested documents to flat rows."""

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcast.functions.calendar import as_column
from flowcast.sources.readers import read_text

CORRUPT = "_corrupt_record"
_STEP = re.compile(r"([^.\[\]]+)|\[(\d+)\]")


def at(path):
    """Column at a path such as ``info.dates[0]``, or a tuple of names and positions.

    Names may hold spaces. A position outside the array gives NULL, and a name below
    an array of structs gives the array of that field.
    """
    if isinstance(path, str):
        path = [int(i) if i else name for name, i in _STEP.findall(path)]
    column = F.col("`" + path[0].replace("`", "``") + "`")
    for step in path[1:]:
        column = F.get(column, F.lit(step)) if isinstance(step, int) else column.getField(step)
    return column


def project(df, paths, keep=()):
    """Select ``paths`` = {alias: path} after the columns in ``keep``."""
    return df.select(*keep, *[at(path).alias(alias) for alias, path in paths.items()])


def explode_rows(df, array, alias, keep=(), outer=False, position=None):
    """One row per element; empty and NULL arrays vanish unless ``outer``."""
    array = at(array) if isinstance(array, (str, tuple, list)) else array
    if position:
        generator = F.posexplode_outer(array) if outer else F.posexplode(array)
        return df.select(*keep, generator.alias(position, alias))
    generator = F.explode_outer(array) if outer else F.explode(array)
    return df.select(*keep, generator.alias(alias))


def tagged_rows(df, arrays, alias, tag, keep=()):
    """Elements of several arrays as rows, tagged: {tag value: path}.

    One pass over the documents; a union of one explode per array would read them
    once per array, and sibling explodes would multiply the rows.
    """
    entries = F.array(*[
        F.struct(F.lit(value).alias("tag"), at(path).alias("items"))
        for value, path in arrays.items()
    ])
    per_array = df.select(*keep, F.inline(entries))
    return per_array.select(*keep, F.explode("items").alias(alias), F.col("tag").alias(tag))


def map_rows(df, column, key="key", value="value", keep=()):
    """One row per map entry."""
    return df.select(*keep, F.explode(at(column)).alias(key, value))


def struct_rows(df, column, key="key", value="value", keep=()):
    """One row per field of a struct whose field names are data.

    The struct goes through JSON text into a map, so no field name is listed. Fields
    that are NULL in a document are absent from it, as they were in its source.
    """
    as_map = F.from_json(F.to_json(at(column)), "map<string,string>")
    return df.select(*keep, F.explode(as_map).alias(key, value))


def parse_json(df, text, schema, out="json_data", mode="PERMISSIVE", corrupt=True, **options):
    """Parse a JSON text column by schema; unreadable text is kept beside the NULLs.

    ``corrupt=False`` leaves that column out, so that Spark parses only the fields in use.
    """
    options = {"mode": mode, **options}
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    if isinstance(schema, T.StructType) and mode == "PERMISSIVE" and corrupt:
        wider = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        options["columnNameOfCorruptRecord"] = CORRUPT
        return df.withColumn(out, F.from_json(as_column(text), wider, options))
    return df.withColumn(out, F.from_json(as_column(text), schema, options))


def expand_root(df, parsed, schema, text=None, keep=()):
    """Columns of the parsed root: an object's own, or one row per array element.

    With ``text`` given, unreadable documents stay as one row of NULLs and their text.
    """
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    if not isinstance(schema, T.ArrayType):
        return df.select(*keep, f"{parsed}.*")
    if text is None:
        return df.select(*keep, F.explode(parsed).alias("_item")).select(*keep, "_item.*")
    bad = F.col(parsed).isNull() & F.col(text).isNotNull()
    items = df.select(
        *keep, F.when(bad, F.col(text)).alias(CORRUPT), F.explode_outer(parsed).alias("_item")
    )
    whole = items.filter(F.col("_item").isNotNull() | F.col(CORRUPT).isNotNull())
    return whole.select(*keep, "_item.*", CORRUPT)


def process_nested_json(spark, path, schema, whole=True, flat=False, explode_arrays=False):
    """Read JSON text, parse it by schema and expand the root to columns.

    ``whole`` takes a file as one document, however many lines it spans; ``False``
    takes a document per line and keeps large files splittable.
    """
    text = read_text(spark, path, whole)
    out = expand_root(parse_json(text, "value", schema), "json_data", schema, "value")
    return flatten(out, explode_arrays) if flat else out


def _unique(names):
    """Names in order, a repeated one with the next free number behind it."""
    out, seen = [], set(names)
    used = set()
    for name in names:
        new, n = name, 1
        while new in used or (n > 1 and new in seen):
            n += 1
            new = f"{name}_{n}"
        used.add(new)
        out.append(new)
    return out


def flatten(df, explode_arrays=False, separator="_"):
    """Nested structs to top-level columns; optionally arrays to rows, level by level.

    All arrays of a level are exploded together, element by element: rows carry the elements
    of one position, NULL where an array is shorter, so siblings never multiply. Empty
    ones keep a row of NULLs. Columns that would share a name are numbered.
    """
    while True:
        fields = df.schema.fields
        if any(isinstance(f.dataType, T.StructType) for f in fields):
            columns, names = [], []
            for field in fields:
                base = at((field.name,))
                if isinstance(field.dataType, T.StructType):
                    for inner in field.dataType.fieldNames():
                        columns.append(base.getField(inner))
                        names.append(field.name + separator + inner)
                else:
                    columns.append(base)
                    names.append(field.name)
            df = df.select(*[c.alias(n) for c, n in zip(columns, _unique(names))])
            continue
        arrays = [f.name for f in fields if isinstance(f.dataType, T.ArrayType)]
        if not (explode_arrays and arrays):
            return df
        aligned = F.arrays_zip(*[F.coalesce(at((n,)), F.array()).alias(f"a{i}") for i, n in enumerate(arrays)])
        rows = df.select("*", F.explode_outer(aligned).alias("_row")) if "_row" not in df.columns else None
        if rows is None:
            raise ValueError("a column may not be named _row")
        df = rows.select(*[
            F.col("_row").getField(_zip_names(rows)[arrays.index(f.name)]).alias(f.name) if f.name in arrays else at((f.name,))
            for f in fields
        ])


def _zip_names(rows):
    return rows.schema["_row"].dataType.fieldNames()


def parse_variant(df, text, out="doc"):
    """JSON text to a VARIANT column, no schema declared; unreadable text is kept beside a NULL."""
    parsed = F.try_parse_json(text)
    bad = F.when(parsed.isNull() & F.col(text).isNotNull(), F.col(text))
    return df.select("*", parsed.alias(out), bad.alias(CORRUPT))


def variant_pairs(df, column, path="$", key="key", value="value", keep=()):
    """One row per entry of the object (or array) at ``path`` of a VARIANT column, whatever its keys.

    Documents without that path, or with a scalar there, give no row. Array elements have a NULL key; scalars come as
    text, objects and arrays as JSON text.
    """
    spark, at_path = df.sparkSession, F.try_variant_get(column, path, "variant")
    rows = df.select(*keep, at_path.alias("_object"))
    entries = spark.tvf.variant_explode(F.col("_object").outer())
    entries = entries.select(F.col("key").alias(key), F.col("value").cast("string").alias(value))
    return rows.lateralJoin(entries).drop("_object")


def _is_container(column):
    return F.coalesce(F.schema_of_variant(column).rlike("^(OBJECT|ARRAY)<."), F.lit(False)) & (
        ~F.to_json(column).isin("{}", "[]"))


def variant_leaves(df, column, keep=(), depth=4):
    """(path, value) of every scalar in a VARIANT column, objects with unlike keys side by side.

    A path is like ``info.dates[0]``; a JSON null is a NULL value. Containers below ``depth`` levels and empty ones
    are leaves of their JSON text; a document that is a scalar itself has the empty path, a NULL document no row.
    Each level is one generate over the rows of the level before: no shuffle, no schema, no text parsed twice.
    """
    spark = df.sparkSession
    rows = df.select(*keep, F.lit("").alias("path"), F.col(column).alias("_v")).filter(F.col("_v").isNotNull())
    for _ in range(depth):
        inner = F.when(_is_container(F.col("_v")), F.col("_v"))
        rows = rows.select(*keep, "path", "_v", inner.alias("_inner"))
        entries = spark.tvf.variant_explode_outer(F.col("_inner").outer()).select(
            F.col("pos").alias("_pos"), F.col("key").alias("_key"), F.col("value").alias("_value"))
        step = (F.when(F.col("_inner").isNull(), F.lit(""))
                .when(F.col("_key").isNull(), F.concat(F.lit("["), F.col("_pos").cast("string"), F.lit("]")))
                .otherwise(F.concat(F.when(F.col("path") == "", F.lit("")).otherwise(F.lit(".")), F.col("_key"))))
        rows = rows.lateralJoin(entries).select(
            *keep, F.concat("path", step).alias("path"),
            F.when(F.col("_inner").isNull(), F.col("_v")).otherwise(F.col("_value")).alias("_v"))
    return rows.select(*keep, "path", F.col("_v").cast("string").alias("value"))
