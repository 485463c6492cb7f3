"""Views, SQL over views, and schema introspection."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcast.sources.writers import quoted


def register_view(df, name):
    """Session view under any name; returns the quoted name to use in SQL."""
    df.createOrReplaceTempView(quoted(name))
    return quoted(name)


def query_view(spark, name, columns=("*",), where=None):
    """``SELECT columns FROM name [WHERE where]``."""
    text = f"SELECT {', '.join(columns)} FROM {quoted(name)}"
    return spark.sql(f"{text} WHERE {where}" if where else text)


def struct_fields(df, path):
    """Field names of the struct at a dotted path."""
    kind = df.select(F.col(path).alias("x")).schema["x"].dataType
    if not isinstance(kind, T.StructType):
        raise TypeError(f"{path!r} is {kind.simpleString()}, not a struct")
    return kind.fieldNames()


def schema_rows(df):
    """The schema as rows ``(path, type)``, nested structs included."""
    rows = []

    def walk(struct, prefix):
        for field in struct.fields:
            path = prefix + field.name
            kind = field.dataType
            rows.append((path, kind.simpleString()))
            while isinstance(kind, T.ArrayType):
                path, kind = path + "[]", kind.elementType
            if isinstance(kind, T.StructType):
                walk(kind, path + ".")

    walk(df.schema, "")
    return df.sparkSession.createDataFrame(rows, "path string, type string")
