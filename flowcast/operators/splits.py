"""Train/test splits and time slices."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowcast.functions.calendar import as_column, day_bucket, plus


def holdout_start(df, ts, days):
    """Scalar: ``days`` before the last time of all series."""
    return plus(df.agg(F.max(ts).alias("last")).scalar(), days=-days)


def holdout_by_days(df, ts, days=30, segment="segment", start=None, keys=()):
    """Tag rows from the holdout start on "test", earlier ones "train".

    With ``keys`` each series has a start of its own, ``days`` before its own last time.
    """
    if keys:
        start = plus(F.max(ts).over(Window.partitionBy(*keys)), days=-days)
    start = holdout_start(df, ts, days) if start is None else start
    tag = F.when(as_column(ts) < start, "train").otherwise("test")
    return df.select("*", tag.alias(segment))


def between(df, ts, lo, hi):
    """Closed slice: both ends included."""
    return df.filter(as_column(ts).between(lo, hi))


def before(df, ts, t):
    return df.filter(as_column(ts) < t)


def since(df, ts, t):
    return df.filter(as_column(ts) >= t)


def one_day(df, ts, day):
    """Rows of one calendar day, as a half-open range so a scan can prune on it."""
    start = day_bucket(day)
    return df.filter((as_column(ts) >= start) & (as_column(ts) < plus(start, days=1)))


def random_split(df, key, fractions=(0.75, 0.25), names=("train", "test"), seed=42, segment="segment"):
    """Tag every row with a part, by the hash of its key: one pass, and the same on every run.

    The first 32 bits of MD5 over "seed:key" are compared with the summed fractions.
    """
    text = F.concat_ws(":", F.lit(seed).cast("string"), F.coalesce(as_column(key).cast("string"), F.lit("")))
    place = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    tag, edge = F.lit(names[-1]), sum(fractions)
    for name, share in reversed(list(zip(names, fractions))):
        tag = F.when(place < F.lit(int(edge * 2 ** 32)), F.lit(name)).otherwise(tag)
        edge -= share
    return df.select("*", tag.alias(segment))
