"""One row per key."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F


def keep_one(df, keys, order):
    """First row of every key in the given order.

    ``row_number() = 1`` makes Spark cut every map task down to one row per key before the shuffle
    (WindowGroupLimit), so a key holding a large part of the table never meets in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_position", F.row_number().over(window))
        .where("_position = 1")
        .drop("_position")
    )


def keep_latest(df, keys, ingested="_ingested_at", ties=()):
    """Most recently ingested row per key."""
    return keep_one(df, keys, [F.col(ingested).desc(), *[F.col(c).asc() for c in ties]])


def keep_best(df, keys, score="score", ingested="_ingested_at", ties=()):
    """Highest score per key, the most recently ingested one among equals."""
    order = [F.col(score).desc(), F.col(ingested).desc(), *[F.col(c).asc() for c in ties]]
    return keep_one(df, keys, order)


def split_null_keys(df, keys):
    """(rows with complete keys, rejected rows). A NULL key can never be merged again."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(complete), df.where(~complete)
