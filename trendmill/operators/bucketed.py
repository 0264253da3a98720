"""A current table in buckets by key, so that an upsert moves only the rows that come in.

The table lies in Spark's catalog, bucketed and sorted by its keys. A merge shuffles the source into the
same buckets and joins each with the bucket that is already there.
"""

from pyspark.sql import functions as F

from trendmill.operators.merge import merge_upsert

BUCKETS = 64


def _next(name):
    return f"{name}__next"


#: Texts of many rows are compressed together.
_PACKED = {"compression": "zstd", "parquet.page.size": 4 * 2**20}


def _store(rows, name, keys, buckets):
    rows.write.mode("overwrite").options(**_PACKED).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def append_bucketed(rows, name, keys, buckets=BUCKETS):
    """Adds rows to the table ``name``, which the first call makes; keys may repeat. Give rows dealt by their keys."""
    rows.write.mode("append").options(**_PACKED).bucketBy(buckets, *keys).saveAsTable(name)


def _swap(spark, name):
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {_next(name)} RENAME TO {name}")


def _mend(spark, name):
    """Ends a swap that broke off after the old table went."""
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(_next(name)):
        spark.sql(f"ALTER TABLE {_next(name)} RENAME TO {name}")


def merged_buckets(target, source, keys, buckets, dealt=False, **options):
    """``merge_upsert`` whose source meets the target in the target's buckets; only the source is shuffled.

    A source that comes from a table in the same buckets is ``dealt`` already, and nothing is shuffled.
    """
    typed = source.select(*[
        F.col(f.name).cast(target.schema[f.name].dataType).alias(f.name) if f.name in target.columns else F.col(f.name)
        for f in source.schema
    ])
    return merge_upsert(target, typed if dealt else typed.repartition(buckets, *keys), keys, **options)


def upsert_bucketed(spark, source, name, keys, buckets=BUCKETS, dealt=False, **options):
    """Upserts ``source`` into the table ``name`` and returns the table.

    The first write makes the table; ``buckets`` stays as it was then. The result is stored beside the old
    table and takes its name afterwards, so readers of a failed run keep the old rows, and the next
    run goes on from whichever is whole. ``dealt`` is as in :func:`merged_buckets`, ``options`` and NULL keys are
    as in :func:`merge_upsert`. One writer at a time.
    """
    _mend(spark, name)
    if spark.catalog.tableExists(name):
        merged = merged_buckets(spark.table(name), source, keys, buckets, dealt, **options)
    else:
        first = source if dealt else source.repartition(buckets, *keys)
        merged = merge_upsert(spark.createDataFrame([], source.schema), first, keys)
    _store(merged, _next(name), keys, buckets)
    _swap(spark, name)
    return spark.table(name)
