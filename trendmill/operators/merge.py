"""Upsert of one DataFrame into another."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from trendmill.operators.dedup import split_null_keys
from trendmill.session import delete_partition, drops_written, read_if_written, written


def unique_rows(source, keys):
    """One struct per key; fails when a key occurs twice, as such a merge has no defined result."""
    rest = [c for c in source.columns if c not in keys]
    row = F.struct(*rest) if rest else F.struct(F.lit(True).alias("_none"))
    grouped = source.groupBy(*keys).agg(
        F.first(row).alias("_row"), F.count(F.lit(1)).alias("_copies")
    )
    repeated = F.concat(F.lit("merge source repeats key "), F.to_json(F.struct(*keys)))
    hit = F.when(F.col("_copies") == 1, F.lit(True)).otherwise(
        F.raise_error(repeated).cast("boolean")
    )
    return grouped.select(*keys, "_row", hit.alias("_in_source"))


def merge_upsert(target, source, keys, update_columns=None, update_condition=None):
    """Rows of ``target`` after merging ``source`` on ``keys``.

    Matched rows take ``update_columns`` (all non-key columns by default) from the source, other
    source rows are inserted. ``update_condition(target_row, source_row)`` may hold back updates.
    Rows with a NULL key never match; those of the source are left out (see ``split_null_keys``).
    Both sides shuffle once on the keys, and keys are unique, so no key can be hot.
    """
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"columns not in the target: {unknown}")
    values = [c for c in target.columns if c not in keys]
    updates = set(values if update_columns is None else update_columns)
    complete, _ = split_null_keys(source, keys)
    incoming = unique_rows(complete, keys).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], "_row", "_in_source"
    )
    current = target.withColumn("_in_target", F.lit(True))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k_{k}") for k in keys])
    joined = current.join(incoming, same, "full_outer")

    fresh = F.col("_in_target").isNull()
    hit = F.coalesce("_in_source", F.lit(False))
    update = hit
    if update_condition is not None:
        allowed = update_condition(lambda c: F.col(c), lambda c: F.col(f"_row.{c}"))
        update = hit & F.coalesce(allowed, F.lit(False))

    def value(column):
        if column not in source.columns:
            return F.col(column)
        take = (hit & fresh) | update if column in updates else hit & fresh
        return F.when(take, F.col(f"_row.{column}")).otherwise(F.col(column)).alias(column)

    return joined.select(
        *[
            F.coalesce(F.col(c), F.col(f"_k_{c}")).alias(c) if c in keys else value(c)
            for c in target.columns
        ]
    )


def _one_per_key(rows, incoming, keys, partition_by):
    """``rows`` with at most one row of each incoming key, at best the one already where it belongs.

    A run that broke off before it removed emptied partitions leaves the old row beside the new one.
    """
    places = incoming.select(
        *[F.col(k).alias(f"_p_{k}") for k in keys], F.col(partition_by).alias("_place")
    ).withColumn("_met", F.lit(True))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_p_{k}") for k in keys])
    moved = F.col(partition_by).eqNullSafe(F.col("_place"))
    order = Window.partitionBy(*keys).orderBy(moved.desc(), F.col(partition_by))
    return (
        rows.join(places, same, "left").withColumn("_nth", F.row_number().over(order))
        .where(F.col("_met").isNull() | (F.col("_nth") == 1)).select(rows.columns)
    )


@drops_written
def upsert_table(spark, source, path, keys, partition_by, **options):
    """Upserts ``source`` into the parquet table at ``path`` and returns the number of its rows.

    The first write makes the table, an empty source changes nothing. Only partitions that a source
    row belongs to, or that hold the old row of its key, are read in full and written again; the old
    rows are found on keys alone. A run that broke off after writing partitions and before removing
    emptied ones is mended by running it again. ``options`` are those of :func:`merge_upsert`. Rows with
    a NULL key are left out and not counted. An empty text as partition counts as NULL, as both lie
    in one folder.
    """
    complete, _ = split_null_keys(source, keys)
    if dict(complete.dtypes)[partition_by] == "string":
        complete = complete.withColumn(partition_by, F.nullif(partition_by, F.lit("")))
    incoming = written(complete, "upsert-source")
    count = incoming.count()
    if not count:
        return 0
    target = read_if_written(lambda p: spark.read.schema(source.schema).parquet(p), path)
    if target is None:
        # Also checks that no key occurs twice.
        none = spark.createDataFrame([], source.schema)
        merged, touched = merge_upsert(none, incoming, keys, **options), []
    else:
        old = target.select(*keys, partition_by).join(incoming.select(*keys), keys, "left_semi")
        places = incoming.select(partition_by).unionAll(old.select(partition_by)).distinct()
        touched = [tuple(r) for r in places.select(partition_by, _as_text(partition_by)).collect()]
        part = F.col(partition_by)
        within = part.isin([t for t, _ in touched if t is not None])
        if any(t is None for t, _ in touched):
            within = within | part.isNull()
        rows = _one_per_key(target.where(F.coalesce(within, F.lit(False))), incoming, keys, partition_by)
        merged = merge_upsert(rows, incoming, keys, **options)
    merged = written(merged, "upsert-result")
    (
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by).parquet(path)
    )
    left = {r[0] for r in merged.select(_as_text(partition_by)).distinct().collect()}
    for emptied in {text for _, text in touched} - left:
        delete_partition(spark, path, partition_by, emptied)
    return count


def _as_text(column):
    """A partition's value as Spark writes it into the name of its folder, before escaping."""
    return F.col(column).cast("string").alias("_text")
