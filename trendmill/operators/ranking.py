"""Row numbers within groups, for groups of any size."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from trendmill.session import written

# monotonically_increasing_id keeps the partition number above this bit.
_ROW_BITS = 33


def top_k(df, group, order, k, rank, buckets=None):
    """Best ``k`` rows of each group with their rank; cut to k per task before the shuffle.

    With very many map tasks, k rows of each still are a lot for the one task that ranks a group.
    ``buckets`` adds a step between: the tasks are dealt into that many buckets, each is cut to k
    rows, and only those meet.
    """
    if buckets:
        bucket = F.pmod(F.spark_partition_id(), F.lit(buckets))
        window = Window.partitionBy(*group, "_bucket").orderBy(*order)
        df = (
            df.withColumn("_bucket", bucket)
            .withColumn("_in_bucket", F.row_number().over(window))
            .where(F.col("_in_bucket") <= k)
            .drop("_bucket", "_in_bucket")
        )
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def rank_all(df, group, order, rank):
    """``row_number`` over whole groups of any size; ``order`` must be total within a group.

    Rows are laid out in rank order over all tasks. A row's rank is its place in its own partition
    plus the rows of its group in the partitions before it. The layout is written because both uses
    of it must see the same partitions.
    """
    laid_out = written(
        df.repartitionByRange(*group, *order)
        .sortWithinPartitions(*group, *order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", _ROW_BITS)),
        "rank-layout",
    )
    runs = laid_out.groupBy(*group, "_part").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # One row per group and partition it touches; groups are contiguous in the layout.
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.select(
        *[F.col(c).alias(f"_g_{c}") for c in group],
        F.col("_part").alias("_g_part"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    same = F.col("_part") == F.col("_g_part")
    for name in group:
        same = same & F.col(name).eqNullSafe(F.col(f"_g_{name}"))
    return laid_out.join(shifts, same).select(
        *df.columns, (F.col("_place") + F.col("_shift") + 1).alias(rank)
    )
