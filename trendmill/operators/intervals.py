"""Sets of ids as ranges: which have been pulled, and which were skipped.

Ranges are laid out in order over all tasks. How far earlier tasks reach, and how many islands start in
them, comes from one row a task; nothing else is gathered in one place.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from trendmill.session import written

_ROW_BITS = 33


def id_ranges(df, id_column):
    """Every id as a range of its own; NULL ids are none."""
    number = F.col(id_column).cast("long")
    return df.where(number.isNotNull()).select(number.alias("low"), number.alias("high"))


def islands(ranges):
    """``island`` (1, 2, ... in ascending order), ``low`` and ``high`` of the merged ranges.

    Ranges that overlap or adjoin make one island. Rows with a NULL bound or a low above its high are
    none. Earlier islands may be given along with new ids, so a set grows by what is new.
    """
    # Equal lows are joined before the shuffle, however often an id was seen.
    distinct = ranges.where("low <= high").groupBy("low").agg(F.max("high").alias("high"))
    laid_out = written(
        distinct.repartitionByRange("low").sortWithinPartitions("low")
        .withColumn("_part", F.shiftright(F.monotonically_increasing_id(), _ROW_BITS)),
        "ranges",
    )
    # One row for each task from here to the join.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    reached = laid_out.groupBy("_part").agg(F.max("high").alias("_most")).select(
        "_part", F.max("_most").over(earlier).alias("_reached")
    )
    before = Window.partitionBy("_part").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.greatest("_reached", F.max("high").over(before))
    begins = F.when(reach.isNull() | (F.col("low") - 1 > reach), 1).otherwise(0)
    marked = laid_out.join(reached, "_part").select("_part", "low", "high", begins.alias("_begins"))
    started = marked.groupBy("_part").agg(F.sum("_begins").alias("_sum")).select(
        "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_started")
    )
    upto = Window.partitionBy("_part").orderBy("low").rowsBetween(Window.unboundedPreceding, 0)
    number = (F.sum("_begins").over(upto) + F.col("_started")).alias("island")
    return (
        marked.join(started, "_part").select(number, "low", "high")
        .groupBy("island").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    )


def gaps(found):
    """``low`` and ``high`` of what lies between neighbouring islands."""
    then = found.select((F.col("island") - 1).alias("island"), F.col("low").alias("_next"))
    return found.join(then, "island").select(
        (F.col("high") + 1).alias("low"), (F.col("_next") - 1).alias("high")
    )
