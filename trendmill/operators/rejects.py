"""Rows that break a rule, kept with their reasons instead of vanishing."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from trendmill.session import delete_partition, work_path

REASONS = "_reasons"


def null_rules(columns):
    """A rule ``null:<column>`` for each column that must have a value."""
    return {f"null:{name}": F.col(name).isNull() for name in columns}


def with_reasons(rows, rules):
    """``rows`` with the names of the rules each breaks, in the order of ``rules``.

    A rule is a condition that bad rows meet; one that is NULL isn't met.
    """
    broken = [F.when(bad, F.lit(name)) for name, bad in rules.items()]
    names = F.filter(F.array(*broken), lambda r: r.isNotNull()) if broken else F.array()
    return rows.withColumn(REASONS, names.cast("array<string>"))


def split(rows, rules, path=None):
    """(good rows, rejected rows with their reasons, counts), judged and written in one pass.

    Both lie below ``path`` (by default a folder of its own in the shared folder) in a folder each, so
    either is read without the other. ``counts`` has ``good``, ``rejected`` and the rows that break
    each rule, observed during the write.
    """
    spark = rows.sparkSession
    path = path or work_path(spark, "judged")
    judged = with_reasons(rows, rules)
    bad = F.size(REASONS) > 0
    seen = Observation()
    observed = judged.observe(
        seen, F.count_if(~bad).alias("good"), F.count_if(bad).alias("rejected"),
        *[F.count_if(F.array_contains(REASONS, name)).alias(name) for name in rules],
    )
    observed.withColumn("_rejected", bad).write.mode("overwrite").partitionBy("_rejected").parquet(path)
    both = spark.read.schema(judged.withColumn("_rejected", bad).schema).parquet(path)
    good = both.where("not _rejected").drop("_rejected", REASONS)
    return good, both.where("_rejected").drop("_rejected"), dict(seen.get)


def keep_rejects(rejected, path, batch):
    """Adds the rejected rows of one batch to the table at ``path``; a repeat replaces its first attempt."""
    delete_partition(rejected.sparkSession, path, "_batch", str(batch))
    rejected.withColumn("_batch", F.lit(str(batch))).write.mode("append").partitionBy("_batch").parquet(path)
