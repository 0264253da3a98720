"""Versioned tables as an append-only change log.

A commit adds the changed rows with their version; the table as of any version is the latest row per
key up to it. A commit therefore costs the size of the change, not of the table.
"""

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from trendmill.functions.scalars import ntz
from trendmill.operators.dedup import keep_one
from trendmill.session import delete_path, read_if_written

LOG_COLUMNS = ["_version", "_committed_at", "_operation"]


def as_commit(rows, version, committed_at, operation):
    return rows.withColumns(
        {
            "_version": F.lit(version).cast("bigint"),
            "_committed_at": ntz(committed_at),
            "_operation": F.lit(operation),
        }
    )


def write_commit(rows, path, version, committed_at, operation):
    """Writes one version; writing the same version again replaces it, so replays are harmless.

    A version without rows leaves nothing of an earlier attempt behind.
    """
    seen = Observation()
    (
        as_commit(rows, version, committed_at, operation)
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_version")
        .parquet(path)
    )
    if not seen.get["rows"]:
        delete_path(rows.sparkSession, f"{path}/_version={version}")


def log_schema(schema):
    """A table's schema with the columns of its change log."""
    return StructType(
        [
            *schema.fields,
            StructField("_committed_at", TimestampNTZType()),
            StructField("_operation", StringType()),
            StructField("_version", LongType()),
        ]
    )


def read_log(spark, path, schema=None):
    """The change log at ``path``; with the table's ``schema`` no file is opened to learn it."""
    if schema is not None:
        return spark.read.schema(log_schema(schema)).parquet(path)
    log = spark.read.option("mergeSchema", "true").parquet(path)
    return log.withColumn("_version", F.col("_version").cast("bigint"))


def last_version(spark, path, schema=None):
    """Number of the last commit, 0 before the first one."""
    log = read_if_written(lambda p: read_log(spark, p, schema), path)
    return 0 if log is None else log.agg(F.max("_version")).first()[0] or 0


def as_of(log, keys, version=None, timestamp=None, within=None):
    """Table content at a version or a time; by default the current one.

    A time before the first commit gives an empty table. ``within`` keeps the rows that meet a
    condition: only keys with some version meeting it are brought together, the others cannot
    matter.
    """
    if version is not None:
        log = log.where(F.col("_version") <= version)
    if timestamp is not None:
        log = log.where(F.col("_committed_at") <= ntz(timestamp))
    if within is not None:
        log = log.join(log.where(within).select(*keys).distinct(), keys, "left_semi")
    rows = keep_one(log, keys, [F.col("_version").desc()]).drop(*LOG_COLUMNS)
    return rows if within is None else rows.where(within)


def history(log, keys=None, newest=None):
    """One row per version, newest first, with the number of rows it wrote.

    With ``keys`` the rows are also split into inserted and updated ones, which has to look at every
    key of the log.
    """
    commits = log.groupBy(F.col("_version").alias("version")).agg(
        F.max("_committed_at").alias("timestamp"),
        F.max("_operation").alias("operation"),
        F.count(F.lit(1)).alias("num_rows"),
    )
    if keys:
        first_seen = (
            log.groupBy(*keys)
            .agg(F.min("_version").alias("version"))
            .groupBy("version")
            .agg(F.count(F.lit(1)).alias("num_inserted"))
        )
        commits = (
            commits.join(first_seen, "version", "left")
            .fillna(0, ["num_inserted"])
            .withColumn("num_updated", F.col("num_rows") - F.col("num_inserted"))
        )
    commits = commits.orderBy(F.col("version").desc())
    return commits if newest is None else commits.limit(newest)


def earliest_version(log):
    return log.agg(F.min("_version").alias("version"))


def compact(log, keys, path, version, committed_at):
    """Starts a fresh log at ``path`` whose single commit is the current content."""
    write_commit(as_of(log, keys), path, version, committed_at, "COMPACT")
