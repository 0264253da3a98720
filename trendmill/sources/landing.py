"""Incremental pulls, bronze append, batch ids and high-water marks."""

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from trendmill.functions.scalars import as_column, ntz, utc_now
from trendmill.operators.dedup import keep_one
from trendmill.session import delete_partition


def first_occurrence(df, key, query_no, position):
    """Overlapping search results: the first hit of each key stays, empty keys are dropped."""
    present = df.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return keep_one(present, [key], [F.col(query_no).asc(), F.col(position).asc()])


def newer_ids(df, id_column, last_id, batch_size=None):
    """Rows past a numeric mark, all of them unless ``batch_size`` limits a pull.

    The lowest new ids come first then: with the highest id of the batch as the next mark, no id
    between two batches is skipped.
    """
    rows = df if last_id is None else df.where(F.col(id_column) > F.lit(int(last_id)))
    return rows if batch_size is None else rows.orderBy(id_column).limit(batch_size)


def newer_text(df, column, last_value):
    """Rows whose ISO text sorts after the mark; without a mark, all rows."""
    if not last_value:
        return df
    return df.where(F.coalesce(F.col(column), F.lit("")) > F.lit(last_value))


def newer_epoch(df, column, last_value):
    """Rows past an integer mark kept as text; a mark that is not a number takes all rows."""
    mark = F.lit(last_value).cast("string").try_cast("bigint")
    return df.where(mark.isNull() | (F.coalesce(F.col(column), F.lit(0)) > mark))


def newer_ingested(df, last_timestamp, column="_ingested_at", reprocess=False):
    """Bronze rows ingested after the mark; everything when reprocessing or without a mark."""
    if reprocess or last_timestamp is None:
        return df
    return df.where(F.col(column) > ntz(last_timestamp))


def batch_id(source, at, token):
    """``{source}_{yyyyMMdd_HHmmss}_{8 hex}`` with the suffix taken from the token.

    The same source and token, such as a micro-batch number, always give the same id, so a replayed
    batch is recognised.
    """
    source, token = as_column(source), as_column(token)
    suffix = F.substring(F.md5(F.concat_ws("|", source, token.cast("string"))), 1, 8)
    return F.concat_ws("_", source, F.date_format(as_column(at), "yyyyMMdd_HHmmss"), suffix)


def with_ingestion_columns(df, source, batch, ingested_at=None):
    """Adds ``_ingested_at``, ``_source`` and ``_batch_id``."""
    stamp = utc_now() if ingested_at is None else as_column(ingested_at)
    return df.withColumns(
        {
            "_ingested_at": stamp.cast("timestamp_ntz"),
            "_source": F.lit(source) if isinstance(source, str) else source,
            "_batch_id": F.lit(batch) if isinstance(batch, str) else batch,
        }
    )


def append_bronze(df, path, source, batch, ingested_at=None):
    """Adds one batch and returns its row count, counted during the write itself.

    Batches already there stay as they are. A batch written again after a failure replaces its first
    attempt instead of doubling it, also when it has no rows any more.
    """
    seen = Observation(f"append-{batch}")
    rows = with_ingestion_columns(df, source, batch, ingested_at)
    (
        rows.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_batch_id")
        .parquet(path)
    )
    count = seen.get["rows"]
    if not count:
        delete_partition(df.sparkSession, path, "_batch_id", batch)
    return count


def bronze_schema(schema):
    """A feed's bronze schema with the ingestion columns."""
    return StructType(
        [
            *schema.fields,
            StructField("_ingested_at", TimestampNTZType()),
            StructField("_source", StringType()),
            StructField("_batch_id", StringType()),
        ]
    )


def read_bronze(spark, path, schema=None):
    """All batches; columns that only some of them have are NULL in the others.

    Without a schema the columns of all files are merged, for which Spark opens every file. A table
    of many files is better read with the columns that are wanted.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def batch_sample(df, batch, key, rows=5):
    return df.where(F.col("_batch_id") == batch).orderBy(key).limit(rows)


def high_water_mark(df, id_column, timestamp_column, updated_at=None):
    """Per source: highest id, newest timestamp and the batch that brought the newest row."""
    stamp = ntz(updated_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    return df.groupBy(F.col("_source").alias("source")).agg(
        F.max(id_column).cast("string").alias("last_id"),
        F.max(timestamp_column).cast("string").alias("last_timestamp"),
        F.max_by("_batch_id", F.struct("_ingested_at", "_batch_id")).alias("last_batch_id"),
        stamp.alias("updated_at"),
    )


def read_mark(marks, source):
    """The mark of one source as a dict, empty when there is none."""
    row = marks.where(F.col("source") == source).first()
    return row.asDict() if row else {}
