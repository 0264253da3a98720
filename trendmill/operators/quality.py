"""Data quality of a table, measured in one aggregation for all groups."""

from pyspark.sql import functions as F

from trendmill import constants as c
from trendmill.functions.scalars import age_hours, as_column, iso_to_timestamp, ntz
from trendmill.schemas import QUALITY_LOG


def quality_metrics(
    df,
    key_columns,
    required_columns,
    timestamp_column=None,
    as_of=None,
    group=("source",),
    max_age_hours=c.MAX_AGE_HOURS,
):
    """Rows, NULLs per required column, repeated keys and freshness per group.

    Repeated rows are all rows minus distinct keys, where a NULL key counts as a key. Required
    columns the table lacks are ignored. Without a timestamp column the group counts as fresh; a
    column that is missing, all NULL or text that is no ISO time does not. Spark reduces the distinct keys on the map side, so
    one large group is no problem.
    """
    present = [name for name in required_columns if name in df.columns]
    timed = timestamp_column in df.columns
    newest = F.max(timestamp_column) if timed else F.lit(None).cast("timestamp_ntz")
    counted = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct(F.struct(*key_columns)).alias("_keys"),
        newest.alias("newest"),
        *[F.count_if(F.col(name).isNull()).alias(f"_null_{name}") for name in present],
    )
    pairs = [part for name in present for part in (F.lit(name), F.col(f"_null_{name}"))]
    nulls = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,bigint>")
    if timestamp_column is None:
        hours, fresh = F.lit(None).cast("double"), F.lit(True)
    elif timed:
        is_text = dict(df.dtypes)[timestamp_column] == "string"
        age = age_hours(iso_to_timestamp("newest") if is_text else ntz(F.col("newest")), as_of)
        hours, fresh = F.round(age, 2), F.coalesce(age <= max_age_hours, F.lit(False))
    else:
        hours, fresh = F.lit(None).cast("double"), F.lit(False)
    return counted.select(
        *group,
        "total_rows",
        nulls.alias("null_counts"),
        (F.col("total_rows") - F.col("_keys")).alias("duplicate_count"),
        "newest",
        hours.alias("freshness_hours"),
        fresh.alias("is_fresh"),
    )


def table_metrics(df, source, **checks):
    """Metrics of a whole table; an empty table gives one row with zero rows."""
    metrics = quality_metrics(df, group=(), **checks)
    return metrics.select(F.lit(source).alias("source"), *metrics.columns)


def null_counts_long(metrics, *group):
    """One row per group and required column."""
    return metrics.select(*group, F.explode("null_counts").alias("column_name", "null_count"))


def gate_breaches(max_null_share=c.MAX_NULL_SHARE, max_duplicate_share=c.MAX_DUPLICATE_SHARE):
    """Array naming every threshold a metrics row breaks."""
    total = F.col("total_rows")
    broken_nulls = F.transform(
        F.filter(
            F.map_entries("null_counts"),
            lambda e: F.try_divide(e["value"], total) > max_null_share,
        ),
        lambda e: F.concat(F.lit("nulls:"), e["key"]),
    )

    def flag(condition, name):
        return F.when(condition, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))

    checks = F.concat(
        broken_nulls,
        flag(F.try_divide("duplicate_count", total) > max_duplicate_share, "duplicates"),
        flag(~F.col("is_fresh"), "stale"),
    )
    return F.when(total == 0, F.array(F.lit("empty"))).otherwise(checks)


def with_gate(metrics, **limits):
    """Adds the soft gate: it reports and never stops a run."""
    return metrics.withColumn("breaches", gate_breaches(**limits)).withColumn(
        "quality_passed", F.size("breaches") == 0
    )


def log_rows(gated, batch_id, checked_at):
    """Quality-log rows; the id is derived from the check so that a replay gives the same row."""
    batch = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    stamp = as_column(checked_at) if not isinstance(checked_at, str) else ntz(checked_at)
    key = F.concat_ws("|", "source", batch, stamp.cast("string"))
    return gated.select(
        F.md5(key).alias("log_id"),
        "source",
        batch.alias("batch_id"),
        "total_rows",
        F.to_json("null_counts").alias("null_counts"),
        "duplicate_count",
        "freshness_hours",
        "is_fresh",
        "quality_passed",
        stamp.alias("checked_at"),
    )


def append_log(rows, path):
    """Adds checks to the log; the checks of a batch written again replace the earlier ones."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def read_log(spark, path):
    return spark.read.schema(QUALITY_LOG).parquet(path).select(*QUALITY_LOG.fieldNames())
