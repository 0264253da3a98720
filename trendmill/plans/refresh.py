"""From landed feeds to bronze, silver and gold tables, incrementally and safe to repeat.

Silver is a change log (see ``operators.versions``), gold tables are parquet tables replaced by day.
Every step may be run again after a failure: it finishes or redoes what it began.
"""

import datetime as dt
from functools import reduce

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from trendmill import constants as c
from trendmill import schemas
from trendmill.functions.scalars import ntz
from trendmill.operators import enrichment, layout, quality, rejects, versions
from trendmill.plans import gold, silver
from trendmill.session import (
    delete_path,
    drops_written,
    partition_values,
    passing_path,
    read_if_written,
    written,
)
from trendmill.sources.landing import (
    append_bronze,
    bronze_schema,
    high_water_mark,
    read_bronze,
    read_mark,
)

REQUIRED = ["signal_id", "title", "url", "created_at"]
BRONZE = {
    c.STORIES: schemas.STORIES_RAW,
    c.REPOS: schemas.REPOS_RAW,
    c.PAPERS: schemas.PAPERS_RAW,
    c.QUESTIONS: schemas.QUESTIONS_RAW,
}
# --- fixed values -----------------------------------------------------------------------------
# Checked at ingestion: key columns, required columns, and the columns whose highest values mark how
# far a feed has been read (id, timestamp).
CHECKS = {
    c.STORIES: (["id"], ["id", "title", "score", "time"], "id", None),
    c.REPOS: (
        ["full_name"], ["id", "full_name", "html_url", "stargazers_count"], None, "pushed_at",
    ),
    c.PAPERS: (["arxiv_id"], ["arxiv_id", "title", "summary", "published"], None, "published"),
    c.QUESTIONS: (
        ["question_id"], ["question_id", "title", "score", "creation_date"], None, "creation_date",
    ),
}
# Columns the gold tables are mostly filtered by.
CLUSTER_BY = {
    "tech_term_frequency": ["term", "source"],
    "trending_signals": ["source", "composite_score"],
    "source_summary": ["source"],
    "tech_velocity": ["term"],
}
# ----------------------------------------------------------------------------------------------
MARKS = StructType(
    [StructField("source", StringType()), StructField("last_timestamp", StringType())]
)


BATCHES = StructType([StructField("source", StringType()), StructField("batch", StringType())])


def ingest(spark, source, rows, bronze_path, log_path, checkpoints_path, batch, now):
    """Appends one batch of bronze rows, checks it and marks how far its feed has been read.

    The checks run on the batch as written, which is cheaper than parsing the feed again. Returns
    the number of rows. The marks are a change log keyed by source (``read_checkpoint``).
    """
    keys, required, id_column, time_column = CHECKS[source]
    count = append_bronze(rows, bronze_path, source, batch, ntz(now))
    table = read_bronze(spark, bronze_path, bronze_schema(BRONZE[source]))
    mine = table.where(F.col("_batch_id") == batch)
    metrics = quality.table_metrics(mine, source, key_columns=keys, required_columns=required)
    quality.append_log(quality.log_rows(quality.with_gate(metrics), batch, str(now)), log_path)
    if count:
        nothing = F.lit(None).cast("string")
        with_marks = mine.withColumns(
            {
                "_mark_id": F.col(id_column) if id_column else nothing,
                "_mark_time": F.col(time_column) if time_column else nothing,
            }
        )
        marks = high_water_mark(with_marks, "_mark_id", "_mark_time", now)
        version = versions.last_version(spark, checkpoints_path, schemas.CHECKPOINTS) + 1
        versions.write_commit(marks, checkpoints_path, version, now, "MERGE")
    return count


def read_checkpoint(spark, checkpoints_path, source):
    """The newest mark of a source as a dict, empty when it has none."""
    log = read_if_written(
        lambda p: versions.read_log(spark, p, schemas.CHECKPOINTS), checkpoints_path
    )
    return {} if log is None else read_mark(versions.as_of(log, ["source"]), source)


def read_marks(spark, path):
    """(mark per source, last version) of a marks log; the log holds one row per source and run."""
    log = read_if_written(lambda p: versions.read_log(spark, p, MARKS), path)
    if log is None:
        return {}, 0
    rows = log.groupBy("source").agg(
        F.max_by("last_timestamp", "_version").alias("mark"), F.max("_version").alias("version")
    )
    found = rows.collect()
    return {r["source"]: r["mark"] for r in found}, max(r["version"] for r in found)


@drops_written
def refresh_silver(spark, bronze_paths, silver_path, marks_path, log_path, now, reprocess=False):
    """Merges bronze batches not read before into silver; returns rows per source.

    Batches are told by their id, which is the partition they lie in: only new ones are opened, and one
    that lands late is read whatever its ingestion time. Batches landing during the run are left for
    the next one. Signals without a key are kept beside silver, in ``<silver_path>-rejects``, with the reason
    and the run. Silver, its quality log and the batch ids are written before the marks, whose
    version makes them count. A run that fails between them is repeated under the same version and
    replaces what it wrote.
    """
    _, last = read_marks(spark, marks_path)
    version = last + 1
    landed = {
        source: read_if_written(
            lambda p, schema=BRONZE[source]: read_bronze(spark, p, bronze_schema(schema)), path
        )
        for source, path in bronze_paths.items()
        if source in silver.TRANSFORMS
    }
    batches_path = f"{marks_path.rstrip('/')}-batches"
    unread = {
        source: unread_batches(spark, bronze_paths[source], batches_path, source, 0 if reprocess else last)
        for source, rows in landed.items()
        if rows is not None
    }
    bronze = {
        source: landed[source].where(F.col("_batch_id").isin(ids))
        for source, ids in unread.items()
        if ids
    }
    if not bronze:
        return {}
    newest = reduce(
        lambda a, b: a.unionByName(b),
        [
            rows.agg(F.max("_ingested_at").cast("string").alias("last_timestamp")).select(
                F.lit(source).alias("source"), "last_timestamp"
            )
            for source, rows in bronze.items()
        ],
    )
    found = {r["source"]: r["last_timestamp"] for r in newest.collect() if r["last_timestamp"]}
    if not found:
        return {}
    ready = {source: bronze[source] for source in found}
    complete, rejected, counts = rejects.split(
        silver.unify(ready), rejects.null_rules(["signal_id"]), passing_path(spark, "silver-judged")
    )
    signals = complete.unionByName(rejected.drop(rejects.REASONS))
    versions.write_commit(complete, silver_path, version, now, "MERGE")
    if counts["rejected"]:
        rejects.keep_rejects(rejected, f"{silver_path.rstrip('/')}-rejects", version)
    metrics = written(
        quality.with_gate(
            quality.quality_metrics(signals, ["signal_id"], REQUIRED, "created_at", now)
        ),
        "silver-quality",
    )
    batch = F.concat(F.lit("silver_"), F.col("source"), F.lit(f"_v{version}"))
    checks = quality.log_rows(metrics, batch, str(now))
    versions.write_commit(checks, log_path, version, now, "APPEND")
    read = [(source, batch) for source in bronze for batch in unread[source]]
    versions.write_commit(
        spark.createDataFrame(read, BATCHES), batches_path, version, now, "APPEND"
    )
    versions.write_commit(
        spark.createDataFrame(sorted(found.items()), MARKS),
        marks_path, version, now, "MERGE",
    )
    return {r["source"]: r["total_rows"] for r in metrics.collect()}


def unread_batches(spark, bronze_path, path, source, version):
    """Batch ids of a bronze table that no run up to ``version`` has read.

    The batches there are come from the names of the table's folders; no file is opened.
    """
    ids = set(partition_values(spark, bronze_path, "_batch_id"))
    log = read_if_written(lambda p: versions.read_log(spark, p, BATCHES), path)
    if log is not None:
        done = log.where((F.col("source") == source) & (F.col("_version") <= version))
        ids -= {r["batch"] for r in done.select("batch").distinct().collect()}
    return sorted(ids)


def current_signals(spark, silver_path, within=None):
    """Signals as of the last commit, optionally only those meeting a condition."""
    log = versions.read_log(spark, silver_path, schemas.SIGNALS)
    return versions.as_of(log, ["signal_id"], within=within)


def replace_days(rows, path, day="date", cluster_by=(), span=()):
    """Replaces the days that occur in ``rows``, and all of ``span``, and leaves other days alone.

    A day of ``span`` (an iterable of dates) that has no rows any more is removed.

    Rows that dropped out of a day's ranking go with the old day instead of staying behind.
    Rebalancing gathers small days into few files and still splits a day too large for one task;
    sorting by ``cluster_by`` lets scans skip most of a file.
    """
    seen = Observation()
    (
        rows.observe(seen, F.collect_set(day).alias("days"))
        .hint("rebalance", day)
        .sortWithinPartitions(day, *cluster_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )
    for emptied in set(span) - set(seen.get["days"]):
        delete_path(rows.sparkSession, f"{path}/{day}={emptied.isoformat()}")


@drops_written
def refresh_gold(spark, silver_path, gold_path, first, last, as_of):
    """Rebuilds the gold tables for a closed range of days from one snapshot of silver."""
    names = ["signal_id", "source", "title", "body", "url", "author", "score", "created_at", "tags"]
    current = current_signals(spark, silver_path, gold.weeks_around(first, last)).select(*names)
    weeks = written(gold.in_weeks(current, first, last), "gold-signals")
    days = gold.in_range(weeks.drop("date"), first, last)
    monday = F.date_trunc("week", F.lit(str(first)).cast("date")).cast("date")
    tables = {
        "tech_term_frequency": gold.term_frequency(days),
        "trending_signals": gold.trending_signals(days, as_of),
        "source_summary": gold.source_summary(days),
        "tech_velocity": gold.tech_velocity(weeks).where(F.col("week_start") >= monday),
    }
    start, end = (dt.date.fromisoformat(str(d)[:10]) for d in (first, last))
    week = start - dt.timedelta(days=start.weekday())
    dates = [week + dt.timedelta(days=i) for i in range((end - week).days + 1)]
    for name, rows in tables.items():
        day = "week_start" if name == "tech_velocity" else "date"
        span = [d for d in dates if d.weekday() == 0] if name == "tech_velocity" else [
            d for d in dates if d >= start
        ]
        replace_days(rows, f"{gold_path}/{name}", day, CLUSTER_BY[name], span)
    return {name: _stored(spark, f"{gold_path}/{name}", rows) for name, rows in tables.items()}


def _stored(spark, path, rows):
    """A gold table as stored, with its day last; its schema is given, as it may have no rows."""
    day = "week_start" if "week_start" in rows.columns else "date"
    fields = [f for f in rows.schema.fields if f.name != day]
    return spark.read.schema(StructType([*fields, rows.schema[day]])).parquet(path)


def refresh_enriched(
    spark, silver_path, log_path, table_path, scorer, model, clock, batches, retry_errors=False
):
    """Enriches the signals still missing, batch by batch, and lays the table out anew.

    Every batch is committed to the change log at ``log_path``, so a run that breaks off is gone on with
    by the next one. The table at ``table_path`` is clustered by category and sentiment.
    """
    log = read_if_written(lambda p: versions.read_log(spark, p, schemas.ENRICHED), log_path)
    done = None if log is None else versions.as_of(log, ["signal_id"])
    signals = current_signals(spark, silver_path)
    keys = enrichment.candidate_keys(signals, done, retry_errors=retry_errors)
    enrichment.commit_in_batches(spark, keys, log_path, scorer, model, clock, batches, signals)
    current = versions.as_of(
        versions.read_log(spark, log_path, schemas.ENRICHED), ["signal_id"]
    )
    return layout.write_clustered(current, table_path, ["category", "sentiment", "signal_id"])
