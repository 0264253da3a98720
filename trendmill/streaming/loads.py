"""Incremental loads with Structured Streaming.

Progress lives in the checkpoint of each stream, so every landed file is read once. All loads run
with ``availableNow``: they take what has landed since the last run and stop.
"""

import datetime as dt
import json
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Observation
from pyspark.sql import functions as F

from trendmill.operators.bucketed import append_bucketed, upsert_bucketed
from trendmill.operators.dedup import keep_one, split_null_keys
from trendmill.operators.versions import LOG_COLUMNS, as_of, write_commit
from trendmill.plans import silver
from trendmill.schemas import PAPER_ENTRY
from trendmill.session import drop_shuffles, release_shuffles
from trendmill.sources.feeds import READERS, paper_entries
from trendmill.sources.landing import batch_id, with_ingestion_columns


def landed_parquet(spark, path, schema=None, files_per_batch=None, bytes_per_batch=None, keep=True):
    """Stream over landed parquet files.

    Without ``keep`` a file is deleted once its micro-batch has been committed and the next one begins.
    """
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    if not keep:
        reader = reader.option("cleanSource", "delete")
    return reader.parquet(path)


def landed_feed(spark, kind, path, files_per_batch=None):
    """Stream of bronze rows from landed JSON lines, or Atom XML for papers, parsed as in a batch read."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if kind == "papers":
        entries = reader.schema(PAPER_ENTRY).option("rowTag", "entry").format("xml").load(path)
        return paper_entries(entries)
    return READERS[kind](reader.text(path))


def _run(writer, checkpoint):
    query = (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def append_new(stream, path, checkpoint):
    """Appends new rows to parquet, each exactly once."""
    return _run(stream.writeStream.outputMode("append").format("parquet").option("path", path),
                checkpoint)


def append_bronze_new(stream, path, checkpoint, source):
    """Appends new feed rows with ingestion columns.

    ``foreachBatch`` may repeat a micro-batch after a failure. Its batch id depends only on source
    and batch number and is the partition written, so a repeat replaces the first attempt.
    """

    def write(rows, number):
        epoch = F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz")
        (
            with_ingestion_columns(rows, source, batch_id(F.lit(source), epoch, F.lit(number)))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("_batch_id")
            .parquet(path)
        )

    return _run(stream.writeStream.foreachBatch(write), checkpoint)


def utc_now():
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def upsert_new(stream, log_path, checkpoint, keys, order, prepare=None, clock=utc_now):
    """Upserts new rows: one change-log version per micro-batch, best row per key.

    ``prepare`` turns the rows of a batch into the rows to upsert, such as bronze rows into signals.
    The version is the batch number and is overwritten when a batch is repeated.
    """

    def write(rows, number):
        complete, _ = split_null_keys(prepare(rows) if prepare else rows, keys)
        write_commit(keep_one(complete, keys, order), log_path, number, clock(), "MERGE")

    return _run(stream.writeStream.foreachBatch(write), checkpoint)


def current_rows(log, keys, order=None):
    """Current content of an upserted log.

    By default the newest version of a key wins. With ``order`` the best row of all versions wins,
    which keeps "highest score" true across batches as well as within one.
    """
    if order is None:
        return as_of(log, keys)
    return keep_one(log, keys, [*order, F.col("_version").desc()]).drop(*LOG_COLUMNS)


def drop_repeats(stream, keys, event_time, horizon):
    """Suppresses repeats across batches.

    State is kept for ``horizon`` of event time. It has to cover the longest delay between a row and
    its repeat: later rows are dropped and later repeats are not recognised.
    """
    return stream.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(keys)


def upsert_new_bucketed(stream, name, checkpoint, keys, order, prepare=None, buckets=16, better=None):
    """Upserts new rows into the bucketed table ``name``: best row per key of each micro-batch.

    ``better(old, new)`` may hold back updates, such as of a lower score; a repeated micro-batch then
    changes nothing, as it does without. The table always has one row a key, so reading it ranks
    nothing. Other sessions that have read the table before need ``refreshTable``.
    """

    def write(rows, number):
        complete, _ = split_null_keys(prepare(rows) if prepare else rows, keys)
        upsert_bucketed(
            rows.sparkSession, keep_one(complete, keys, order), name, keys, buckets, update_condition=better
        )

    query = _run(stream.writeStream.foreachBatch(write), checkpoint)
    # Batches are written by a session of their own; this one may remember the files of the table before.
    if stream.sparkSession.catalog.tableExists(name):
        stream.sparkSession.catalog.refreshTable(name)
    return query


def append_checked(stream, path, checkpoint, log_path, source, required, clock=utc_now):
    """Appends new rows and logs each micro-batch's rows and NULLs, measured while it is written.

    Rows and log entries lie in a partition a batch number, so a repeated batch replaces both.
    """

    def write(rows, number):
        seen = Observation()
        nulls = [F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in required]
        (
            rows.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls)
            .withColumn("_batch", F.lit(number)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(path)
        )
        found = seen.get
        entry = rows.sparkSession.createDataFrame(
            [(source, found["rows"], json.dumps({n: found[f"null_{n}"] for n in required}), clock(), number)],
            "source string, total_rows long, null_counts string, checked_at timestamp_ntz, _batch long",
        )
        entry.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(log_path)

    return _run(stream.writeStream.foreachBatch(write), checkpoint)


@contextmanager
def _setting(spark, key, value):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: How the watermarks of several feeds make one: the slowest feed's holds, so no feed's rows are late by another's.
WATERMARK_POLICY = "min"
_POLICY_SETTING = "spark.sql.streaming.multipleWatermarkPolicy"


def one_stream(bronze_by_source, processed_at=None, horizon="1 day"):
    """One stream of signals from a stream of bronze rows for each feed; unknown sources are skipped.

    Every feed has a watermark on its time of ingestion, ``horizon`` behind; within it a row that lands
    twice is suppressed. A later repeat passes and is harmless to :func:`upsert_signals`. A row that was
    ingested more than ``horizon`` before the newest one of the slowest feed so far is too late and left out, so
    ``horizon`` has to cover the longest delay between ingestion and landing.
    """
    streams = []
    for source, bronze in bronze_by_source.items():
        if source in silver.TRANSFORMS:
            rows = silver.fetched_signals(source, bronze, processed_at)
            at = F.col("_fetched_at").cast("timestamp").alias("_event_time")
            streams.append(rows.select("*", at).withWatermark("_event_time", horizon))
    united = reduce(lambda a, b: a.unionByName(b), streams)
    same = ["signal_id", "_fetched_at", "title", "body", "url", "author", "score", "created_at", "tags", "language", "_ties"]
    # The state holds 128 bits of a row's digest instead of its texts. JSON would cut times to milliseconds, and
    # is slow on long texts.
    exact = [
        F.col(n).cast("string").alias(n) if n in ("_fetched_at", "created_at")
        else F.sha2(F.col(n), 256).alias(n) if n in ("title", "body") else F.col(n)
        for n in same
    ]
    digest = F.substring(F.unhex(F.sha2(F.to_json(F.struct(*exact)), 256)), 1, 16)
    return united.withColumn("_same", digest).dropDuplicatesWithinWatermark(["_same"]).drop("_same", "_event_time")


def upsert_signals(signals, name, checkpoint, buckets=16, taken=None):
    """Keeps the preferred row of each signal of :func:`one_stream` in the bucketed table ``name``.

    The slowest feed's watermark holds for all (:data:`WATERMARK_POLICY`), so a feed may lag behind the others
    by any time; one that never delivers keeps the state from shrinking. A stored row only gives way to a preferred one, so
    a repeated micro-batch changes nothing, and neither does the order in which feeds land.

    Micro-batches gather in a table beside ``name`` in the same buckets, which is merged once a run, without a shuffle.
    So the disk that a run's shuffles take is that of a micro-batch, and small ones don't rewrite the table more
    often. What a run that broke off has gathered is merged by the next. ``taken()`` is called before the merge, when
    nothing that has landed is needed any more.
    """
    spark, keys, gathered = signals.sparkSession, ["signal_id"], f"{name}__gathered"
    by_score, fetched, ties = silver.PREFERENCE
    last = silver.LAST_TIES
    order = [F.col(by_score).desc(), F.col(fetched).desc(), *[F.col(n).asc() for n in (ties, *last)]]

    def better(old, new):
        as_good = new(by_score) == old(by_score)
        as_new = as_good & (new(fetched) == old(fetched))
        # Arrays compare NULLs as the order above does.
        smaller = F.concat(new(ties), F.array(*map(new, last))) < F.concat(old(ties), F.array(*map(old, last)))
        return (new(by_score) > old(by_score)) | (as_good & (new(fetched) > old(fetched))) | (as_new & smaller)

    def gather(rows, number):
        session = rows.sparkSession
        complete, _ = split_null_keys(rows, keys)
        with _setting(session, "spark.sql.shuffle.partitions", buckets):
            append_bucketed(keep_one(complete, keys, order), gathered, keys, buckets)
        drop_shuffles(rows)
        release_shuffles(session)

    def merge():
        if not spark.catalog.tableExists(gathered):
            return
        spark.catalog.refreshTable(gathered)
        rows = spark.table(gathered)
        if not (spark.catalog.tableExists(name) and rows.isEmpty()):
            upsert_bucketed(spark, keep_one(rows, keys, order), name, keys, buckets, dealt=True, update_condition=better)
            spark.catalog.refreshTable(name)
        spark.sql(f"DROP TABLE {gathered}")

    merge()
    with _setting(spark, _POLICY_SETTING, WATERMARK_POLICY):
        query = _run(signals.writeStream.foreachBatch(gather), checkpoint)
    if taken:
        taken()
    merge()
    return query


#: Weeks begin on Monday; the epoch was a Thursday.
_MONDAY = "4 days"


def weekly_tags(stream, event_time, delay):
    """``term``, ``week_start`` and ``count`` of the tags of each week, once the week is over.

    Only rows with a tag move the watermark. A week is given out when the newest event time is ``delay`` past its end; rows later than that are
    left out and counted by the query (:func:`dropped_late`), from the second micro-batch after on.
    """
    timed = stream.withWatermark(event_time, delay).select(event_time, F.explode("tags").alias("_raw"))
    term = F.lower(F.trim("_raw")).alias("term")
    weeks = timed.where(F.length("_raw") > 1).groupBy(
        F.window(event_time, "7 days", "7 days", _MONDAY).alias("week"), term
    ).agg(F.count(F.lit(1)).alias("count"))
    return weeks.select("term", F.to_date("week.start").alias("week_start"), "count")


def dropped_late(query):
    """Rows (or groups of a micro-batch) that came too late for the query's state."""
    return sum(
        state["numRowsDroppedByWatermark"] for p in query.recentProgress for state in p["stateOperators"]
    )


def best_rows(stream, key, score, tie):
    """Changes of the best row of each key: highest ``score``, of equal ones the smallest ``tie``.

    The state has a score, a tie and its time for each key; a micro-batch gives a row only for keys whose best
    row changed. Rows are cut down to one a key in each task before they meet the state. ``key`` is text, ``score`` a double and ``tie`` a long; rows that lack one are left out.
    """
    rows = stream.select(
        F.col(key).cast("string").alias("key"), F.col(score).cast("double").alias("score"),
        F.col(tie).cast("long").alias("tie"),
    ).where("key is not null and score is not null and tie is not null")

    # The time of a micro-batch is one value, so a best row that has this one's came with it. Of equal rows the
    # earliest stays. The complement turns the order of ties around and can't overflow.
    now = -F.unix_micros(F.current_timestamp())
    best = F.max(F.struct("score", F.bitwise_not("tie").alias("tie"), "at")).alias("best")
    changed = rows.withColumn("at", now).groupBy("key").agg(best).where(F.col("best.at") == now)
    return changed.select("key", "best.score", F.bitwise_not("best.tie").alias("tie"))


def write_changes(stream, path, checkpoint):
    """Writes the changes of each micro-batch under its number; a repeated batch replaces its own."""

    def write(rows, number):
        (
            rows.withColumn("_batch", F.lit(number)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(path)
        )

    return _run(stream.writeStream.outputMode("update").foreachBatch(write), checkpoint)
