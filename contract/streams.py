"""Incremental loads over the landed events."""

import uuid

from pyspark.sql import functions as F

from contract import query
from contract.bronze import _STORY_SQL, PAPERS_SQL
from contract.silver import PROCESSED_AT, UNIFIED_SQL, bronze_by_source
from trendmill.functions.scalars import ntz
from trendmill.operators.dedup import keep_one
from trendmill.operators.versions import read_log
from trendmill.plans.silver import PREFERENCE, stories_to_signals
from trendmill.session import delete_path, path_bytes, work_path, written
from trendmill.sources import feeds
from trendmill.sources import standins as s
from trendmill.sources.landing import with_ingestion_columns
from trendmill.sources.standins import table
from trendmill.streaming import loads


_FILES = 4
#: What lands at once is taken in parts of about so many bytes, but no more than about so many parts.
_PART, _PARTS = 128 * 2**20, 6


def _land(rows, path, n=0):
    """Lands rows as one more file set; a run after it takes the set as one micro-batch, whatever its files."""
    rows.write.mode("append").option("compression", "zstd").parquet(f"{path}/{n}")


def _stream(spark, path, like, **options):
    return loads.landed_parquet(spark, f"{path}/*", like.schema, **options)


def _share(events, n):
    return events.where(F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(_FILES)) == n)


@query("stream_incremental", "SELECT event_id, event_type, value, props FROM events")
def stream_incremental(spark, folder):
    """Events land in several goes with a run after each; a last run finds nothing new."""
    work, events = work_path(spark, "stream-append"), table(spark, folder, "events")
    for n in range(_FILES):
        _land(_share(events, n), f"{work}/landed", n)
        loads.append_new(_stream(spark, f"{work}/landed", events), f"{work}/data", f"{work}/progress")
    loads.append_new(_stream(spark, f"{work}/landed", events), f"{work}/data", f"{work}/progress")
    return spark.read.parquet(f"{work}/data").select("event_id", "event_type", "value", "props")


@query("stream_upsert", """
SELECT user_id, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) = 1""")
def stream_upsert(spark, folder):
    """Best event of each user across micro-batches of one landing each; users occur in many."""
    work, events = work_path(spark, "stream-upsert"), table(spark, folder, "events")
    order = [F.col("value").desc(), F.col("event_id").asc()]
    # Events without a user belong together under a key of their own.
    key = F.coalesce(F.col("user_id").cast("string"), F.lit("none")).alias("key")
    rows = _stream(spark, f"{work}/landed", events).select(key, "user_id", "event_id", "value")
    for n in range(_FILES):
        _land(_share(events, n), f"{work}/landed", n)
        loads.upsert_new(rows, f"{work}/log", f"{work}/progress", ["key"], order)
    log = spark.read.parquet(f"{work}/log")
    return loads.current_rows(log, ["key"], order).select("user_id", "event_id", "value")


@query("stream_upsert_bucketed", """
SELECT user_id, event_id, value FROM events WHERE user_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) = 1""")
def stream_upsert_bucketed(spark, folder):
    """Best event of each user in a bucketed table that every micro-batch is merged into."""
    work, events = work_path(spark, "stream-bucketed"), table(spark, folder, "events")
    order = [F.col("value").desc(), F.col("event_id").asc()]
    name = f"best_events_{uuid.uuid4().hex}"
    rows = _stream(spark, f"{work}/landed", events).select("user_id", "event_id", "value")

    def better(old, new):
        return (new("value") > old("value")) | (
            (new("value") == old("value")) & (new("event_id") < old("event_id"))
        )

    for n in range(_FILES):
        _land(_share(events, n), f"{work}/landed", n)
        loads.upsert_new_bucketed(rows, name, f"{work}/progress", ["user_id"], order, better=better)
    found = written(spark.table(name), "best-events")
    spark.sql(f"DROP TABLE {name}")
    return found


@query("stream_unified", UNIFIED_SQL)
def stream_unified(spark, folder):
    """Four feeds fetched twice, landing unevenly, in one stream and one table.

    A large landing is taken in a few parts, each of which goes from the landing zone once it is taken.
    """
    work, bronze = work_path(spark, "stream-unified"), bronze_by_source(spark, folder)
    name = f"signals_{uuid.uuid4().hex}"
    for n, batch in enumerate(["b1", "b2"]):
        # Half of the feeds are a run ahead of the others, and land once more beside them.
        ahead = [source for m, source in enumerate(bronze) if m % 2 == n]
        for run, sources in enumerate([ahead, list(bronze)]):
            for source in sources:
                _land(bronze[source].where(F.col("_batch_id") == batch), f"{work}/{source}", f"{batch}-{run}")
            landed = {source: path_bytes(spark, f"{work}/{source}/{batch}-{run}") for source in sources}
            parts = min(_PARTS, 1 + sum(landed.values()) // _PART)
            streams = {
                source: _stream(
                    spark, f"{work}/{source}", rows, bytes_per_batch=1 + landed.get(source, 0) // parts, keep=False
                )
                for source, rows in bronze.items()
            }

            def clear():
                for source in sources:
                    delete_path(spark, f"{work}/{source}/{batch}-{run}")

            loads.upsert_signals(
                loads.one_stream(streams, ntz(PROCESSED_AT)), name, f"{work}/progress", taken=clear
            )
    found = written(spark.table(name).drop(*PREFERENCE), "unified")
    spark.sql(f"DROP TABLE {name}")
    return found


@query("stream_best_row", """
SELECT user_id::VARCHAR AS key, value AS score, event_id AS tie
FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL AND event_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) = 1""")
def stream_best_row(spark, folder):
    """The last change of each user's best event; state holds one row a user."""
    work, events = work_path(spark, "stream-best"), table(spark, folder, "events")
    changes = loads.best_rows(_stream(spark, f"{work}/landed", events), "user_id", "value", "event_id")
    for n in range(_FILES):
        _land(_share(events, n), f"{work}/landed", n)
        loads.write_changes(changes, f"{work}/changes", f"{work}/progress")
    log = spark.read.schema("key string, score double, tie long, _batch long").parquet(f"{work}/changes")
    return keep_one(log, ["key"], [F.col("_batch").desc()]).drop("_batch")


@query("stream_weekly_tags", """
SELECT term, date_trunc('week', ts)::DATE AS week_start, count(*) AS count
FROM (SELECT ts, lower(trim(unnest([event_type, 'k' || regexp_extract(props, '"k": *([0-9]+)', 1)]), ' ')) AS term
      FROM events) WHERE length(term) > 1 GROUP BY ALL""")
def stream_weekly_tags(spark, folder):
    """Tags of each week from events that land in the order of time.

    A row from long after moves the watermark past the last week, and the micro-batch after it gives that out.
    """
    work = work_path(spark, "stream-weeks")
    signals = s.event_signals(table(spark, folder, "events")).select(
        F.col("created_at").cast("timestamp").alias("created_at"), "tags"
    )
    span = signals.agg(F.min("created_at").alias("first"), F.max("created_at").alias("last")).first()
    start, end = (F.lit(span[0]).cast("timestamp"), F.lit(span[1]).cast("timestamp"))
    width = (F.unix_seconds(end) - F.unix_seconds(start)) / _FILES + 1
    place = F.floor((F.unix_seconds("created_at") - F.unix_seconds(start)) / width)
    later = spark.range(1).select(
        (end + F.expr("interval 60 days")).alias("created_at"), F.array(F.lit("-")).alias("tags")
    )
    weeks = loads.weekly_tags(_stream(spark, f"{work}/landed", signals), "created_at", "1 day")
    for n in range(_FILES + 2):
        _land(signals.where(place == n) if n < _FILES else later, f"{work}/landed", n)
        loads.append_new(weeks, f"{work}/data", f"{work}/progress")
    return spark.read.schema("term string, week_start date, count long").parquet(f"{work}/data")


@query("stream_quality_log", """
SELECT event_type AS source, count(*) AS total_rows, count(*) FILTER (user_id IS NULL) AS null_users,
  count(*) FILTER (value IS NULL OR event_type = 'error') AS null_values FROM events GROUP BY event_type""")
def stream_quality_log(spark, folder):
    """Rows and NULLs that the loads of each event type logged, over all their micro-batches."""
    work, events = work_path(spark, "stream-checked"), table(spark, folder, "events")
    events = events.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    logs = None
    for kind in sorted(r[0] for r in events.select("event_type").distinct().collect()):
        for n in range(2):
            _land(_share(events, n).unionAll(_share(events, n + 2)).where(F.col("event_type") == kind),
                  f"{work}/{kind}/landed", n)
            loads.append_checked(
                _stream(spark, f"{work}/{kind}/landed", events), f"{work}/{kind}/data", f"{work}/{kind}/progress",
                f"{work}/{kind}/log", kind, ["user_id", "value"],
            )
        log = spark.read.parquet(f"{work}/{kind}/log")
        logs = log if logs is None else logs.unionByName(log)

    def nulls(name):
        return F.sum(F.get_json_object("null_counts", f"$.{name}").cast("long"))

    return logs.groupBy("source").agg(
        F.sum("total_rows").alias("total_rows"), nulls("user_id").alias("null_users"),
        nulls("value").alias("null_values"),
    )


@query("stream_dedup", "SELECT event_id, event_type FROM events")
def stream_dedup(spark, folder):
    """Every event lands again one landing later; state covers two landings' time, not the whole span."""
    work = work_path(spark, "stream-dedup")
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    span = events.agg(
        F.unix_seconds(F.min("ts")).alias("first"), F.unix_seconds(F.max("ts")).alias("last")
    ).first()
    # An event without a time counts as one of the first moment.
    start = F.timestamp_seconds(F.lit(span["first"] or 0))
    events = events.withColumn("ts", F.coalesce("ts", start))
    width = ((span["last"] or 0) - (span["first"] or 0)) // _FILES + 1
    place = F.expr(f"(unix_seconds(ts) - {span['first'] or 0}) div {width}")
    stream = _stream(spark, f"{work}/landed", events)
    unique = loads.drop_repeats(stream, ["event_id"], "ts", f"{2 * width} seconds")
    for n in range(_FILES + 1):
        _land(events.where(place.between(n - 1, n)), f"{work}/landed", n)
        loads.append_new(unique, f"{work}/data", f"{work}/progress")
    return spark.read.parquet(f"{work}/data").select("event_id", "event_type")


@query("stream_papers", PAPERS_SQL)
def stream_papers(spark, folder):
    """Atom files landed in several goes, parsed as a stream."""
    work, documents = work_path(spark, "stream-papers"), table(spark, folder, "documents")
    for n in range(_FILES):
        entries = s.document_entries(documents.where(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(_FILES)) == n))
        # The first entry of each file opens its root.
        first = F.monotonically_increasing_id().bitwiseAND(2**33 - 1) == 0
        feed = F.concat(F.when(first, "<feed>").otherwise(""), "value")
        entries.select(feed.alias("value")).write.text(f"{work}/landed/{n}")
        papers = loads.landed_feed(spark, "papers", f"{work}/landed/*")
        loads.append_new(papers, f"{work}/data", f"{work}/progress")
    return spark.read.parquet(f"{work}/data").drop("_raw_json")


@query("reprocess_equals_incremental", f"""
SELECT 'both' AS found_in, count(*) AS signals FROM ({_STORY_SQL}) HAVING count(*) > 0""")
def reprocess_equals_incremental(spark, folder):
    """Stories fetched twice: best rows of the incremental load against those of a full batch read."""

    def signals(rows):
        bronze = with_ingestion_columns(rows, "stories", "b1", ntz(s.AS_OF))
        return stories_to_signals(bronze, ntz(s.AS_OF))

    work, events = work_path(spark, "stream-signals"), table(spark, folder, "events")
    fetches = [s.story_records(events), s.story_records_again(events)]
    landed = feeds.stories(_stream(spark, f"{work}/landed", fetches[0]))
    order = [F.col("score").desc(), F.col("body")]
    for n, records in enumerate(fetches):
        _land(records, f"{work}/landed", n)
        loads.upsert_new(
            landed, f"{work}/log", f"{work}/progress", ["signal_id"], order, prepare=signals
        )
    log = read_log(spark, f"{work}/log")
    incremental = loads.current_rows(log, ["signal_id"], order)
    full = keep_one(signals(feeds.stories(fetches[0].unionByName(fetches[1]))), ["signal_id"], order)
    names = full.columns
    sides = full.withColumn("_side", F.lit(1)).unionByName(
        incremental.select(*names, F.lit(-1).alias("_side"))
    )
    balance = sides.groupBy(*names).agg(F.sum("_side").alias("_balance"))
    found = (
        F.when(F.col("_balance") == 0, "both")
        .when(F.col("_balance") > 0, "full only")
        .otherwise("incremental only")
    )
    return balance.groupBy(found.alias("found_in")).agg(F.count(F.lit(1)).alias("signals"))
