"""Merge, versions and layout."""

import uuid
from functools import reduce

from pyspark.sql import functions as F

from contract import query
from contract.bronze import _STORY_SQL
from contract.sql import spread
from trendmill import constants as c
from trendmill.functions.scalars import ntz
from trendmill.operators import layout, versions
from trendmill.operators.bucketed import upsert_bucketed
from trendmill.operators.merge import merge_upsert, upsert_table
from trendmill.plans import refresh, whole
from trendmill.session import work_path, written
from trendmill.sources import feeds, landing
from trendmill.sources import standins as s
from trendmill.sources.standins import table

# Customers in debt get 100, and every supplier becomes a customer under a negative key.
_INDEBTED = """SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal,
  'CREDIT' AS c_mktsegment FROM customer WHERE c_acctbal < 0"""
_SUPPLIERS = """SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier"""
_SOURCE = f"incoming AS ({_INDEBTED} UNION ALL {_SUPPLIERS})"


def indebted(spark, folder):
    return table(spark, folder, "customer").where("c_acctbal < 0").withColumns(
        {"c_acctbal": F.col("c_acctbal") + 100, "c_mktsegment": F.lit("CREDIT")}
    )


def suppliers(spark, folder):
    return table(spark, folder, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )


def incoming(spark, folder):
    return indebted(spark, folder).unionByName(suppliers(spark, folder))


@query("merge_upsert", f"""WITH {_SOURCE}
SELECT * FROM incoming
UNION ALL SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM incoming)""")
def merge_all_columns(spark, folder):
    return merge_upsert(
        table(spark, folder, "customer"), incoming(spark, folder), ["c_custkey"]
    )


@query("merge_upsert_partial_cols", """
SELECT c_custkey, c_name, c_nationkey,
  CASE WHEN c_acctbal < 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer
UNION ALL SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier""")
def merge_partial(spark, folder):
    return merge_upsert(
        table(spark, folder, "customer"), incoming(spark, folder), ["c_custkey"], ["c_acctbal"]
    )


@query("upsert_table", """
SELECT event_id, CASE WHEN event_id % 5 = 0 OR event_id % 2 <> 0 THEN value + 1 ELSE value END AS value,
  CASE WHEN event_id % 5 = 0 AND event_type = 'view' THEN 'moved=50%/a:b'
    ELSE event_type || ':' || ts::DATE || '/x' END AS part
FROM events WHERE event_id IS NOT NULL""")
def upsert_of_parts(spark, folder):
    """All events: a first write, an empty source, then new and changed rows, some of which move.

    The names of the partitions hold characters that folders can't.
    """
    path = work_path(spark, "upsert-table")
    events = table(spark, folder, "events").select(
        "event_id", "value", F.concat("event_type", F.lit(":"), F.to_date("ts").cast("string"), F.lit("/x"))
        .alias("part"), "event_type",
    )
    columns = ["event_id", "value", "part"]
    upsert_table(spark, events.where("event_id % 2 = 0").select(columns), path, ["event_id"], "part")
    upsert_table(spark, events.where("false").select(columns), path, ["event_id"], "part")
    moves = (F.col("event_id") % 5 == 0) & (F.col("event_type") == "view")
    changed = events.where("event_id % 5 = 0 or event_id % 2 <> 0").withColumns({
        "value": F.col("value") + 1, "part": F.when(moves, "moved=50%/a:b").otherwise(F.col("part")),
    })
    upsert_table(spark, changed.select(columns), path, ["event_id"], "part")
    return spark.read.schema(events.select(columns).schema).parquet(path)


@query("upsert_bucketed", f"""WITH {_SOURCE}
SELECT * FROM incoming
UNION ALL SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM incoming)""")
def upsert_of_buckets(spark, folder):
    """Customers in a bucketed table; only the incoming rows are shuffled."""
    name = f"customers_{uuid.uuid4().hex}"
    upsert_bucketed(spark, table(spark, folder, "customer"), name, ["c_custkey"], 16)
    upsert_bucketed(spark, incoming(spark, folder), name, ["c_custkey"], 16)
    found = written(spark.table(name), "customers")
    spark.sql(f"DROP TABLE {name}")
    return found


@query("late_batch", f"SELECT md5('{c.STORIES}' || id) AS signal_id, title FROM ({_STORY_SQL})")
def late_batch(spark, folder):
    """Two bronze batches, the second of which lands after a run but was stamped before it."""
    work, events = work_path(spark, "late-batch"), table(spark, folder, "events")
    for part, (batch, stamp) in enumerate([("b2", "2024-01-07"), ("b1", "2024-01-05")]):
        rows = feeds.stories(s.story_records(events.where(F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(2)) == part)))
        landing.append_bronze(rows, f"{work}/stories", c.STORIES, batch, ntz(stamp))
        refresh.refresh_silver(
            spark, {c.STORIES: f"{work}/stories"}, f"{work}/silver", f"{work}/marks",
            f"{work}/quality", s.AS_OF,
        )
    return refresh.current_signals(spark, f"{work}/silver").select("signal_id", "title")


@query("whole_run", f"""
WITH days AS (
  SELECT ts::DATE AS day FROM events WHERE event_type <> 'error'
  UNION ALL SELECT ({spread('page_id')})::DATE FROM pages)
SELECT 'ingest {c.STORIES}' AS step, 'SUCCESS' AS status, count(*)::VARCHAR AS result FROM ({_STORY_SQL})
UNION ALL SELECT 'ingest {c.QUESTIONS}', 'SUCCESS', count(*)::VARCHAR FROM pages
UNION ALL SELECT 'ingest {c.REPOS}', 'FAILED', NULL
UNION ALL SELECT 'silver', 'SUCCESS', count(*)::VARCHAR FROM days
UNION ALL SELECT 'gold', 'SUCCESS', count(*)::VARCHAR FROM days
  WHERE day BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
UNION ALL SELECT 'read by name', 'SUCCESS', count(*)::VARCHAR FROM days
  WHERE day BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'""")
def one_whole_run(spark, folder):
    """A run over two feeds and one that can't be read, then a gold table read by its name."""
    database = f"run_{uuid.uuid4().hex}"

    def unreadable():
        return spark.read.parquet(work_path(spark, "never-landed"))

    log = whole.whole_run(
        spark,
        {
            c.STORIES: feeds.stories(s.story_records(table(spark, folder, "events"))),
            c.REPOS: unreadable,
            c.QUESTIONS: feeds.questions(s.question_records(table(spark, folder, "pages"))),
        },
        work_path(spark, "whole-run"), database, "b1", s.AS_OF, "2024-01-01", "2024-01-31",
    )
    total = spark.table(f"{database}.source_summary").agg(
        F.lit("read by name").alias("step"), F.lit("SUCCESS").alias("status"),
        F.sum("signal_count").cast("string").alias("result"),
    )
    found = written(
        log.select("step", "status", F.when(F.col("status") != "FAILED", F.col("result")).alias("result"))
        .unionByName(total),
        "run-log",
    )
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return found


def change_log(spark, folder):
    """Changes of three days in one table, each row with its version, time and operation."""
    changes = [
        (table(spark, folder, "customer"), "2024-01-01", "CREATE"),
        (indebted(spark, folder), "2024-01-02", "MERGE"),
        (incoming(spark, folder), "2024-01-03", "MERGE"),
    ]
    return written(
        reduce(
            lambda a, b: a.unionByName(b),
            [
                versions.as_commit(rows, number, day, operation)
                for number, (rows, day, operation) in enumerate(changes, 1)
            ],
        ),
        "customer-changes",
    )


@query("table_history", """
SELECT 1::BIGINT AS version, TIMESTAMP '2024-01-01' AS timestamp, 'CREATE' AS operation,
  count(*) AS num_rows, count(*) AS num_inserted, 0::BIGINT AS num_updated FROM customer
UNION ALL SELECT 2, TIMESTAMP '2024-01-02', 'MERGE', count(*), 0, count(*)
  FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 3, TIMESTAMP '2024-01-03', 'MERGE',
  (SELECT count(*) FROM customer WHERE c_acctbal < 0) + (SELECT count(*) FROM supplier),
  (SELECT count(*) FROM supplier), (SELECT count(*) FROM customer WHERE c_acctbal < 0)""")
def table_history(spark, folder):
    return versions.history(change_log(spark, folder), ["c_custkey"], newest=5)


@query("as_of_version", """
SELECT 'earliest' AS version, c_custkey, c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT '2', c_custkey,
  CASE WHEN c_acctbal < 0 THEN c_acctbal + 100 ELSE c_acctbal END,
  CASE WHEN c_acctbal < 0 THEN 'CREDIT' ELSE c_mktsegment END FROM customer""")
def as_of_version(spark, folder):
    log = change_log(spark, folder)
    earliest = versions.earliest_version(log).first()["version"]

    def content(version, name):
        rows = versions.as_of(log, ["c_custkey"], version=version)
        return rows.select(F.lit(name).alias("version"), "c_custkey", "c_acctbal", "c_mktsegment")

    return content(earliest, "earliest").unionByName(content(2, "2"))


@query("as_of_timestamp", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_acctbal < 0 THEN 'CREDIT' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def as_of_timestamp(spark, folder):
    """As of noon of the second day, plus nothing from before the first commit."""
    log = change_log(spark, folder)
    noon = versions.as_of(log, ["c_custkey"], timestamp="2024-01-02 12:00:00")
    before = versions.as_of(log, ["c_custkey"], timestamp="2023-12-31")
    return noon.unionByName(before).select("c_custkey", "c_acctbal", "c_mktsegment")


@query("layout_rewrite", "SELECT event_id, event_type, ts::TIMESTAMP AS ts, value FROM events")
def layout_rewrite(spark, folder):
    events = table(spark, folder, "events")
    path = work_path(spark, "events-clustered")
    clustered = layout.write_clustered(events, path, ["event_type", "ts", "event_id"])
    return clustered.select("event_id", "event_type", "ts", "value")
