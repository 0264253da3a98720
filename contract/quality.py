"""Data quality checks and their log."""

from pyspark.sql import functions as F

from contract import query
from contract.sql import SIGNALS, rounded
from trendmill.functions.scalars import ntz
from trendmill.operators import quality
from trendmill.sources import standins as s
from trendmill.sources.standins import table

_KEYS = ["signal_id"]
_REQUIRED = ["signal_id", "title", "url", "created_at", "not_a_column"]

# Errors have no title, views and Spanish documents no url, and purchases were ingested twice.
CHECKED = f"""{SIGNALS}, checked AS (
  SELECT signal_id, source, created_at, created_at::DATE AS date,
    CASE WHEN source = 'events' AND title = 'error' THEN NULL ELSE title END AS title,
    CASE WHEN (source = 'events' AND title = 'view') OR (source = 'documents' AND language = 'es')
      THEN NULL ELSE url END AS url
  FROM (SELECT * FROM signals
        UNION ALL SELECT * FROM signals WHERE source = 'events' AND title = 'purchase')
)"""

_MEASURES = """count(*) AS total_rows, count(*) FILTER (signal_id IS NULL) AS null_signal_id,
    count(*) FILTER (title IS NULL) AS null_title, count(*) FILTER (url IS NULL) AS null_url,
    count(*) FILTER (created_at IS NULL) AS null_created_at,
    count(*) - count(DISTINCT signal_id) AS duplicate_count, max(created_at) AS newest"""

_PASSED = """null_title <= 0.1 * total_rows AND null_url <= 0.1 * total_rows
    AND duplicate_count <= 0.01 * total_rows"""

_JSON = """'{"signal_id":' || null_signal_id || ',"title":' || null_title || ',"url":' || null_url
    || ',"created_at":' || null_created_at || '}'"""


def _hours(newest, as_of):
    return f"date_diff('microsecond', {newest}, {as_of}) / 3.6e9"


LOG = f"""{CHECKED}, quality_log AS (
  SELECT md5(source || '|' || batch_id || '|' || strftime(checked_at, '%Y-%m-%d %H:%M:%S'))
      AS log_id, source, batch_id, total_rows, {_JSON} AS null_counts, duplicate_count,
    {rounded(_hours('newest', 'checked_at'), 2)} AS freshness_hours,
    {_hours('newest', 'checked_at')} <= 48 AS is_fresh,
    {_PASSED} AND {_hours('newest', 'checked_at')} <= 48 AS quality_passed, checked_at
  FROM (
    SELECT *, source || '_' || strftime(date, '%Y%m%d') AS batch_id,
      date::TIMESTAMP + INTERVAL 1 DAY AS checked_at
    FROM (SELECT source, date, {_MEASURES} FROM checked GROUP BY source, date)
  )
)"""


def checked(spark, folder):
    again = s.event_signals(table(spark, folder, "events")).where("title = 'purchase'")
    rows = s.signals(spark, folder).unionByName(again)
    event = F.col("source") == "events"
    no_title = event & (F.col("title") == "error")
    no_url = (event & (F.col("title") == "view")) | (
        (F.col("source") == "documents") & (F.col("language") == "es")
    )
    return rows.select(
        "signal_id", "source", "created_at", F.to_date("created_at").alias("date"),
        F.when(~no_title, F.col("title")).alias("title"),
        F.when(~F.coalesce(no_url, F.lit(False)), F.col("url")).alias("url"),
    )


def metrics(spark, folder):
    return quality.quality_metrics(
        checked(spark, folder), _KEYS, _REQUIRED, "created_at", s.AS_OF
    )


def log(spark, folder):
    """One check per source and day, made at the following midnight."""
    midnight = F.date_add("date", 1).cast("timestamp_ntz")
    daily = quality.quality_metrics(
        checked(spark, folder), _KEYS, _REQUIRED, "created_at", midnight, ("source", "date")
    )
    batch = F.concat_ws("_", "source", F.date_format("date", "yyyyMMdd"))
    return quality.log_rows(quality.with_gate(daily), batch, midnight)


@query("quality_nulls", f"""WITH {CHECKED}
SELECT source, 'signal_id' AS column_name, count(*) FILTER (signal_id IS NULL) AS null_count
  FROM checked GROUP BY source
UNION ALL SELECT source, 'title', count(*) FILTER (title IS NULL) FROM checked GROUP BY source
UNION ALL SELECT source, 'url', count(*) FILTER (url IS NULL) FROM checked GROUP BY source
UNION ALL SELECT source, 'created_at', count(*) FILTER (created_at IS NULL)
  FROM checked GROUP BY source""")
def quality_nulls(spark, folder):
    return quality.null_counts_long(metrics(spark, folder), "source")


@query("quality_duplicates", f"""WITH {CHECKED}
SELECT source, total_rows, duplicate_count FROM (SELECT source, {_MEASURES}
FROM checked GROUP BY source)""")
def quality_duplicates(spark, folder):
    return metrics(spark, folder).select("source", "total_rows", "duplicate_count")


@query("quality_freshness", f"""WITH {CHECKED}
SELECT source, newest, {rounded(_hours('newest', "TIMESTAMP '2024-02-01'"), 2)} AS freshness_hours,
  {_hours('newest', "TIMESTAMP '2024-02-01'")} <= 48 AS is_fresh
FROM (SELECT source, max(created_at) AS newest FROM checked GROUP BY source)""")
def quality_freshness(spark, folder):
    return metrics(spark, folder).select("source", "newest", "freshness_hours", "is_fresh")


@query("quality_metrics", f"""WITH {CHECKED}
SELECT 'all' AS source, total_rows, {_JSON} AS null_counts, duplicate_count, newest,
  {rounded(_hours('newest', "TIMESTAMP '2024-02-01'"), 2)} AS freshness_hours,
  {_hours('newest', "TIMESTAMP '2024-02-01'")} <= 48 AS is_fresh
FROM (SELECT {_MEASURES} FROM checked)""")
def quality_metrics(spark, folder):
    """Metrics of the whole table as one group."""
    whole = quality.table_metrics(
        checked(spark, folder), "all", key_columns=_KEYS, required_columns=_REQUIRED,
        timestamp_column="created_at", as_of=s.AS_OF,
    )
    return whole.withColumn("null_counts", F.to_json("null_counts"))


@query("quality_gate", f"""WITH {CHECKED}
SELECT source, date, total_rows,
  list_concat(
    CASE WHEN null_title > 0.1 * total_rows THEN ['nulls:title'] ELSE []::VARCHAR[] END,
    CASE WHEN null_url > 0.1 * total_rows THEN ['nulls:url'] ELSE []::VARCHAR[] END,
    CASE WHEN duplicate_count > 0.01 * total_rows THEN ['duplicates'] ELSE []::VARCHAR[] END,
    CASE WHEN {_hours('newest', "TIMESTAMP '2024-01-20'")} > 48 THEN ['stale']
      ELSE []::VARCHAR[] END) AS breaches,
  {_PASSED} AND {_hours('newest', "TIMESTAMP '2024-01-20'")} <= 48 AS quality_passed
FROM (SELECT source, date, {_MEASURES} FROM checked GROUP BY source, date)""")
def quality_gate(spark, folder):
    daily = quality.quality_metrics(
        checked(spark, folder), _KEYS, _REQUIRED, "created_at", ntz("2024-01-20"),
        ("source", "date"),
    )
    return quality.with_gate(daily).select(
        "source", "date", "total_rows", "breaches", "quality_passed"
    )


@query("quality_log", f"WITH {LOG} SELECT * FROM quality_log")
def quality_log(spark, folder):
    return log(spark, folder)
