"""Per-source transforms, dedup, unified signals."""

from pyspark.sql import functions as F

from contract import query
from contract.sql import PAGE, SIGNALS, SPACE, spread
from trendmill import constants as c
from trendmill.functions.scalars import ntz
from trendmill.operators.dedup import keep_best, keep_latest
from trendmill.plans import gold, silver
from trendmill.sources import feeds
from trendmill.sources import standins as s
from trendmill.sources.landing import with_ingestion_columns
from trendmill.sources.standins import table

_FIRST, _AGAIN, _DONE = "2024-01-31", "2024-02-01", "2024-02-02"


def _twice(first, again, source):
    """Bronze rows of two runs a day apart."""
    return with_ingestion_columns(first, source, "b1", ntz(_FIRST)).unionByName(
        with_ingestion_columns(again, source, "b2", ntz(_AGAIN))
    )


def bronze_stories(spark, folder):
    events = table(spark, folder, "events")
    return _twice(
        feeds.stories(s.story_records(events)),
        feeds.stories(s.story_records_again(events)),
        c.STORIES,
    )


def bronze_repos(spark, folder):
    documents = s.table(spark, folder, "documents")
    return _twice(
        feeds.repos(s.repo_records(documents)),
        feeds.repos(s.repo_records(documents, more_stars=1)),
        c.REPOS,
    )


def bronze_papers(spark, folder):
    turns = s.table(spark, folder, "conversations")
    first = feeds.papers(s.turn_entries(turns))
    again = first.withColumn("link", F.concat("link", F.lit("?v2")))
    return _twice(first, again, c.PAPERS)


def bronze_questions(spark, folder):
    pages = s.table(spark, folder, "pages")
    first = feeds.questions(s.question_records(pages))
    again = first.withColumn("score", F.when(F.col("is_answered"), F.col("score") + 1).otherwise(0))
    return _twice(first, again, c.QUESTIONS)


_STORIES = """SELECT md5('hackernews' || event_id) AS signal_id, 'hackernews' AS source,
  event_type AS title,
  CASE WHEN event_type IN ('purchase', 'click') THEN props || ' again' ELSE props END AS body,
  CASE WHEN event_type = 'view' THEN 'https://news.ycombinator.com/item?id=' || event_id
    ELSE 'event://' || event_id END AS url,
  user_id::VARCHAR AS author,
  floor(value)::INT + CASE event_type WHEN 'purchase' THEN 1 ELSE 0 END AS score,
  date_trunc('second', ts)::TIMESTAMP AS created_at, []::VARCHAR[] AS tags,
  NULL::VARCHAR AS language, TIMESTAMP '2024-02-02' AS _silver_processed_at
FROM events WHERE event_type <> 'error'"""

_REPOS = f"""SELECT md5('github' || source || '/' || doc_id) AS signal_id, 'github' AS source,
  text AS title, text AS body, 'doc://' || doc_id AS url, source AS author,
  n_chars::INT + 1 AS score, {spread('doc_id')} AS created_at,
  CASE WHEN lang = 'es' THEN []::VARCHAR[] ELSE [lang, source] END AS tags, lang AS language,
  TIMESTAMP '2024-02-02' AS _silver_processed_at
FROM documents"""

_PAPERS = f"""SELECT md5('arxiv' || conv_id || ':' || turn) AS signal_id, 'arxiv' AS source,
  trim(regexp_replace(text, '{SPACE}', ' ', 'g'), ' ') AS title,
  trim(regexp_replace(text, '{SPACE}', ' ', 'g'), ' ') AS body,
  'conv://' || conv_id || ':' || turn || '?v2' AS url,
  CASE WHEN role = 'system' THEN 'unknown' ELSE role END AS author, 0 AS score,
  {spread('conv_id')} AS created_at, [role, 'turn'] AS tags, NULL::VARCHAR AS language,
  TIMESTAMP '2024-02-02' AS _silver_processed_at
FROM conversations"""

_QUESTIONS = f"""SELECT md5('stackoverflow' || page_id) AS signal_id, 'stackoverflow' AS source,
  {PAGE['title']} AS title, regexp_replace(html, '<[^>]+>', ' ', 'g') AS body, url,
  CASE WHEN url LIKE 'https%' THEN {PAGE['host']} ELSE 'anonymous' END AS author,
  length(url)::INT + CASE WHEN url LIKE 'https%' THEN 1 ELSE 0 END AS score,
  {spread('page_id')} AS created_at,
  CASE WHEN url LIKE 'https%' THEN [{PAGE['lang']}] ELSE []::VARCHAR[] END AS tags,
  CASE WHEN url LIKE 'https%' THEN {PAGE['lang']} END AS language,
  TIMESTAMP '2024-02-02' AS _silver_processed_at
FROM pages"""


@query("silver_stories", _STORIES)
def silver_stories(spark, folder):
    return silver.stories_to_signals(bronze_stories(spark, folder), ntz(_DONE))


@query("silver_repos", _REPOS)
def silver_repos(spark, folder):
    return silver.repos_to_signals(bronze_repos(spark, folder), ntz(_DONE))


@query("silver_papers", _PAPERS)
def silver_papers(spark, folder):
    return silver.papers_to_signals(bronze_papers(spark, folder), ntz(_DONE))


@query("silver_questions", _QUESTIONS)
def silver_questions(spark, folder):
    return silver.questions_to_signals(bronze_questions(spark, folder), ntz(_DONE))


UNIFIED_SQL, PROCESSED_AT = " UNION ALL ".join([_STORIES, _REPOS, _PAPERS, _QUESTIONS]), _DONE


def bronze_by_source(spark, folder):
    return {
        c.STORIES: bronze_stories(spark, folder),
        c.REPOS: bronze_repos(spark, folder),
        c.PAPERS: bronze_papers(spark, folder),
        c.QUESTIONS: bronze_questions(spark, folder),
    }


@query("unified_signals", UNIFIED_SQL)
def unified_signals(spark, folder):
    bronze = bronze_by_source(spark, folder) | {"mailing lists": table(spark, folder, "labels")}
    return silver.unify(bronze, ntz(_DONE))


@query("silver_breakdown", f"""WITH {SIGNALS}
SELECT source, count(*) AS count, avg(score) AS avg_score, max(created_at) AS latest_signal
FROM signals GROUP BY source""")
def silver_breakdown(spark, folder):
    return silver.breakdown(s.signals(spark, folder))


@query("latest_signals", f"""WITH {SIGNALS}
SELECT signal_id, source, title, created_at FROM signals
ORDER BY created_at DESC, signal_id LIMIT 10""")
def latest_signals(spark, folder):
    rows = s.signals(spark, folder).select("signal_id", "source", "title", "created_at")
    return silver.latest(rows)


@query("signal_id_md5", f"""WITH {SIGNALS} SELECT signal_id, source, url FROM signals""")
def signal_id_md5(spark, folder):
    return s.signals(spark, folder).select("signal_id", "source", "url")


@query("date_range_filter", f"""WITH {SIGNALS}
SELECT signal_id, created_at::DATE AS date FROM signals
WHERE created_at::DATE BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'""")
def date_range_filter(spark, folder):
    rows = gold.in_range(s.signals(spark, folder), "2024-01-08", "2024-01-14")
    return rows.select("signal_id", "date")


@query("dedup_best_score", """
SELECT user_id, event_id, value, ts::TIMESTAMP AS ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, ts DESC, event_id) = 1""")
def dedup_best_score(spark, folder):
    """Best event of each user; users have many events, some of them most."""
    rows = table(spark, folder, "events").select("user_id", "event_id", "value", "ts")
    return keep_best(rows, ["user_id"], "value", "ts", ["event_id"])


@query("dedup_latest", """
SELECT event_type, event_id, ts::TIMESTAMP AS ts FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) = 1""")
def dedup_latest(spark, folder):
    """Newest event of each type: five keys for the whole table."""
    rows = table(spark, folder, "events").select("event_type", "event_id", "ts")
    return keep_latest(rows, ["event_type"], "ts", ["event_id"])
