"""Landed feeds, dedup across searches, incremental pulls, bronze append."""

from pyspark.sql import functions as F

from contract import query
from contract.sql import PAGE, SPACE, iso, seconds, spread
from trendmill import constants as c
from trendmill import schemas
from trendmill.functions.scalars import ntz
from trendmill.session import work_path
from trendmill.sources import feeds, landing, payload
from trendmill.sources import standins as s
from trendmill.sources.standins import table

_STORY_SQL = f"""SELECT event_id AS id, user_id::VARCHAR AS "by", event_type AS title,
  CASE WHEN event_type <> 'view' THEN 'event://' || event_id END AS url,
  floor(value)::INT AS score, {seconds('ts')} AS time, 'story' AS type,
  length(props)::INT AS descendants,
  CASE WHEN event_type <> 'signup' THEN '[' || event_id || ',' || user_id || ']' END AS kids,
  props AS text
FROM events WHERE event_type <> 'error'"""


def stories(spark, folder):
    return feeds.stories(s.story_records(table(spark, folder, "events")))


def repos(spark, folder):
    return feeds.repos(s.repo_records(s.table(spark, folder, "documents")))


def questions(spark, folder):
    return feeds.questions(s.question_records(s.table(spark, folder, "pages")))


def papers(spark, folder):
    return feeds.papers(s.document_entries(s.table(spark, folder, "documents")))


@query("bronze_stories", _STORY_SQL)
def bronze_stories(spark, folder):
    return stories(spark, folder).drop("_raw_json")


@query("bronze_repos", f"""
SELECT doc_id AS id, text AS name, source || '/' || doc_id AS full_name, text AS description,
  'doc://' || doc_id AS html_url, n_chars::INT AS stargazers_count,
  length(source)::INT AS forks_count, lang AS language,
  {iso(spread('doc_id'))} AS created_at, {iso(spread('doc_id'))} AS updated_at,
  {iso(spread('doc_id') + ' + INTERVAL 1 DAY')} AS pushed_at, source AS owner_login,
  CASE WHEN lang <> 'es' THEN '["' || lang || '","' || source || '"]' ELSE '[]' END AS topics,
  length(lang)::INT AS open_issues_count,
  CASE WHEN lang <> 'de' THEN n_chars / 2.0::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM documents""")
def bronze_repos(spark, folder):
    return repos(spark, folder).drop("_raw_json")


PAPERS_SQL = f"""
SELECT doc_id::VARCHAR AS arxiv_id, trim(regexp_replace(text, '{SPACE}', ' ', 'g'), ' ') AS title,
  trim(regexp_replace(text, '{SPACE}', ' ', 'g'), ' ') AS summary,
  '["' || source || '","co-' || source || '"]' AS authors,
  {iso(spread('doc_id'))} AS published, {iso(spread('doc_id'))} AS updated,
  '["' || lang || '"]' AS categories, 'doc://' || doc_id AS link
FROM documents"""


@query("bronze_papers_xml", PAPERS_SQL)
def bronze_papers_xml(spark, folder):
    return papers(spark, folder).drop("_raw_json")


@query("bronze_questions", f"""
SELECT page_id AS question_id, {PAGE['title']} AS title, html AS body,
  CASE WHEN url LIKE 'https%' THEN '["' || {PAGE['lang']} || '"]' ELSE '[]' END AS tags,
  length(url)::INT AS score, length(html)::INT AS view_count,
  length({PAGE['host']})::INT AS answer_count, url LIKE 'https%' AS is_answered,
  {seconds(spread('page_id'))} AS creation_date, url AS link,
  CASE WHEN url LIKE 'https%' THEN {PAGE['host']} END AS owner_display_name,
  CASE WHEN url LIKE 'https%' THEN length({PAGE['host']})::INT END AS owner_reputation
FROM pages""")
def bronze_questions(spark, folder):
    return questions(spark, folder).drop("_raw_json")


@query("bronze_raw_json", f"""
SELECT 'stories' AS feed, event_id::VARCHAR AS native_id, event_type AS raw_title,
  props AS raw_text FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'repos', source || '/' || doc_id, text, text FROM documents
UNION ALL SELECT 'questions', page_id::VARCHAR, {PAGE['title']}, html FROM pages
UNION ALL SELECT 'papers', doc_id::VARCHAR, t, t FROM (
  SELECT doc_id, trim(regexp_replace(text, '{SPACE}', ' ', 'g'), ' ') AS t FROM documents)""")
def bronze_raw_json(spark, folder):
    """The kept payload still holds what the bronze columns were taken from."""

    def raw(frame, feed, native, title, text):
        return frame.select(
            F.lit(feed).alias("feed"),
            F.col(native).cast("string").alias("native_id"),
            F.get_json_object("_raw_json", f"$.{title}").alias("raw_title"),
            F.get_json_object("_raw_json", f"$.{text}").alias("raw_text"),
        )

    return (
        raw(stories(spark, folder), "stories", "id", "title", "text")
        .unionByName(raw(repos(spark, folder), "repos", "full_name", "name", "description"))
        .unionByName(raw(questions(spark, folder), "questions", "question_id", "title", "body"))
        .unionByName(raw(papers(spark, folder), "papers", "arxiv_id", "title", "summary"))
    )


def _stories_of_two_versions(spark, folder):
    """Bronze stories of two batches; the payloads of the later one hold more than the columns."""
    path, events = work_path(spark, "bronze-versions"), table(spark, folder, "events")
    landing.append_bronze(feeds.stories(s.story_records(events)), path, c.STORIES, "b1", ntz("2024-01-31"))
    later = feeds.stories(s.story_records_with_extra(events))
    landing.append_bronze(later, path, c.STORIES, "b2", ntz("2024-02-01"))
    return landing.read_bronze(spark, path)


@query("raw_variant_paths", """
WITH e AS (SELECT * FROM events WHERE event_type <> 'error'),
found AS (
  SELECT '$' AS path, 'OBJECT' AS type, 2 * count(*) AS count FROM e
  UNION ALL SELECT '$.id', 'BIGINT', 2 * count(event_id) FROM e
  UNION ALL SELECT '$.by', 'STRING', 2 * count(user_id) FROM e
  UNION ALL SELECT '$.title', 'STRING', 2 * count(event_type) FROM e
  UNION ALL SELECT '$.url', 'STRING', 2 * count(event_id) FILTER (event_type <> 'view') FROM e
  UNION ALL SELECT '$.score', 'BIGINT', 2 * count(value) FROM e
  UNION ALL SELECT '$.time', 'BIGINT', 2 * count(ts) FROM e
  UNION ALL SELECT '$.type', 'STRING', 2 * count(*) FROM e
  UNION ALL SELECT '$.descendants', 'BIGINT', 2 * count(props) FROM e
  UNION ALL SELECT '$.text', 'STRING', 2 * count(props) FROM e
  UNION ALL SELECT '$.kids', 'ARRAY', 2 * count(*) FROM e
  UNION ALL SELECT '$.kids[]', 'BIGINT', 2 * (count(event_id) + count(user_id)) FROM e WHERE event_type <> 'signup'
  UNION ALL SELECT '$.kids[]', 'VOID', 2 * (2 * count(*) - count(event_id) - count(user_id)) FROM e
    WHERE event_type <> 'signup'
  UNION ALL SELECT '$.extra', 'OBJECT', count(props) FROM e
  UNION ALL SELECT '$.extra', 'VOID', count(*) - count(props) FROM e
  UNION ALL SELECT '$.extra.k', 'BIGINT', count(props) FROM e
)
SELECT path, type, count, NOT starts_with(path, '$.extra') AS in_schema FROM found WHERE count > 0""")
def raw_variant_paths(spark, folder):
    """All paths and types in the stories' payloads, and whether the feed's schema reads them."""
    found = payload.census(_stories_of_two_versions(spark, folder))
    known = sorted(payload.schema_paths(schemas.STORY_RECORD))
    return found.withColumn("in_schema", F.col("path").isin(known))


@query("raw_variant_fields", """
SELECT event_id AS id, b AS _batch_id,
  CASE WHEN b = 'b2' THEN regexp_extract(props, '"k": *([0-9]+)', 1)::BIGINT END AS k
FROM events, (VALUES ('b1'), ('b2')) AS batches(b) WHERE event_type <> 'error'""")
def raw_variant_fields(spark, folder):
    """A field that no column was made for, read from the payloads that were kept."""
    bronze = _stories_of_two_versions(spark, folder)
    return bronze.select("id", "_batch_id", payload.field("$.extra.k", "bigint").alias("k"))


@query("dedup_first_wins", """
SELECT user_id, query_no, event_id FROM (
  SELECT *, CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 ELSE 3 END AS query_no
  FROM events WHERE user_id IS NOT NULL)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY query_no, event_id) = 1""")
def dedup_first_wins(spark, folder):
    """Users found by three searches run one after the other."""
    kind = F.col("event_type")
    hits = table(spark, folder, "events").withColumn(
        "query_no", F.when(kind == "purchase", 1).when(kind == "signup", 2).otherwise(3)
    )
    first = landing.first_occurrence(hits, "user_id", "query_no", "event_id")
    return first.select("user_id", "query_no", "event_id")


@query(
    "incremental_by_id", "SELECT event_id, event_type, value FROM events WHERE event_id > 499"
)
def incremental_by_id(spark, folder):
    """Everything past the mark."""
    rows = landing.newer_ids(table(spark, folder, "events"), "event_id", "499")
    return rows.select("event_id", "event_type", "value")


@query("incremental_by_ts", f"""
SELECT 'papers' AS pull, doc_id AS id FROM documents
  WHERE {iso(spread('doc_id'))} > '2024-01-15T00:00:00Z'
UNION ALL SELECT 'questions', page_id FROM pages
  WHERE {seconds(spread('page_id'))} > 1705276800
UNION ALL SELECT 'unreadable mark', page_id FROM pages
UNION ALL SELECT 'ingested', event_id FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'
UNION ALL SELECT 'reprocess', event_id FROM events""")
def incremental_by_ts(spark, folder):
    events = table(spark, folder, "events")
    papers_in = table(spark, folder, "documents").withColumn(
        "published", s.iso(s.spread_day("doc_id"))
    )
    questions_in = table(spark, folder, "pages").withColumn(
        "creation_date", s.seconds(s.spread_day("page_id"))
    )
    pulls = {
        ("papers", "doc_id"): landing.newer_text(
            papers_in, "published", "2024-01-15T00:00:00Z"
        ),
        ("questions", "page_id"): landing.newer_epoch(questions_in, "creation_date", "1705276800"),
        ("unreadable mark", "page_id"): landing.newer_epoch(questions_in, "creation_date", "soon"),
        ("ingested", "event_id"): landing.newer_ingested(events, "2024-01-20 12:00:00", "ts"),
        ("reprocess", "event_id"): landing.newer_ingested(
            events, "2024-01-20 12:00:00", "ts", reprocess=True
        ),
    }
    parts = [
        rows.select(F.lit(name).alias("pull"), F.col(key).alias("id"))
        for (name, key), rows in pulls.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query("bronze_append_meta", """
SELECT event_id AS id, floor(value)::INT AS score, 'hackernews' AS _source, 'b1' AS _batch_id,
  TIMESTAMP '2024-01-31' AS _ingested_at FROM events WHERE event_type <> 'error'
UNION ALL
SELECT event_id, floor(value)::INT
    + CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 0 ELSE -1 END,
  'hackernews', 'b2', TIMESTAMP '2024-02-01' FROM events WHERE event_type <> 'error'""")
def bronze_append_meta(spark, folder):
    path = work_path(spark, "bronze-stories")
    events = table(spark, folder, "events")
    first, again = s.story_records(events), s.story_records_again(events)
    landing.append_bronze(feeds.stories(first), path, c.STORIES, "b1", ntz("2024-01-31"))
    landing.append_bronze(feeds.stories(again), path, c.STORIES, "b2", ntz("2024-02-01"))
    return landing.read_bronze(spark, path).select(
        "id", "score", "_source", "_batch_id", "_ingested_at"
    )


@query("schema_evolution_append", """
SELECT event_id, event_type, NULL AS props, 'b1' AS _batch_id FROM events
UNION ALL SELECT event_id, event_type, props, 'b2' FROM events""")
def schema_evolution_append(spark, folder):
    """A later batch brings a new column."""
    path = work_path(spark, "bronze-events")
    events = table(spark, folder, "events")
    landing.append_bronze(events.drop("props"), path, "events", "b1", ntz("2024-01-31"))
    landing.append_bronze(events, path, "events", "b2", ntz("2024-02-01"))
    return landing.read_bronze(spark, path).select("event_id", "event_type", "props", "_batch_id")


def _batched_events(spark, folder):
    """Events with ingestion columns, one batch per event type."""
    kind = F.col("event_type")
    stamp = F.col("ts").cast("timestamp_ntz")
    return landing.with_ingestion_columns(
        table(spark, folder, "events"), kind, F.concat(F.lit("batch-"), kind), stamp
    )


@query("high_water_mark", """
SELECT event_type AS source, max(event_id)::VARCHAR AS last_id,
  strftime(max(date_trunc('second', ts)), '%Y-%m-%d %H:%M:%S') AS last_timestamp,
  'batch-' || event_type AS last_batch_id, TIMESTAMP '2024-02-01' AS updated_at
FROM events GROUP BY event_type""")
def high_water_mark(spark, folder):
    rows = _batched_events(spark, folder).withColumn("second", F.date_trunc("second", "ts"))
    rows = rows.withColumn("second", F.col("second").cast("timestamp_ntz"))
    return landing.high_water_mark(rows, "event_id", "second", s.AS_OF)


@query("batch_sample", """
SELECT event_id, event_type, 'batch-click' AS _batch_id FROM events
WHERE event_type = 'click' ORDER BY event_id LIMIT 5""")
def batch_sample(spark, folder):
    rows = landing.batch_sample(_batched_events(spark, folder), "batch-click", "event_id")
    return rows.select("event_id", "event_type", "_batch_id")


@query("batch_id_format", """
SELECT event_id, event_type || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '_'
  || substr(md5(event_type || '|' || event_id), 1, 8) AS batch_id FROM events""")
def batch_id_format(spark, folder):
    made = landing.batch_id(F.col("event_type"), "ts", "event_id")
    return table(spark, folder, "events").select("event_id", made.alias("batch_id"))
