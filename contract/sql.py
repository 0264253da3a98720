"""SQL building blocks of the oracles, written independently of the Spark code."""

SPREAD = "TIMESTAMP '2024-01-01' + to_days(({id} % 30)::INT)"
_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
_HOST = "regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)"
_LANG = "regexp_extract(html, '<html[^>]*lang=\"([^\"]*)\"', 1)"
PAGE = {"title": _TITLE, "host": _HOST, "lang": _LANG}
SECONDS = "date_diff('second', TIMESTAMP '1970-01-01', {ts})"
SPACE = "[ \\t\\n\\x0B\\f\\r]+"


def spread(id_column):
    return SPREAD.format(id=id_column)


def seconds(ts):
    return SECONDS.format(ts=ts)


def rounded(value, digits):
    """Half-up rounding of the decimal form, as Spark rounds doubles."""
    return f"CAST(round(CAST({value} AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"


def iso(ts):
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"


SIGNALS = f"""signals AS (
  SELECT md5('events' || event_id) AS signal_id, 'events' AS source, event_type AS title,
    props AS body, 'event://' || event_id AS url, user_id::VARCHAR AS author,
    floor(value)::INT AS score, ts::TIMESTAMP AS created_at,
    [event_type, 'k' || regexp_extract(props, '"k": *([0-9]+)', 1)] AS tags,
    NULL::VARCHAR AS language
  FROM events
  UNION ALL
  SELECT md5('documents' || doc_id), 'documents', text, text, 'doc://' || doc_id, source,
    n_chars::INT, {spread('doc_id')}, [lang, source], lang
  FROM documents
  UNION ALL
  SELECT md5('pages' || page_id), 'pages', {_TITLE}, regexp_replace(html, '<[^>]+>', ' ', 'g'),
    url, {_HOST}, 0, {spread('page_id')}, [{_LANG}], {_LANG}
  FROM pages
  UNION ALL
  SELECT md5('conversations' || conv_id || ':' || turn), 'conversations', text, text,
    'conv://' || conv_id || ':' || turn, role, turn::INT, {spread('conv_id')},
    []::VARCHAR[], NULL
  FROM conversations
)"""

DATED = f"""{SIGNALS}, dated AS (
  SELECT *, created_at::DATE AS date FROM signals
  WHERE created_at::DATE BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
)"""

# --- fixed values: words never counted as title terms ---
STOP_WORDS = """'that','this','with','from','what','have','your','will',
'about','they','been','more','when','than','just','like',
'does','into','some','only','other','also','there','which'"""

TITLE_WORDS = f"""title_words AS (
  SELECT source, date, regexp_replace(word, '[^a-z0-9+#]', '', 'g') AS term
  FROM (
    SELECT source, date, unnest(string_split_regex(lower(title), '{SPACE}')) AS word FROM dated
  ) WHERE length(word) >= 4
)"""

TAG_WORDS = """tag_words AS (
  SELECT source, date, lower(trim(tag, ' ')) AS term
  FROM (SELECT source, date, unnest(tags) AS tag FROM dated) WHERE length(tag) > 1
)"""

TERM_COUNTS = f"""{DATED}, {TITLE_WORDS}, {TAG_WORDS}, term_counts AS (
  SELECT term, source, date, count(*) AS frequency FROM (
    SELECT * FROM tag_words
    UNION ALL
    SELECT * FROM title_words WHERE length(term) >= 3 AND term NOT IN ({STOP_WORDS})
  ) GROUP BY term, source, date
)"""

TERM_FREQUENCY = f"""{TERM_COUNTS}, term_frequency AS (
  SELECT *, row_number() OVER (
    PARTITION BY source, date ORDER BY frequency DESC, term)::INT AS rank_in_source
  FROM term_counts
)"""

COMPOSITE = """score * ln(2.0 + len(tags))
    * (1.0::DOUBLE / (1.0::DOUBLE
       + greatest(date_diff('day', created_at::DATE, DATE '2024-02-01'), 0)))"""

TRENDING = f"""{DATED}, trending AS (
  SELECT * FROM (
    SELECT signal_id, source, title, url, score, composite_score, row_number() OVER (
        PARTITION BY source, date ORDER BY composite_score DESC, signal_id)::INT AS rank_in_source,
      date, tags
    FROM (SELECT *, {COMPOSITE} AS composite_score FROM dated)
  ) WHERE rank_in_source <= 50
)"""

SUMMARY = f"""{DATED}, tag_counts AS (
  SELECT source, date, tag, count(*) AS n
  FROM (SELECT source, date, unnest(tags) AS tag FROM dated) GROUP BY ALL
), top_tags AS (
  SELECT source, date, tag AS top_tag FROM tag_counts
  QUALIFY row_number() OVER (PARTITION BY source, date ORDER BY n DESC, tag) = 1
), summary AS (
  SELECT source, date, signal_count, {rounded('avg_score', 2)} AS avg_score, max_score,
    unique_authors, {rounded('avg_length', 1)} AS avg_body_length, top_tag
  FROM (
    SELECT source, date, count(*) AS signal_count, avg(score) AS avg_score,
      max(score) AS max_score, count(DISTINCT author) AS unique_authors,
      avg(length(body)) AS avg_length
    FROM dated GROUP BY source, date
  ) LEFT JOIN top_tags USING (source, date)
)"""

VELOCITY = f"""{DATED}, {TAG_WORDS}, weekly AS (
  SELECT term, date_trunc('week', date)::DATE AS week_start, count(*) AS this_week_count
  FROM tag_words GROUP BY ALL
), tech_velocity AS (
  SELECT a.term, a.week_start, a.this_week_count,
    coalesce(b.this_week_count, 0) AS last_week_count,
    (a.this_week_count - coalesce(b.this_week_count, 0))::DOUBLE
      / greatest(coalesce(b.this_week_count, 0), 1) AS velocity
  FROM weekly a LEFT JOIN weekly b ON a.term = b.term AND a.week_start = b.week_start + 7
)"""

# The categories are fixed values of the taxonomy.
ENRICHED = f"""enriched AS (
  SELECT md5('documents' || doc_id) AS signal_id,
    CASE WHEN doc_id % 17 = 0 THEN 'error'
      ELSE ['AI/ML', 'Data Engineering', 'Cloud', 'DevOps', 'Web', 'Systems', 'Security',
            'Other'][(doc_id % 8 + 1)::INT] END AS category,
    'Summary of document ' || doc_id AS summary,
    CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive'
      ELSE 'neutral' END AS sentiment,
    quality = 1 AND doc_id % 17 <> 0 AS is_emerging,
    'labels' AS model_used,
    {spread('doc_id')} AS enriched_at
  FROM labels
)"""
