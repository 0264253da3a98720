"""The ten reports, the report filter and the run summary."""

from pyspark.sql import functions as F

from contract import query
from contract.gold import dated
from contract.quality import log as quality_log_rows
from contract.quality import LOG as QUALITY_LOG
from contract.sql import (
    ENRICHED,
    SIGNALS,
    SUMMARY,
    TERM_COUNTS,
    TERM_FREQUENCY,
    TRENDING,
    VELOCITY,
    rounded,
)
from trendmill.plans import analytics, gold
from trendmill.sources import standins as s
from trendmill.sources.catalog import row_counts
from trendmill.sources.standins import table


def enriched(spark, folder):
    return s.enriched(table(spark, folder, "labels"))


@query("q01_trending", f"""WITH {TRENDING}
SELECT rank_in_source AS rank, source, title, score AS raw_score,
  {rounded('composite_score', 2)} AS composite_score, url
FROM (SELECT * FROM trending WHERE date >= DATE '2024-02-01' - 7
      ORDER BY composite_score DESC, signal_id LIMIT 20)""")
def q01_trending(spark, folder):
    """Days are ranked by themselves, so only those of the past week are built."""
    recent = dated(spark, folder, first="2024-01-25")
    return analytics.trending(gold.trending_signals(recent, s.AS_OF), s.AS_OF)


@query("q02_accelerating", f"""WITH {VELOCITY}
SELECT term, this_week_count, last_week_count, {rounded('velocity', 2)} AS velocity,
  'ACCELERATING' AS status
FROM (SELECT * FROM tech_velocity WHERE velocity > 0.2 AND this_week_count >= 3
      ORDER BY velocity DESC, term, week_start LIMIT 15)""")
def q02_accelerating(spark, folder):
    return analytics.accelerating(gold.tech_velocity(dated(spark, folder)))


@query("q03_source_activity", f"""WITH {SUMMARY}
SELECT source, sum(signal_count)::BIGINT AS total_signals,
  {rounded('avg(avg_score::DECIMAL(18, 2))', 1)} AS avg_score, max(max_score) AS peak_score,
  sum(unique_authors)::BIGINT AS total_authors
FROM summary WHERE date >= DATE '2024-02-01' - 30 GROUP BY source""")
def q03_source_activity(spark, folder):
    return analytics.source_activity(gold.daily_figures(dated(spark, folder)), s.AS_OF)


@query("q04_daily_volume", f"""WITH {SUMMARY}
SELECT date, source, signal_count FROM summary WHERE date >= DATE '2024-02-01' - 30""")
def q04_daily_volume(spark, folder):
    return analytics.daily_volume(gold.daily_counts(dated(spark, folder)), s.AS_OF)


@query("q05_top_terms", f"""WITH {TERM_FREQUENCY}
SELECT source, term, frequency, rank_in_source FROM term_frequency
WHERE rank_in_source <= 10 AND date = (SELECT max(date) FROM term_frequency)""")
def q05_top_terms(spark, folder):
    return analytics.top_terms(gold.newest_top_terms(dated(spark, folder), 10))


@query("q06_overlap", f"""WITH {TERM_COUNTS}
SELECT term, count(DISTINCT source) AS source_count, sum(frequency)::BIGINT AS total_mentions,
  list_sort(list(DISTINCT source)) AS sources
FROM term_counts WHERE date >= DATE '2024-02-01' - 7
GROUP BY term HAVING count(DISTINCT source) >= 3
ORDER BY total_mentions DESC, term LIMIT 20""")
def q06_overlap(spark, folder):
    return analytics.term_overlap(gold.term_counts(dated(spark, folder)), s.AS_OF)


@query("q07_emerging", f"""WITH {SIGNALS}, {ENRICHED}
SELECT category, signal_id, title, count(*) OVER (PARTITION BY category) AS emerging_count
FROM enriched JOIN signals USING (signal_id)
WHERE is_emerging AND enriched_at >= DATE '2024-02-01' - 7""")
def q07_emerging(spark, folder):
    return analytics.emerging_radar(enriched(spark, folder), s.signals(spark, folder), s.AS_OF)


@query("q08_sentiment", f"""WITH {SIGNALS}, {ENRICHED}
SELECT source, sentiment, n AS signal_count,
  {rounded('n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY source)', 1)} AS pct
FROM (SELECT source, sentiment, count(*) AS n FROM enriched JOIN signals USING (signal_id)
      WHERE category <> 'error' GROUP BY source, sentiment)""")
def q08_sentiment(spark, folder):
    return analytics.sentiment_share(enriched(spark, folder), s.signals(spark, folder))


@query("q09_authors", f"""WITH {SIGNALS}
SELECT author, count(*) AS signal_count, {rounded('avg(score)', 1)} AS avg_score,
  list_sort(list(DISTINCT source)) AS active_sources, max(created_at) AS latest_signal
FROM signals WHERE author IS NOT NULL AND author NOT IN ('anonymous', 'unknown')
GROUP BY author HAVING count(*) >= 3 ORDER BY avg_score DESC, author LIMIT 20""")
def q09_authors(spark, folder):
    return analytics.author_leaderboard(s.signals(spark, folder))


@query("q10_quality", f"""WITH {QUALITY_LOG}
SELECT source, checked_at::DATE AS check_date, sum(total_rows)::BIGINT AS total_rows,
  sum(duplicate_count)::BIGINT AS total_duplicates,
  {rounded('avg(freshness_hours::DECIMAL(18, 2))', 1)} AS avg_freshness_hours,
  count(*) FILTER (quality_passed) AS checks_passed, count(*) AS total_checks
FROM quality_log WHERE checked_at >= DATE '2024-02-01' - 7 GROUP BY ALL""")
def q10_quality(spark, folder):
    return analytics.quality_dashboard(quality_log_rows(spark, folder), s.AS_OF)


@query("source_filter", f"""WITH {SUMMARY}
SELECT date, source, signal_count FROM summary
WHERE date >= DATE '2024-02-01' - 30 AND source = 'documents'""")
def source_filter(spark, folder):
    counts = gold.daily_counts(dated(spark, folder))
    return analytics.daily_volume(counts, s.AS_OF, source="documents")


@query("category_histogram", f"""WITH {ENRICHED}
SELECT category, count(*) AS count FROM enriched GROUP BY category""")
def category_histogram(spark, folder):
    return analytics.category_histogram(enriched(spark, folder))


@query("latest_enriched", f"""WITH {ENRICHED}
SELECT * FROM enriched ORDER BY enriched_at DESC, signal_id LIMIT 10""")
def latest_enriched(spark, folder):
    return analytics.latest_enriched(enriched(spark, folder))


_STATUS = "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'SKIPPED' ELSE 'SUCCESS' END"


def run_log(spark, folder):
    """Events read as the steps of a run, documents as the texts of their results."""
    kind = F.col("event_type")
    steps = table(spark, folder, "events").select(
        F.concat_ws(" ", kind, "event_id").alias("step"),
        F.when(kind == "error", "FAILED").when(kind == "view", "SKIPPED").otherwise("SUCCESS")
        .alias("status"),
        F.col("props").alias("result"), F.col("value").alias("duration"),
    )
    notes = table(spark, folder, "documents").select(
        F.concat_ws(" ", F.lit("document"), "doc_id").alias("step"),
        F.lit("SUCCESS").alias("status"), F.col("text").alias("result"),
        (F.col("n_chars") / 4).alias("duration"),
    )
    return steps.unionByName(notes)


@query("run_log_summary", f"""
SELECT event_type || ' ' || event_id AS step, {_STATUS} AS status, props AS result,
  {rounded('value', 1)} AS duration_sec FROM events
UNION ALL SELECT 'document ' || doc_id, 'SUCCESS', text,
  {rounded('n_chars / 4.0', 1)} FROM documents""")
def run_log_summary(spark, folder):
    return analytics.run_report(run_log(spark, folder))


@query("run_log_totals", f"""
SELECT count(*) AS total_steps, count(*) FILTER (status = 'SUCCESS') AS successful,
  count(*) FILTER (status = 'FAILED') AS failed, count(*) FILTER (status = 'SKIPPED') AS skipped,
  {rounded('sum(duration::DECIMAL(18, 3))', 1)} AS total_duration
FROM (SELECT {_STATUS} AS status, value AS duration FROM events
      UNION ALL SELECT 'SUCCESS', n_chars / 4.0::DOUBLE FROM documents)""")
def run_log_totals(spark, folder):
    return analytics.run_totals(run_log(spark, folder))


_TABLES = ["customer", "orders", "lineitem", "part", "supplier", "nation", "region", "events",
           "documents", "pages", "conversations", "labels", "benchmark", "embeddings"]


@query("table_row_counts", " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", count(*) AS row_count FROM {name}" for name in _TABLES
) + " UNION ALL SELECT 'not built yet', -1")
def table_row_counts(spark, folder):
    named = {name: table(spark, folder, name) for name in _TABLES}
    return row_counts(spark, {**named, "not built yet": None})
