"""Rejects, id ranges, signed changes, remembered answers and sketches."""

import json

from pyspark.sql import functions as F

from contract import query
from contract.enrichment import RUN_AT
from contract.quality import CHECKED, checked
from contract.sql import DATED, SIGNALS, STOP_WORDS, TAG_WORDS, TITLE_WORDS
from trendmill.operators import enrichment, intervals, memo, rejects
from trendmill.plans import gold, refresh, upkeep
from trendmill.session import work_path
from trendmill.sources import standins as s
from trendmill.sources.standins import table


@query("silver_rejects", f"""WITH {CHECKED}
SELECT signal_id, source, title IS NULL OR url IS NULL OR length(title) > 5000 AS rejected,
  concat_ws(',', CASE WHEN title IS NULL THEN 'null:title' END, CASE WHEN url IS NULL THEN 'null:url' END,
    CASE WHEN length(title) > 5000 THEN 'long title' END) AS reasons
FROM checked""")
def silver_rejects(spark, folder):
    """Good and rejected rows, split and written in one pass."""
    rules = rejects.null_rules(["signal_id", "title", "url"]) | {"long title": F.length("title") > 5000}
    good, bad, _ = rejects.split(checked(spark, folder), rules)
    kept = good.select("signal_id", "source", F.lit(False).alias("rejected"), F.lit("").alias("reasons"))
    return kept.unionAll(bad.select(
        "signal_id", "source", F.lit(True).alias("rejected"), F.array_join(rejects.REASONS, ",").alias("reasons")
    ))


@query("id_gaps", """
WITH pulled AS (
  SELECT DISTINCT event_id FROM events WHERE event_id % 11 <> 3 AND event_id % 1000 NOT BETWEEN 400 AND 450
), islands AS (
  SELECT min(event_id) AS low, max(event_id) AS high
  FROM (SELECT event_id, event_id - row_number() OVER (ORDER BY event_id) AS run FROM pulled) GROUP BY run
), gaps AS (SELECT high + 1 AS low, lead(low) OVER (ORDER BY low) - 1 AS high FROM islands)
SELECT 'pulled' AS kind, low, high, high - low + 1 AS ids FROM islands
UNION ALL SELECT 'skipped', low, high, high - low + 1 FROM gaps WHERE high IS NOT NULL""")
def id_gaps(spark, folder):
    """Ranges of ids that two pulls took, the second added to what the first left, and what they skipped."""
    events = table(spark, folder, "events").where("event_id % 11 <> 3")
    first = events.where("event_id % 1000 < 400")
    second = events.where("event_id % 1000 > 450 or event_id % 1000 < 0")
    seen = intervals.islands(intervals.id_ranges(first, "event_id"))
    seen = intervals.islands(seen.select("low", "high").unionAll(intervals.id_ranges(second, "event_id")))

    def rows(ranges, kind):
        return ranges.select(
            F.lit(kind).alias("kind"), "low", "high", (F.col("high") - F.col("low") + 1).alias("ids")
        )

    return rows(seen, "pulled").unionAll(rows(intervals.gaps(seen), "skipped"))


# Signals whose id begins with 0 to 2 get a longer title and move by a day; those with f are withdrawn.
_REVISED_SQL = f"""{SIGNALS}, dated AS (
  SELECT source, CASE WHEN signal_id < '3' THEN title || ' Revised edition!' ELSE title END AS title, tags,
    CASE WHEN signal_id < '3' THEN created_at::DATE + 1 ELSE created_at::DATE END AS date
  FROM signals WHERE signal_id < 'f'
    AND CASE WHEN signal_id < '3' THEN created_at::DATE + 1 ELSE created_at::DATE END
      BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
), {TITLE_WORDS}, {TAG_WORDS}, term_counts AS (
  SELECT term, source, date, count(*) AS frequency FROM (
    SELECT * FROM tag_words
    UNION ALL SELECT * FROM title_words WHERE length(term) >= 3 AND term NOT IN ({STOP_WORDS})
  ) GROUP BY term, source, date
)"""


@query("term_frequency_delta", f"""WITH {_REVISED_SQL}
SELECT *, row_number() OVER (PARTITION BY source, date ORDER BY frequency DESC, term)::INT AS rank_in_source
FROM term_counts""")
def term_frequency_delta(spark, folder):
    """Stored term frequencies after signals changed, moved to another day or were withdrawn."""
    path = work_path(spark, "term-frequency")
    signals = s.signals(spark, folder).select("signal_id", "source", "title", "created_at", "tags")
    before = gold.in_range(signals, s.FIRST_DAY, s.LAST_DAY)
    stored = gold.term_frequency(before)
    refresh.replace_days(stored, path)
    columns = ["term", "source", "date", "frequency", "rank_in_source"]
    schema = stored.select("term", "source", "frequency", "rank_in_source", "date").schema
    revised = signals.where("signal_id < '3'").withColumns({
        "title": F.concat("title", F.lit(" Revised edition!")),
        "created_at": F.col("created_at") + F.expr("interval 1 day"),
    })
    changes = upkeep.count_changes(
        before.where("signal_id < '3' or signal_id >= 'f'"),
        gold.in_range(revised, s.FIRST_DAY, s.LAST_DAY),
    )
    fresh = upkeep.apply_changes(spark.read.schema(schema).parquet(path), changes)
    refresh.replace_days(fresh, path, span=upkeep.touched_days(changes))
    return spark.read.schema(schema).parquet(path).select(columns)


@query("enrich_memo", f"""WITH {SIGNALS}
SELECT signal_id, CASE WHEN source = 'pages' THEN 'Web' ELSE 'Other' END AS category,
  source || ':' || title AS summary, 'neutral' AS sentiment, length(title) > 40 AS is_emerging,
  'python' AS model_used, TIMESTAMP '{RUN_AT}' AS enriched_at FROM signals""")
def enrich_memo(spark, folder):
    """All signals through a memo: a first run over some of them, a second over all."""

    @enrichment.scorer_columns("source", "title")
    def scorer(batch):
        return [
            json.dumps({
                "category": "Web" if source == "pages" else "Other", "summary": f"{source}:{title}",
                "sentiment": "neutral", "is_emerging": len(title) > 40,
            })
            for source, title in zip(batch["source"], batch["title"])
        ]

    path, signals = work_path(spark, "memo"), s.signals(spark, folder)
    memo.enrich_through_memo(signals.where("signal_id < '8'"), path, scorer, "python", RUN_AT)
    return memo.enrich_through_memo(signals, path, scorer, "python", RUN_AT)


@query("source_authors_sketch", f"""WITH {DATED}
SELECT source, count(DISTINCT author) AS authors, true AS within FROM dated GROUP BY source""")
def source_authors_sketch(spark, folder):
    """Distinct authors of the whole period, and whether merged daily sketches are within 3 % of them."""
    dated = gold.in_range(s.signals(spark, folder), s.FIRST_DAY, s.LAST_DAY)
    guessed = upkeep.authors_over(upkeep.author_sketches(dated)).withColumnRenamed("authors", "_guess")
    exact = dated.groupBy("source").agg(F.countDistinct("author").alias("authors"))
    within = F.abs(F.col("_guess") - F.col("authors")) <= 0.03 * F.col("authors")
    return exact.join(guessed, "source").select("source", "authors", within.alias("within"))
