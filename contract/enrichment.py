"""Enrichment of signals."""

import json
from contextlib import suppress

from pyspark.sql import functions as F

from contract import query
from contract.sql import ENRICHED, SIGNALS
from trendmill import constants as c
from trendmill.operators import enrichment, versions
from trendmill.operators.merge import merge_upsert
from trendmill.schemas import ENRICHED as ENRICHED_SCHEMA
from trendmill.session import work_path
from trendmill.sources import standins as s
from trendmill.sources.standins import table

MODEL, RUN_AT = "keywords", "2024-02-01"
RULES = {
    "Web": ["view", "click"],
    "Security": ["error", "signup"],
    "Data Engineering": ["purchase"],
    "Cloud": ["fr", "es"],
    "AI/ML": ["src1", "src2", "src3"],
}


def scorer_of_words():
    return enrichment.keyword_scorer(
        RULES, positive=["purchase", "signup"], negative=["error"], emerging=["k1", "k2", "de"]
    )


_TEXT = "lower(concat_ws(' ', title, array_to_string(tags, ' '), body))"


def _has(*words):
    return f"regexp_matches({_TEXT}, '\\b(?:{'|'.join(words)})\\b')"


_CASES = " ".join(f"WHEN {_has(*words)} THEN '{name}'" for name, words in RULES.items())
SCORED = f"""scored AS (
  SELECT signal_id, CASE {_CASES} ELSE 'Other' END AS category, title AS summary,
    CASE WHEN {_has('purchase', 'signup')} THEN 'positive' WHEN {_has('error')} THEN 'negative'
      ELSE 'neutral' END AS sentiment,
    {_has('k1', 'k2', 'de')} AS is_emerging, '{MODEL}' AS model_used,
    TIMESTAMP '{RUN_AT}' AS enriched_at
  FROM signals
)"""

CANDIDATES = f"""{SIGNALS}, {ENRICHED}, candidates AS (
  SELECT * FROM signals WHERE signal_id NOT IN (SELECT signal_id FROM enriched)
)"""


def enriched(spark, folder):
    return s.enriched(table(spark, folder, "labels"))


@query("enrich_candidates", f"""WITH {CANDIDATES}
SELECT signal_id, title, body, source, tags FROM candidates""")
def enrich_candidates(spark, folder):
    return enrichment.candidates(s.signals(spark, folder), enriched(spark, folder))


@query("enrich_prompt", f"""WITH {SIGNALS}
SELECT signal_id, 'Analyse this tech signal:' || chr(10) || 'Source: ' || source || chr(10)
  || 'Title: ' || title || chr(10) || 'Tags: ' || array_to_string(tags, ', ') || chr(10)
  || 'Body: ' || coalesce(body, '') || chr(10) || chr(10)
  || 'Respond with JSON: {{"category": "...", "summary": "...", "sentiment": "...", '
  || '"is_emerging": true/false}}' AS prompt
FROM signals""")
def enrich_prompt(spark, folder):
    return s.signals(spark, folder).select("signal_id", enrichment.prompt().alias("prompt"))


@query("enrich_batches", f"""WITH {SIGNALS}
SELECT batch, count(*) AS signals, min(signal_id) AS first_id FROM (
  SELECT signal_id, (CAST('0x' || substr(signal_id, 1, 8) AS BIGINT) % 50)::INT AS batch
  FROM signals) GROUP BY batch""")
def enrich_batches(spark, folder):
    numbered = s.signals(spark, folder).select(
        "signal_id", enrichment.batch_number(50).alias("batch")
    )
    return numbered.groupBy("batch").agg(
        F.count(F.lit(1)).alias("signals"), F.min("signal_id").alias("first_id")
    )


_PARSED_CASE = "CASE WHEN doc_id % 19 = 0 THEN {bad} ELSE {good} END"


def _unless_cut(good, bad="NULL"):
    return _PARSED_CASE.format(good=good, bad=bad)


_RESPONSES = f"""{ENRICHED}, answered AS (
  SELECT e.*, l.doc_id FROM enriched e JOIN labels l ON e.signal_id = md5('documents' || l.doc_id)
)"""


@query("enrich_parse", f"""WITH {_RESPONSES}
SELECT signal_id, doc_id % 19 <> 0 AS usable, {_unless_cut('category')} AS category,
  {_unless_cut('summary')} AS summary, {_unless_cut('sentiment')} AS sentiment,
  {_unless_cut("CASE WHEN is_emerging THEN 'true' ELSE 'false' END")} AS is_emerging
FROM answered""")
def enrich_parse(spark, folder):
    rows = s.responses(table(spark, folder, "labels"))
    parsed = rows.select("signal_id", enrichment.parse("response").alias("p"))
    return parsed.select(
        "signal_id", F.col("p").isNotNull().alias("usable"), "p.category", "p.summary",
        "p.sentiment", "p.is_emerging",
    )


@query("enrich_validate", """
SELECT md5('documents' || doc_id) AS signal_id,
  CASE lang WHEN 'en' THEN 'AI/ML' WHEN 'fr' THEN 'Cloud' ELSE 'Other' END AS category,
  CASE lang WHEN 'en' THEN '' ELSE text END AS summary,
  CASE lang WHEN 'de' THEN 'negative' WHEN 'fr' THEN 'positive' ELSE 'neutral' END AS sentiment,
  lang = 'en' AS is_emerging FROM documents""")
def enrich_validate(spark, folder):
    """Answers outside the taxonomy, with missing fields and with truth values of all kinds."""
    lang = F.col("lang")
    answer = F.struct(
        F.when(lang == "en", "AI/ML").when(lang == "fr", "Cloud").when(lang == "es", "Cooking")
        .alias("category"),
        F.when(lang != "en", F.col("text")).alias("summary"),
        F.when(lang == "de", "negative").when(lang == "fr", "positive").when(lang == "es", "angry")
        .alias("sentiment"),
        F.when(lang == "en", "true").when(lang == "fr", "false").when(lang == "es", "maybe")
        .alias("is_emerging"),
    )
    rows = table(spark, folder, "documents").select(
        F.md5(F.concat(F.lit("documents"), F.col("doc_id").cast("string"))).alias("signal_id"),
        enrichment.validated(answer).alias("v"),
    )
    return rows.select("signal_id", "v.*")


@query("enrich_default", f"""WITH {_RESPONSES}
SELECT signal_id,
  {_unless_cut("CASE WHEN category = 'error' THEN 'Other' ELSE category END", "'error'")}
    AS category,
  {_unless_cut('summary', "'Enrichment failed — retry later'")} AS summary,
  {_unless_cut('sentiment', "'neutral'")} AS sentiment,
  {_unless_cut('is_emerging', 'false')} AS is_emerging,
  'model-a' AS model_used, TIMESTAMP '2024-02-01' AS enriched_at
FROM answered""")
def enrich_default(spark, folder):
    rows = s.responses(table(spark, folder, "labels"))
    return enrichment.enrich_responses(rows, "model-a", RUN_AT)


@query("enrich_apply", f"WITH {SIGNALS}, {SCORED} SELECT * FROM scored")
def enrich_apply(spark, folder):
    return enrichment.apply_scorer(s.signals(spark, folder), scorer_of_words(), MODEL, RUN_AT)


@query("enrich_python", f"""WITH {SIGNALS}
SELECT signal_id, CASE WHEN source = 'pages' THEN 'Web' ELSE 'Other' END AS category,
  source AS summary, 'neutral' AS sentiment, length(title) > 40 AS is_emerging,
  'python' AS model_used, TIMESTAMP '{RUN_AT}' AS enriched_at FROM signals""")
def enrich_python(spark, folder):
    """A scorer that is a Python function, asked for a batch of signals at a time."""

    @enrichment.scorer_columns("source", "title")
    def scorer(batch):
        assert len(batch) <= c.ENRICH_BATCH_SIZE
        return [
            json.dumps({
                "category": "Web" if source == "pages" else "Other", "summary": source,
                "sentiment": "neutral", "is_emerging": len(title) > 40,
            })
            for source, title in zip(batch["source"], batch["title"])
        ]

    return enrichment.apply_scorer(s.signals(spark, folder), scorer, "python", RUN_AT)


@query("enrich_resume", f"""WITH {CANDIDATES}, {SCORED}
SELECT * FROM enriched
UNION ALL SELECT scored.* FROM scored JOIN candidates USING (signal_id)""")
def enrich_resume(spark, folder):
    """Every missing signal in batches; the first run breaks off and a second one goes on."""
    signals, before = s.signals(spark, folder), enriched(spark, folder)
    log_path = work_path(spark, "enriched-log")

    def run(clock):
        done = before
        if versions.last_version(spark, log_path, ENRICHED_SCHEMA):
            log = versions.read_log(spark, log_path, ENRICHED_SCHEMA)
            done = merge_upsert(before, versions.as_of(log, ["signal_id"]), ["signal_id"])
        keys = enrichment.candidate_keys(signals, done)
        enrichment.commit_in_batches(spark, keys, log_path, scorer_of_words(), MODEL, clock, 4, signals)

    stops = iter([RUN_AT, RUN_AT])
    with suppress(StopIteration):
        run(lambda: next(stops))
    run(lambda: RUN_AT)
    log = versions.read_log(spark, log_path, ENRICHED_SCHEMA)
    return merge_upsert(before, versions.as_of(log, ["signal_id"]), ["signal_id"])
