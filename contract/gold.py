"""Gold tables."""

from pyspark.sql import functions as F

from contract import query
from contract.sql import (
    COMPOSITE,
    DATED,
    SIGNALS,
    STOP_WORDS,
    SUMMARY,
    TERM_FREQUENCY,
    TITLE_WORDS,
    TRENDING,
    VELOCITY,
)
from trendmill.functions.scoring import composite_score as score_of
from trendmill.functions.terms import all_terms
from trendmill.plans import gold
from trendmill.sources import standins as s


def dated(spark, folder, first=s.FIRST_DAY):
    return gold.in_range(s.signals(spark, folder), first, s.LAST_DAY)


@query("term_frequency", f"WITH {TERM_FREQUENCY} SELECT * FROM term_frequency")
def term_frequency(spark, folder):
    return gold.term_frequency(dated(spark, folder))


@query("title_tokens", f"""WITH {DATED}, {TITLE_WORDS}
SELECT source, term, count(*) AS mentions FROM title_words
WHERE length(term) >= 3 AND term NOT IN ({STOP_WORDS}) GROUP BY source, term""")
def title_tokens(spark, folder):
    """Title words alone."""
    rows = dated(spark, folder).withColumn("tags", F.array().cast("array<string>"))
    terms = all_terms(rows, "source")
    return terms.groupBy("source", "term").agg(F.count(F.lit(1)).alias("mentions"))


@query("composite_score", f"""WITH {SIGNALS}
SELECT signal_id, {COMPOSITE} AS composite_score FROM signals""")
def composite_score(spark, folder):
    value = score_of("score", "tags", "created_at", s.AS_OF)
    return s.signals(spark, folder).select("signal_id", value.alias("composite_score"))


@query("trending_signals", f"WITH {TRENDING} SELECT * FROM trending")
def trending_signals(spark, folder):
    return gold.trending_signals(dated(spark, folder), s.AS_OF)


@query("top_tag_mode", f"WITH {SUMMARY} SELECT * FROM top_tags")
def top_tag_mode(spark, folder):
    return gold.top_tags(dated(spark, folder))


@query("source_summary", f"WITH {SUMMARY} SELECT * FROM summary")
def source_summary(spark, folder):
    return gold.source_summary(dated(spark, folder))


@query("tech_velocity", f"""WITH {VELOCITY}
SELECT *, velocity > 0.2 AS is_accelerating FROM tech_velocity""")
def tech_velocity(spark, folder):
    return gold.tech_velocity(dated(spark, folder))
