"""Answers kept by prompt, so that equal prompts are scored once."""

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from trendmill import constants as c
from trendmill.operators.dedup import keep_one
from trendmill.operators.enrichment import apply_scorer, prompt
from trendmill.schemas import ENRICHED
from trendmill.session import read_if_written, written

#: An enrichment row with the digest of its prompt in place of the signal.
MEMO = StructType([
    StructField("digest", StringType()), *[f for f in ENRICHED.fields if f.name != "signal_id"]
])


def read_memo(spark, path):
    """The answers stored at ``path``, one for each prompt, or None."""
    found = read_if_written(lambda p: spark.read.schema(MEMO).parquet(p), path)
    return None if found is None else keep_one(found, ["digest"], [F.col("enriched_at").desc()])


def enrich_through_memo(
    chosen, path, scorer, model, enriched_at, batches=None, retry_errors=False, seen=None
):
    """Enrichment rows of the chosen signals; each distinct prompt without an answer is scored once.

    New answers are added to the memo at ``path`` before any is handed out, so a run that breaks off later
    finds them. The digests of prompts decide; the texts of one signal a prompt go to the scorer.
    With ``retry_errors`` a stored error counts as no answer.
    """
    spark = chosen.sparkSession
    digest = F.sha2(prompt(), 256).alias("digest")
    keyed = written(chosen.select("signal_id", digest), "prompt-digests")
    first = keyed.groupBy("digest").agg(F.min("signal_id").alias("signal_id"))
    memo = read_memo(spark, path)
    if memo is not None:
        known = memo.where(F.col("category") != c.ERROR_CATEGORY) if retry_errors else memo
        first = first.join(known.select("digest"), "digest", "left_anti")
    # Equal prompts of one signal's id may repeat; one row of them is asked about.
    asked = chosen.select("*", digest).join(first, ["signal_id", "digest"], "left_semi").dropDuplicates(["digest"])
    answered = apply_scorer(
        asked.drop("signal_id").withColumnRenamed("digest", "signal_id"),
        scorer, model, enriched_at, batches, seen=seen,
    ).withColumnRenamed("signal_id", "digest")
    answered.select(MEMO.names).write.mode("append").parquet(path)
    return keyed.join(read_memo(spark, path), "digest").select(ENRICHED.names)
