"""Category, summary, sentiment and emerging flag for signals not yet enriched.

Prompts, response parsing, validation and the built-in scorer are column expressions. Only a scorer
that is a Python function runs in Python, on batches of the configured size.
"""

import re
import traceback
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from trendmill import constants as c
from trendmill.functions.scalars import as_column, ntz
from trendmill.operators.merge import merge_upsert
from trendmill.operators.versions import last_version, write_commit
from trendmill.schemas import ENRICHED
from trendmill.session import work_path

_RESPONSE = "category string, summary string, sentiment string, is_emerging string, _bad string"


def candidates(signals, enriched=None, max_signals=None, retry_errors=False):
    """Signals without an enrichment row, all of them while there is no table.

    ``max_signals`` keeps the best-scored ones only. The anti join and the top-k work on id and score
    alone; texts are fetched for the chosen ids (see ``candidate_keys``).
    """
    todo = candidate_keys(signals, enriched, max_signals, retry_errors)
    return signals.join(todo, "signal_id", "left_semi").select(
        "signal_id", "title", "body", "source", "tags"
    )


def candidate_keys(signals, enriched=None, max_signals=None, retry_errors=False):
    """``signal_id`` of the rows of :func:`candidates`, without their texts."""
    todo = signals.select("signal_id", "score")
    if enriched is not None:
        done = enriched.where(F.col("category") != c.ERROR_CATEGORY) if retry_errors else enriched
        todo = todo.join(done.select("signal_id"), "signal_id", "left_anti")
    if max_signals is not None:
        todo = todo.orderBy(F.col("score").desc(), "signal_id").limit(max_signals)
    return todo.select("signal_id")


def prompt(body_chars=None):
    """Prompt text of one signal with its whole body, or ``body_chars`` of it."""
    body = F.coalesce("body", F.lit(""))
    if body_chars is not None:
        body = F.substring(body, 1, body_chars)
    tags = F.coalesce(F.array_join("tags", ", "), F.lit(""))
    title = F.coalesce("title", F.lit("None"))
    return F.format_string(c.PROMPT_FORMAT, F.col("source"), title, tags, body)


def batch_number(batches, key="signal_id"):
    """Batch of a signal, taken from its key and so the same in every run."""
    head = F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(batches)).cast("int")


def unfence(response):
    """Response text without a surrounding Markdown code fence.

    A fenced text loses its first line and everything from the last fence on.
    """
    fenced = r"(?s)^\s*```[^\n]*\n(.*?)(?:```(?!.*```).*)?\z"
    text = F.regexp_replace(as_column(response), fenced, "$1")
    return F.regexp_replace(text, r"^\s+|\s+\z", "")


def parse(response):
    """Struct of the response fields, NULL unless the response is one JSON object."""
    options = {"columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false"}

    def usable(read):
        text, fields = read["text"], read["fields"]
        whole = text.startswith("{") & text.endswith("}") & fields["_bad"].isNull()
        return F.when(whole, fields)

    # Through the lambda the text is cut out and parsed once, however often it is looked at.
    text = F.transform(F.array(unfence(response)), lambda t: F.struct(
        t.alias("text"), F.from_json(t, _RESPONSE, options).alias("fields")
    ))
    return F.get(F.transform(text, usable), F.lit(0))


def validated(parsed):
    """Struct with taxonomy values only; an unusable response gives the error record."""
    category, sentiment = parsed["category"], parsed["sentiment"]
    good = F.struct(
        F.when(category.isin(c.CATEGORIES), category)
        .otherwise(F.lit(c.DEFAULT_CATEGORY))
        .alias("category"),
        F.coalesce(parsed["summary"], F.lit("")).alias("summary"),
        F.when(sentiment.isin(c.SENTIMENTS), sentiment)
        .otherwise(F.lit(c.DEFAULT_SENTIMENT))
        .alias("sentiment"),
        F.coalesce(parsed["is_emerging"].try_cast("boolean"), F.lit(False)).alias("is_emerging"),
    )
    return F.when(parsed.isNotNull(), good).otherwise(error_record())


def error_record():
    """Written for a failed signal, so that it is not tried again by accident."""
    return F.struct(
        F.lit(c.ERROR_CATEGORY).alias("category"),
        F.lit(c.ERROR_SUMMARY).alias("summary"),
        F.lit(c.DEFAULT_SENTIMENT).alias("sentiment"),
        F.lit(False).alias("is_emerging"),
    )


def enrich_responses(responses, model, enriched_at):
    """Enrichment rows from ``signal_id`` and raw ``response``."""
    parsed = responses.select("signal_id", parse("response").alias("_parsed"))
    return _enrichment_rows(parsed, model, enriched_at)


def _enrichment_rows(parsed, model, enriched_at):
    return (
        parsed.select("signal_id", validated(F.col("_parsed")).alias("_v"))
        .select(
            "signal_id",
            "_v.category",
            "_v.summary",
            "_v.sentiment",
            "_v.is_emerging",
            F.lit(model).alias("model_used"),
            ntz(enriched_at).alias("enriched_at"),
        )
    )


def keyword_scorer(rules, positive=(), negative=(), emerging=()):
    """Scorer that needs no network: a struct column from title, tags and body.

    The first category with a matching word wins. Words are taken literally, and match where no
    letter, digit or underscore of ASCII adjoins them.
    """
    text = F.lower(F.concat_ws(" ", "title", F.array_join("tags", " "), "body"))
    every = dict.fromkeys(w for words in (*rules.values(), positive, negative, emerging) for w in words)
    # Words of letters alone never overlap in a text, so one pass finds all that it holds.
    plain = [w for w in every if re.fullmatch(r"\w+", w, re.ASCII)]

    def pattern(words):
        return rf"(?<!\w)(?:{'|'.join(re.escape(w) for w in words)})(?!\w)"

    def answer(read):
        def has(words):
            met = [read["met"][f"w{plain.index(w)}"] for w in words if w in plain]
            odd = [w for w in words if w not in plain]
            if odd:
                met.append(read["text"].rlike(pattern(odd)))
            return reduce(lambda a, b: a | b, met, F.lit(False))

        category = F.lit(c.DEFAULT_CATEGORY)
        for name, words in reversed(rules.items()):
            category = F.when(has(words), F.lit(name)).otherwise(category)
        sentiment = F.when(has(positive), "positive").when(has(negative), "negative")
        return F.struct(
            category.alias("category"),
            F.coalesce("title", F.lit("")).alias("summary"),
            sentiment.otherwise(c.DEFAULT_SENTIMENT).alias("sentiment"),
            has(emerging).cast("string").alias("is_emerging"),
        )

    def found(hits):
        return F.struct(*[F.array_contains(hits, w).alias(f"w{i}") for i, w in enumerate(plain)])

    # Each lambda binds what it is given, so the text is put together and searched once.
    hits = F.transform(F.array(text), lambda t: F.struct(
        t.alias("text"), F.array_distinct(
            F.regexp_extract_all(t, F.lit(pattern(plain)), F.lit(0)) if plain else F.array().cast("array<string>")
        ).alias("hits"),
    ))
    met = F.transform(hits, lambda r: F.struct(r["text"].alias("text"), (
        found(r["hits"]) if plain else F.struct(F.lit(False).alias("none"))
    ).alias("met")))
    return F.get(F.transform(met, answer), F.lit(0))


def scorer_columns(*names):
    """Declares which of source, title, body, tags and prompt a Python scorer reads."""

    def declare(scorer):
        scorer.columns = names
        return scorer

    return declare


def apply_scorer(
    chosen, scorer, model, enriched_at, batches=None, batch_rows=c.ENRICH_BATCH_SIZE, seen=None
):
    """Enrichment rows of the chosen signals.

    ``scorer`` is a struct column as of :func:`keyword_scorer`, or a function that maps a pandas frame of
    ``batch_rows`` signals at most (the columns declared by :func:`scorer_columns`, or all of them) to
    one response text per row. A batch whose call fails, or gives another number of answers, is
    halved until the failing rows are alone; those get the error record, and an ``Observation`` given as
    ``seen`` counts them as ``failed``. ``batches`` spreads the rows over that many tasks, for choices
    that sit in few partitions, such as a top-k.
    """
    if isinstance(scorer, Column):
        scored = chosen.select("signal_id", scorer.alias("_parsed"))
        return _enrichment_rows(scored, model, enriched_at)
    wanted = getattr(scorer, "columns", ("source", "title", "body", "tags", "prompt"))
    rows = chosen.withColumn("prompt", prompt()).select("signal_id", *wanted)
    if batches:
        rows = rows.repartition(batches, "signal_id")

    # Nested functions travel to the executors by value, so these need no installed package there.
    def score_rows(batch):
        try:
            answers = list(scorer(batch))
            if len(answers) != len(batch):
                raise ValueError(f"{len(answers)} answers for {len(batch)} rows")
            return answers
        except Exception:
            if len(batch) == 1:
                traceback.print_exc()
                return [None]
            half = len(batch) // 2
            return score_rows(batch.iloc[:half]) + score_rows(batch.iloc[half:])

    def run(frames):
        for frame in frames:
            for start in range(0, len(frame), batch_rows):
                batch = frame.iloc[start : start + batch_rows]
                yield pd.DataFrame({"signal_id": batch["signal_id"], "response": score_rows(batch)})

    responses = rows.mapInPandas(run, "signal_id string, response string")
    if seen is not None:
        responses = responses.observe(seen, F.count_if(F.col("response").isNull()).alias("failed"))
    return enrich_responses(responses, model, enriched_at)


def resume(signals, enriched, scorer, model, enriched_at, max_signals=None, batches=None):
    """Enriched table after one more run over the signals still missing from it."""
    chosen = candidates(signals, enriched, max_signals)
    fresh = apply_scorer(chosen, scorer, model, enriched_at, batches)
    return merge_upsert(enriched, fresh, ["signal_id"])


def commit_in_batches(spark, chosen, log_path, scorer, model, clock, batches, signals=None):
    """Enriches the chosen signals in ``batches`` commits to a change log.

    A run that breaks off keeps the commits made so far, and the next run's candidates leave their
    signals out. The choice is written first, one folder a batch, so that every batch sees the same
    one and reads its own rows only. Given ``signals``, a table that does not change meanwhile, only the
    keys of the choice are written and each batch fetches its own texts from there. Rows without a key
    belong to no batch and are left out.
    """
    path = work_path(spark, "enrich-candidates")
    numbered = chosen.where(F.col("signal_id").isNotNull()).withColumn("_batch", batch_number(batches))
    if signals is not None:
        numbered = numbered.select("signal_id", "_batch")
    numbered.write.partitionBy("_batch").parquet(path)
    numbered = spark.read.schema(numbered.schema).parquet(path)
    first = last_version(spark, log_path, ENRICHED) + 1
    for number in range(batches):
        batch = numbered.where(F.col("_batch") == number).drop("_batch")
        now = clock()
        if signals is not None:
            mine = signals.where(batch_number(batches) == number).select(
                "signal_id", "title", "body", "source", "tags"
            )
            batch = mine.join(batch, "signal_id", "left_semi")
        rows = apply_scorer(batch, scorer, model, now)
        write_commit(rows, log_path, first + number, now, "ENRICH")
    return numbered.drop("_batch")
