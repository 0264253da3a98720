import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from trendmill import constants as c
from trendmill.operators import enrichment

SIGNALS = "signal_id string, source string, title string, body string, tags array<string>, score int"
GOOD = {"category": "AI/ML", "summary": "s", "sentiment": "positive", "is_emerging": True}


def parsed(spark, *texts):
    frame = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)],
                                  "signal_id string, response string")
    rows = enrichment.enrich_responses(frame, "m", "2024-01-01").orderBy(F.col("signal_id").cast("int"))
    return [(r.category, r.summary, r.sentiment, r.is_emerging) for r in rows.collect()]


ERROR = (c.ERROR_CATEGORY, c.ERROR_SUMMARY, "neutral", False)


def test_usable_responses(spark):
    text = json.dumps(GOOD)
    expected = ("AI/ML", "s", "positive", True)
    got = parsed(
        spark, text, f"  {text}\n", f"```json\n{text}\n```", f"```\n{text}\n```  ",
        "```json\n" + text,
    )
    assert got == [expected] * 5


def test_fields_are_validated(spark):
    got = parsed(
        spark,
        json.dumps({**GOOD, "category": "Cooking", "sentiment": "angry"}),
        "{}",
        json.dumps({**GOOD, "is_emerging": "false"}),
        json.dumps({**GOOD, "category": None, "is_emerging": None}),
    )
    assert got == [
        ("Other", "s", "neutral", True),
        ("Other", "", "neutral", False),
        ("AI/ML", "s", "positive", False),
        ("Other", "s", "positive", False),
    ]


def test_unusable_responses(spark):
    text = json.dumps(GOOD)
    got = parsed(spark, text[:-5], "sorry", "", None, f"[{text}]", f"{text} done", "'x'",
                 "{'category': 'Web'}")
    assert got == [ERROR] * 8


def test_prompt_takes_the_whole_body(spark):
    frame = spark.createDataFrame(
        [("1", "src", "T", "b" * 900, ["x", "y"], 1), ("2", "src", "T", None, None, 1)], SIGNALS
    )
    first, second = [r[0] for r in frame.select(enrichment.prompt()).collect()]
    assert first == (
        "Analyse this tech signal:\nSource: src\nTitle: T\nTags: x, y\nBody: " + "b" * 900
        + '\n\nRespond with JSON: {"category": "...", "summary": "...", "sentiment": "...", '
        '"is_emerging": true/false}'
    )
    assert "Tags: \nBody: \n" in second


def frame_of(spark, n):
    return spark.createDataFrame(
        [(f"{i:08x}", "src", f"cloud {i}", "b", ["x"], i) for i in range(n)], SIGNALS
    )


def test_candidates(spark):
    signals = frame_of(spark, 10)
    done = spark.createDataFrame(
        [(f"{9:08x}", "Web"), (f"{8:08x}", c.ERROR_CATEGORY)], "signal_id string, category string"
    )

    def chosen(*args, **kwargs):
        rows = enrichment.candidates(signals, *args, **kwargs).collect()
        return sorted(int(r.signal_id, 16) for r in rows)

    assert chosen(None, 3) == [7, 8, 9]
    assert chosen(done, 3) == [5, 6, 7]
    assert chosen(done, 3, retry_errors=True) == [6, 7, 8]
    assert chosen(done, 500) == list(range(8))


def test_scorer_failures_stay_with_their_row(spark):
    def scorer(batch):
        if (batch["title"] == "cloud 3").any():
            raise RuntimeError("no answer")
        return ['{"category": "Cloud", "summary": "ok"}'] * len(batch)

    rows = enrichment.apply_scorer(frame_of(spark, 8), scorer, "m", "2024-01-01", 2).collect()
    assert {int(r.signal_id, 16): r.category for r in rows} == {
        i: "error" if i == 3 else "Cloud" for i in range(8)
    }


def test_batches_have_the_configured_size_and_columns(spark):
    sizes, failed = spark.sparkContext.accumulator(0), Observation()

    @enrichment.scorer_columns("title")
    def scorer(batch):
        assert list(batch.columns) == ["signal_id", "title"] and len(batch) <= 3
        sizes.add(1)
        return ["{}"] * (len(batch) - (batch["title"] == "cloud 4").sum())

    rows = enrichment.apply_scorer(
        frame_of(spark, 10).coalesce(1), scorer, "m", "2024-01-01", batch_rows=3, seen=failed
    ).collect()
    assert [int(r.signal_id, 16) for r in rows if r.category == "error"] == [4]
    assert failed.get["failed"] == 1 and sizes.value >= 4


def test_words_of_the_built_in_scorer_are_literal(spark):
    def category(title, body=None):
        frame = spark.createDataFrame([("1", "s", title, body, None, 1)], SIGNALS)
        scorer = enrichment.keyword_scorer({"Systems": ["c++", "c#"], "Cloud": ["cloud"]})
        return enrichment.apply_scorer(frame, scorer, "m", "2024-01-01").first().category

    assert category("modern C++ tips") == category("c# today") == "Systems"
    assert category("learning c today") == category("clouds", "x") == "Other"
    assert category("plain", "all about cloud") == "Cloud"


def test_all_missing_signals_are_candidates_by_default(spark):
    assert enrichment.candidates(frame_of(spark, 450)).count() == 450


def test_resume_reaches_every_signal_once(spark):
    signals = frame_of(spark, 7)
    scorer = enrichment.keyword_scorer({"Cloud": ["cloud"]}, emerging=["3"])
    table = enrichment.apply_scorer(
        enrichment.candidates(signals, None, 3), scorer, "m", "2024-01-01"
    )
    for _ in range(3):
        table = enrichment.resume(signals, table, scorer, "m", "2024-01-02", 3)
    rows = table.collect()
    assert sorted(int(r.signal_id, 16) for r in rows) == list(range(7))
    assert {r.category for r in rows} == {"Cloud"}
    assert [int(r.signal_id, 16) for r in rows if r.is_emerging] == [3]


@pytest.mark.parametrize("batches", [1, 7])
def test_batch_numbers(spark, batches):
    numbers = frame_of(spark, 20).select(enrichment.batch_number(batches).alias("n")).collect()
    assert [r.n for r in numbers] == [i % batches for i in range(20)]
