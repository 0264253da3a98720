import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tests.test_refresh import questions, stories
from trendmill import constants as c
from trendmill.operators import enrichment
from trendmill.plans import analytics, refresh, whole


@pytest.fixture
def database(spark):
    name = f"whole_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def steps(log):
    return {r["step"]: (r["status"], r["result"]) for r in log.collect()}


def test_runs_add_up_and_name_their_tables(spark, tmp_path, database):
    def run(batch, now, **found):
        return whole.whole_run(
            spark, {getattr(c, name): rows for name, rows in found.items()}, str(tmp_path / "lake"), database,
            batch, now, "2024-01-01", "2024-01-03",
        )

    first = run("b1", "2024-01-05", STORIES=stories(spark, (1, "alpha", 5, 0), (2, "beta", 3, 1)),
                QUESTIONS=lambda: questions(spark, 7))
    assert steps(first) == {
        f"ingest {c.STORIES}": ("SUCCESS", "2"), f"ingest {c.QUESTIONS}": ("SUCCESS", "1"),
        "silver": ("SUCCESS", "3"), "gold": ("SUCCESS", "3"),
    }
    again = run("b1", "2024-01-05", STORIES=stories(spark, (1, "alpha", 5, 0), (2, "beta", 3, 1)))
    assert steps(again)["silver"] == ("SUCCESS", "0"), "a batch is read once"
    later = run("b2", "2024-01-06", STORIES=stories(spark, (3, "gamma", 1, 1)))
    assert steps(later)["gold"] == ("SUCCESS", "4")
    assert spark.sql(f"SELECT sum(signal_count) FROM {database}.source_summary").first()[0] == 4
    assert spark.table(f"{database}.trending_signals").count() == 4
    total = analytics.run_totals(first).first()
    assert (total["total_steps"], total["successful"], total["failed"], total["skipped"]) == (4, 4, 0, 0)
    assert analytics.run_report(first).columns == ["step", "status", "result", "duration_sec"]


def test_failed_feeds_hold_nothing_up(spark, tmp_path, database):
    def broken():
        raise OSError("x" * 2000)

    log = whole.whole_run(
        spark, {c.REPOS: broken, c.STORIES: stories(spark, (1, "alpha", 5, 0))}, str(tmp_path / "lake"),
        database, "b1", "2024-01-05", "2024-01-01", "2024-01-03",
    )
    found = steps(log)
    assert found["gold"] == ("SUCCESS", "1")
    status, result = found[f"ingest {c.REPOS}"]
    assert status == "FAILED" and result.startswith("OSError: xxx") and len(result) == 500


def test_readers_of_a_failed_table_are_skipped(spark, tmp_path, database, monkeypatch):
    def fails(*args, **options):
        raise RuntimeError("no silver today")

    monkeypatch.setattr(refresh, "refresh_silver", fails)
    log = whole.whole_run(
        spark, {c.STORIES: stories(spark, (1, "alpha", 5, 0))}, str(tmp_path / "lake"), database, "b1",
        "2024-01-05", "2024-01-01", "2024-01-03", enrich={},
    )
    assert [(r["step"], r["status"]) for r in log.collect()] == [
        (f"ingest {c.STORIES}", "SUCCESS"), ("silver", "FAILED"), ("gold", "SKIPPED"), ("enrichment", "SKIPPED"),
    ]
    assert log.where("status = 'SKIPPED'").agg(F.sum("duration")).first()[0] == 0


def test_signals_are_enriched_by_name(spark, tmp_path, database):
    log = whole.whole_run(
        spark, {c.STORIES: stories(spark, (1, "alpha", 5, 0), (2, "beta", 3, 1))}, str(tmp_path / "lake"),
        database, "b1", "2024-01-05", "2024-01-01", "2024-01-03",
        enrich={"scorer": enrichment.keyword_scorer({"Cloud": ["alpha"]}), "model": "words",
                "clock": lambda: dt.datetime(2024, 1, 5), "batches": 1},
    )
    assert steps(log)["enrichment"] == ("SUCCESS", "2")
    found = spark.table(f"{database}.enriched_signals").select("category").collect()
    assert sorted(r["category"] for r in found) == ["Cloud", "Other"]


def test_without_feeds_there_is_no_gold(spark, tmp_path, database):
    log = whole.whole_run(
        spark, {}, str(tmp_path / "lake"), database, "b1", "2024-01-05", "2024-01-01", "2024-01-03"
    )
    assert steps(log)["silver"] == ("SUCCESS", "0")
    assert steps(log)["gold"][0] == "FAILED", "there is no silver to read yet"
