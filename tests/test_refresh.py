import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from trendmill import constants as c
from trendmill.functions.scalars import ntz
from trendmill.operators import enrichment, quality, versions
from trendmill.operators.merge import upsert_table
from trendmill.plans import refresh
from trendmill.session import shared_dir
from trendmill.sources import catalog, feeds, landing


def stories(spark, *items):
    frame = spark.createDataFrame(
        [(f'{{"id": {i}, "type": "story", "title": "{title}", "score": {score}, '
          f'"url": "u", "time": {1704067200 + 86400 * day}}}',)
         for i, title, score, day in items],
        "value string",
    )
    return feeds.stories(frame)


def questions(spark, *ids):
    frame = spark.createDataFrame(
        [(f'{{"question_id": {i}, "title": "spark question", "tags": ["spark"], "score": 1, '
          f'"link": "l", "creation_date": 1704067200}}',) for i in ids],
        "value string",
    )
    return feeds.questions(frame)


def test_bronze_to_gold(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    bronze = {c.STORIES: path("stories"), c.QUESTIONS: path("questions"), "unknown": path("x"),
              c.PAPERS: path("papers, not landed yet")}

    def silver(now, **options):
        return refresh.refresh_silver(
            spark, bronze, path("silver"), path("marks"), path("quality"), now, **options
        )

    assert silver("2024-01-01") == {}, "nothing has landed"
    landing.append_bronze(
        stories(spark, (1, "alpha news", 5, 0), (2, "beta news", 3, 1)), bronze[c.STORIES],
        c.STORIES, "b1", ntz("2024-01-05"),
    )
    landing.append_bronze(
        questions(spark, 7), bronze[c.QUESTIONS], c.QUESTIONS, "b1", ntz("2024-01-05")
    )
    assert silver("2024-01-06") == {c.STORIES: 2, c.QUESTIONS: 1}
    assert silver("2024-01-06 01:00:00") == {}, "the same rows are not read twice"

    landing.append_bronze(
        stories(spark, (2, "beta again", 9, 1), (3, "gamma", 1, 1)), bronze[c.STORIES], c.STORIES,
        "b2", ntz("2024-01-07"),
    )
    assert silver("2024-01-08") == {c.STORIES: 2}
    signals = refresh.current_signals(spark, path("silver"))
    assert {r.title for r in signals.collect()} == {
        "alpha news", "beta again", "gamma", "spark question",
    }
    log = versions.read_log(spark, path("quality"))
    assert sorted((r.source, r.total_rows) for r in log.collect()) == [
        (c.STORIES, 2), (c.STORIES, 2), (c.QUESTIONS, 1),
    ]
    assert versions.history(versions.read_log(spark, path("silver"))).count() == 2

    assert silver("2024-01-09", reprocess=True) == {c.STORIES: 3, c.QUESTIONS: 1}
    again = refresh.current_signals(spark, path("silver"))
    assert {r.title for r in again.collect()} == {r.title for r in signals.collect()}

    tables = refresh.refresh_gold(
        spark, path("silver"), path("gold"), "2024-01-01", "2024-01-02", "2024-01-03"
    )
    trending = tables["trending_signals"].where("source = 'hackernews'")
    assert {r.title for r in trending.collect()} == {"alpha news", "beta again", "gamma"}
    assert tables["tech_term_frequency"].where("term = 'spark'").count() == 1
    assert tables["tech_velocity"].first()["this_week_count"] == 1

    # Another run for one day replaces that day and keeps the other one.
    landing.append_bronze(
        stories(spark, (3, "delta", 1, 1)), bronze[c.STORIES], c.STORIES, "b3", ntz("2024-01-10")
    )
    silver("2024-01-11")
    tables = refresh.refresh_gold(
        spark, path("silver"), path("gold"), "2024-01-02", "2024-01-02", "2024-01-03"
    )
    trending = tables["trending_signals"].where("source = 'hackernews'")
    assert {r.title for r in trending.collect()} == {"alpha news", "beta again", "delta"}
    days = {r.date for r in tables["source_summary"].collect()}
    assert days == {dt.date(2024, 1, 1), dt.date(2024, 1, 2)}

    # The tables can be queried with SQL, also after another day was added.
    catalog.create_databases(spark, ["gold_test"])
    catalog.publish(spark, "gold_test.source_summary", path("gold/source_summary"))
    count = "SELECT sum(signal_count) FROM gold_test.source_summary WHERE source = 'hackernews'"
    assert spark.sql(count).first()[0] == 3
    landing.append_bronze(
        stories(spark, (8, "eps", 1, 4)), bronze[c.STORIES], c.STORIES, "b4", ntz("2024-01-12")
    )
    silver("2024-01-13")
    refresh.refresh_gold(
        spark, path("silver"), path("gold"), "2024-01-05", "2024-01-05", "2024-01-06"
    )
    catalog.publish(spark, "gold_test.source_summary", path("gold/source_summary"))
    assert spark.sql(count).first()[0] == 4
    spark.sql("DROP DATABASE gold_test CASCADE")


def test_failed_run_is_repeated_under_its_version(spark, tmp_path):
    """Silver is written but the mark is lost: the next run replaces the version."""
    path = lambda name: str(tmp_path / name)
    bronze = {c.STORIES: path("stories")}
    landing.append_bronze(
        stories(spark, (1, "a", 5, 0)), bronze[c.STORIES], c.STORIES, "b1", ntz("2024-01-05")
    )
    for marks in ("lost marks", "marks"):
        refresh.refresh_silver(
            spark, bronze, path("silver"), path(marks), path("quality"), "2024-01-06"
        )
    assert versions.read_log(spark, path("silver")).count() == 1
    assert versions.read_log(spark, path("quality")).count() == 1


def test_signals_are_written_once_before_silver(spark, tmp_path, monkeypatch):
    """Judging writes the signals; metrics over good and rejected ones read that."""
    path = lambda name: str(tmp_path / name)
    labels, write = [], refresh.written
    monkeypatch.setattr(refresh, "written", lambda rows, label: (labels.append(label), write(rows, label))[1])
    rows = feeds.repos(spark.createDataFrame([('{"full_name":"a/b"}',), ('{"id":7}',)], "value string"))
    landing.append_bronze(rows, path("repos"), c.REPOS, "b1", ntz("2024-01-05"))
    counts = refresh.refresh_silver(
        spark, {c.REPOS: path("repos")}, path("silver"), path("marks"), path("quality"), "2024-01-06"
    )
    assert counts == {c.REPOS: 2} and labels == ["silver-quality"]
    assert versions.read_log(spark, path("silver")).count() == 1


def test_enrichment_commits_by_batch(spark, tmp_path):
    frame = spark.range(30).select(
        F.md5(F.col("id").cast("string")).alias("signal_id"), F.lit("s").alias("source"),
        F.lit("cloud").alias("title"), F.lit("b").alias("body"), F.array().cast("array<string>")
        .alias("tags"), F.col("id").cast("int").alias("score"),
    )
    log_path = str(tmp_path / "log")
    chosen = enrichment.candidates(frame, None, 20)
    done = enrichment.commit_in_batches(
        spark, chosen, log_path, enrichment.keyword_scorer({"Cloud": ["cloud"]}), "m",
        lambda: dt.datetime(2024, 1, 1), 4,
    )
    assert done.count() == 20
    log = versions.read_log(spark, log_path)
    assert versions.as_of(log, ["signal_id"]).count() == 20
    assert {r.version for r in versions.history(log).collect()} <= {1, 2, 3, 4}
    left = enrichment.candidates(frame, versions.as_of(log, ["signal_id"]), 20)
    assert left.count() == 10


def test_only_keys_of_a_choice_are_written(spark, tmp_path):
    frame = spark.range(30).select(
        F.md5(F.col("id").cast("string")).alias("signal_id"), F.lit("s").alias("source"),
        F.concat(F.lit("cloud "), "id").alias("title"), F.lit("b").alias("body"),
        F.array(F.lit("x")).alias("tags"), F.col("id").cast("int").alias("score"),
    ).unionAll(spark.sql("SELECT NULL, 's', 'no key', 'b', array('x'), 99"))
    log_path = str(tmp_path / "log")
    keys = enrichment.candidate_keys(frame, frame.where("score < 10").withColumn("category", F.lit("Web")))
    done = enrichment.commit_in_batches(
        spark, keys, log_path, enrichment.keyword_scorer({"Cloud": ["cloud"]}), "m",
        lambda: dt.datetime(2024, 1, 1), 4, frame,
    )
    assert done.columns == ["signal_id"] and done.count() == 20
    log = versions.read_log(spark, log_path)
    assert {r.summary for r in log.collect()} == {f"cloud {i}" for i in range(10, 30)} and log.count() == 20


def test_broken_off_enrichment_is_continued(spark, tmp_path):
    frame = spark.range(30).select(
        F.md5(F.col("id").cast("string")).alias("signal_id"), F.lit("s").alias("source"),
        F.lit("t").alias("title"), F.lit("b").alias("body"),
        F.lit(None).cast("array<string>").alias("tags"), F.lit(1).alias("score"),
    )
    log_path = str(tmp_path / "log")
    scorer = enrichment.keyword_scorer({})
    calls = iter([dt.datetime(2024, 1, 1)] * 2)

    def breaks_in_the_third_batch():
        return next(calls)

    def run(clock):
        done = versions.read_log(spark, log_path) if versions.last_version(spark, log_path) else None
        enriched = versions.as_of(done, ["signal_id"]) if done is not None else None
        chosen = enrichment.candidates(frame, enriched, 100)
        enrichment.commit_in_batches(spark, chosen, log_path, scorer, "m", clock, 4)

    with pytest.raises(StopIteration):
        run(breaks_in_the_third_batch)
    kept = versions.read_log(spark, log_path).count()
    assert 0 < kept < 30
    run(lambda: dt.datetime(2024, 1, 2))
    log = versions.read_log(spark, log_path)
    assert log.count() == 30, "no signal was scored twice"
    assert versions.as_of(log, ["signal_id"]).where("enriched_at < '2024-01-02'").count() == kept
    assert {r.category for r in log.collect()} == {"Other"}


def test_range_of_a_log_uses_the_current_version(spark):
    """A key that moved out of the range is gone from it; one that moved in is there."""
    day = lambda n: dt.datetime(2024, 1, n)
    log = spark.createDataFrame(
        [(1, day(1), 1), (1, day(9), 2), (2, day(9), 1), (2, day(1), 2), (3, day(1), 1),
         (4, day(9), 1)],
        "id int, created_at timestamp_ntz, _version long",
    ).withColumns({"_committed_at": ntz("2024-01-01"), "_operation": F.lit("MERGE")})
    rows = versions.as_of(log, ["id"], within=F.col("created_at") < ntz("2024-01-05"))
    assert sorted(r.id for r in rows.collect()) == [2, 3]


def test_ingest(spark, tmp_path):
    path = lambda name: str(tmp_path / name)

    def ingest(source, rows, batch, now):
        return refresh.ingest(
            spark, source, rows, path(source), path("quality"), path("checkpoints"), batch, now
        )

    assert refresh.read_checkpoint(spark, path("checkpoints"), c.STORIES) == {}
    assert ingest(c.STORIES, stories(spark, (1, "a", 5, 0), (4, "b", 1, 0)), "b1", "2024-01-05") == 2
    assert ingest(c.QUESTIONS, questions(spark, 7), "q1", "2024-01-05") == 1
    assert ingest(c.STORIES, stories(spark, (9, "c", 5, 0), (9, "c", 5, 0)), "b2", "2024-01-06") == 2
    assert ingest(c.STORIES, stories(spark, (9, "c", 5, 0)).where("false"), "b3", "2024-01-07") == 0
    mark = refresh.read_checkpoint(spark, path("checkpoints"), c.STORIES)
    assert (mark["last_id"], mark["last_timestamp"], mark["last_batch_id"]) == ("9", None, "b2")
    mark = refresh.read_checkpoint(spark, path("checkpoints"), c.QUESTIONS)
    assert (mark["last_id"], mark["last_timestamp"]) == (None, "1704067200")
    log = {r.batch_id: r for r in quality.read_log(spark, path("quality")).collect()}
    assert log["b1"].quality_passed and log["b1"].is_fresh and log["b1"].total_rows == 2
    assert (log["b2"].duplicate_count, log["b2"].quality_passed) == (1, False)
    assert log["b1"].null_counts == '{"id":0,"title":0,"score":0,"time":0}'
    assert not log["b3"].quality_passed, "an empty batch does not pass"

    # A run repeated after a failure leaves one copy of its batch and its check.
    ingest(c.QUESTIONS, questions(spark, 7), "q1", "2024-01-05")
    assert spark.read.parquet(path(c.QUESTIONS)).count() == 1
    assert quality.read_log(spark, path("quality")).where("batch_id = 'q1'").count() == 1


def test_late_batches_are_read_and_emptied_days_go(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    bronze = {c.STORIES: path("stories")}

    def silver(now):
        return refresh.refresh_silver(
            spark, bronze, path("silver"), path("marks"), path("quality"), now
        )

    landing.append_bronze(
        stories(spark, (1, "first", 5, 0)), path("stories"), c.STORIES, "b2", ntz("2024-01-07")
    )
    assert silver("2024-01-08") == {c.STORIES: 1}
    landing.append_bronze(
        stories(spark, (2, "late", 5, 0)), path("stories"), c.STORIES, "b1", ntz("2024-01-05")
    )
    assert silver("2024-01-09") == {c.STORIES: 1} and silver("2024-01-10") == {}

    days = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "n int, date date")
    span = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    refresh.replace_days(days, path("days"), span=span)
    refresh.replace_days(days.where("n = 2"), path("days"), span=span)
    assert [r.n for r in spark.read.parquet(path("days")).collect()] == [2]


def test_an_empty_replay_leaves_nothing_behind(spark, tmp_path):
    path = str(tmp_path / "stories")
    rows = stories(spark, (1, "a", 5, 0))
    for some in (rows, rows.where("id < 0")):
        landing.append_bronze(some, path, c.STORIES, "b2", ntz("2024-01-05"))
    landing.append_bronze(rows, path, c.STORIES, "b3", ntz("2024-01-05"))
    assert {r["_batch_id"] for r in landing.read_bronze(spark, path).collect()} == {"b3"}
    log = str(tmp_path / "log")
    for some in (rows, rows.where("id < 0")):
        versions.write_commit(some, log, 1, "2024-01-01", "MERGE")
    versions.write_commit(rows, log, 2, "2024-01-01", "MERGE")
    assert versions.read_log(spark, log).count() == 1


def test_runs_leave_no_working_tables(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    folder = Path(shared_dir(spark).removeprefix("file:"))

    def left():
        return {p.name for p in folder.iterdir()} if folder.exists() else set()

    before = left()
    landing.append_bronze(
        stories(spark, (1, "a story", 5, 0)), path("stories"), c.STORIES, "b1", ntz("2024-01-05")
    )
    refresh.refresh_silver(
        spark, {c.STORIES: path("stories")}, path("silver"), path("marks"), path("quality"), "2024-01-06"
    )
    tables = refresh.refresh_gold(
        spark, path("silver"), path("gold"), "2024-01-01", "2024-01-02", "2024-01-03"
    )
    assert tables["tech_term_frequency"].count() == 1
    rows = spark.createDataFrame([(1, "a")], "id int, part string")
    assert upsert_table(spark, rows, path("table"), ["id"], "part") == 1
    moved = spark.createDataFrame([(1, "b")], "id int, part string")
    assert upsert_table(spark, moved, path("table"), ["id"], "part") == 1
    assert upsert_table(spark, moved.where("false"), path("table"), ["id"], "part") == 0
    assert spark.read.parquet(path("table")).select("id", "part").collect() == [(1, "b")]
    assert left() == before


def test_enrichment_step_goes_on_and_lays_out_its_table(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    bronze = {c.STORIES: path("stories")}
    scorer = enrichment.keyword_scorer({"Cloud": ["cloud"]})

    def step(clock):
        return refresh.refresh_enriched(
            spark, path("silver"), path("log"), path("enriched"), scorer, "m", clock, 3
        )

    for batch, items in (("b1", range(8)), ("b2", range(8, 12))):
        landing.append_bronze(
            stories(spark, *[(i, f"cloud {i}", 1, 0) for i in items]), path("stories"), c.STORIES,
            batch, ntz("2024-01-05"),
        )
        refresh.refresh_silver(
            spark, bronze, path("silver"), path("marks"), path("quality"), "2024-01-06"
        )
        stops = iter([dt.datetime(2024, 1, 6)])
        with pytest.raises(StopIteration):
            step(lambda: next(stops))
        assert step(lambda: dt.datetime(2024, 1, 7)).count() == items[-1] + 1
    log = versions.read_log(spark, path("log"))
    assert log.count() == 12, "no signal was scored twice"
    assert {r.category for r in spark.read.parquet(path("enriched")).collect()} == {"Cloud"}
