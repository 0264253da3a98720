"""Rejects, id ranges, signed changes, remembered answers, sketches, and mended upserts."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from trendmill.operators import enrichment, intervals, memo, rejects
from trendmill.operators.merge import upsert_table
from trendmill.plans import gold, upkeep


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


# --- rejects ----------------------------------------------------------------------------------
def test_good_and_rejected_rows_add_up(spark):
    frame = spark.createDataFrame(
        [(1, "a", 5), (None, "b", 5), (2, None, -1), (None, None, None)], "id int, text string, score int"
    )
    rules = rejects.null_rules(["id", "text"]) | {"negative": F.col("score") < 0}
    good, bad, counts = rejects.split(frame, rules)
    assert rows(good) == [(1, "a", 5)]
    assert sorted(r["_reasons"] for r in bad.collect()) == [["null:id"], ["null:id", "null:text"], ["null:text", "negative"]]
    assert counts == {"good": 1, "rejected": 3, "null:id": 2, "null:text": 2, "negative": 1}
    assert good.columns == frame.columns
    none, gone, counts = rejects.split(frame.where("false"), rules)
    assert none.count() == gone.count() == counts["good"] == counts["rejected"] == 0


def test_rejects_of_a_batch_replace_its_first_attempt(spark, tmp_path):
    frame = rejects.with_reasons(spark.createDataFrame([(None,), (None,)], "id int"), rejects.null_rules(["id"]))
    path = str(tmp_path / "rejects")
    rejects.keep_rejects(frame, path, 1)
    rejects.keep_rejects(frame.limit(1), path, 1)
    rejects.keep_rejects(frame, path, 2)
    assert spark.read.parquet(path).count() == 3


# --- id ranges --------------------------------------------------------------------------------
def _islands(ids):
    out = []
    for i in sorted(set(ids)):
        if out and i == out[-1][1] + 1:
            out[-1][1] = i
        else:
            out.append([i, i])
    return [(n, *x) for n, x in enumerate(out, 1)]


@pytest.mark.parametrize("share", [0.02, 0.5, 0.97, 1])
def test_islands_and_gaps(spark, share):
    rng = random.Random(3)
    ids = [i for i in range(-700, 700) if rng.random() < share]
    frame = spark.createDataFrame([(i,) for i in [*ids, *ids[:50], None]], "id long")
    found = intervals.islands(intervals.id_ranges(frame, "id"))
    expected = _islands(ids)
    assert rows(found) == sorted(expected, key=str)
    between = [(a[2] + 1, b[1] - 1) for a, b in zip(expected, expected[1:])]
    assert rows(intervals.gaps(found)) == sorted(between, key=str)


def test_ranges_that_overlap_or_hold_each_other(spark):
    ranges = [(1, 100), (5, 6), (90, 120), (121, 130), (140, 139), (None, 3), (200, 210), (205, 206)]
    found = intervals.islands(spark.createDataFrame(ranges, "low long, high long"))
    assert rows(found) == [(1, 1, 130), (2, 200, 210)]
    assert intervals.islands(spark.createDataFrame([], "low long, high long")).count() == 0


# --- signed changes ---------------------------------------------------------------------------
_SIGNAL = "signal_id string, source string, title string, created_at timestamp_ntz, tags array<string>"


def _signal(key, title, day, tags=("tag",)):
    return key, "s", title, dt.datetime(2024, 1, day), list(tags)


def test_changes_equal_a_rebuild(spark):
    old = [_signal("a", "alpha beta", 1), _signal("b", "alpha gamma", 2), _signal("c", "delta", 2, [])]
    new = [_signal("a", "alpha beta", 1), _signal("b", "alpha alpha", 3, ["other"]), _signal("d", "delta", 2, [])]

    def dated(some):
        return gold.in_range(spark.createDataFrame(some, _SIGNAL), "2024-01-01", "2024-01-30")

    changes = upkeep.count_changes(dated(old[1:]), dated(new[1:]))
    days = upkeep.touched_days(changes)
    assert days == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    columns = ["term", "source", "date", "frequency", "rank_in_source"]
    fresh = upkeep.apply_changes(gold.term_frequency(dated(old)).select(columns), changes)
    full = gold.term_frequency(dated(new)).where(F.col("date").isin(days))
    assert rows(fresh.select(columns)) == rows(full.select(columns))


def test_taking_back_what_was_never_counted_fails(spark):
    row = gold.in_range(spark.createDataFrame([_signal("a", "alpha", 1)], _SIGNAL), "2024-01-01", "2024-01-30")
    changes = upkeep.count_changes(row, row.where("false"))
    with pytest.raises(Exception, match="more taken back"):
        upkeep.apply_changes(gold.term_frequency(row.where("false")), changes).collect()


def test_sketches_of_days_merge_to_a_period(spark):
    frame = spark.range(20_000).select(
        F.lit("s").alias("source"), F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 10).cast("int")).alias("date"),
        (F.col("id") % 7000).cast("string").alias("author"),
    )
    sketches = upkeep.author_sketches(frame)
    assert sketches.count() == 10
    assert upkeep.authors_over(sketches).first()["authors"] == pytest.approx(7000, rel=0.03)


# --- memo -------------------------------------------------------------------------------------
def test_each_distinct_prompt_is_scored_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    @enrichment.scorer_columns("title")
    def scorer(batch):
        calls.add(len(batch))
        return [
            "broken" if t == "bad" else json.dumps({"category": "Web", "summary": t, "sentiment": "neutral"})
            for t in batch["title"]
        ]

    titles = ["one", "two", "one", "one", "bad", None]
    signals = spark.createDataFrame(
        [(f"k{i}", t, None, "src", []) for i, t in enumerate(titles)],
        "signal_id string, title string, body string, source string, tags array<string>",
    )
    path = str(tmp_path / "memo")
    first = memo.enrich_through_memo(signals.where("signal_id < 'k3'"), path, scorer, "m", "2024-01-01")
    assert first.count() == 3 and calls.value == 2
    second = memo.enrich_through_memo(signals, path, scorer, "m", "2024-01-02").collect()
    assert calls.value == 4 and len(second) == 6
    found = {r["signal_id"]: (r["category"], r["summary"]) for r in second}
    assert found["k3"] == ("Web", "one") and found["k4"][0] == "error"
    memo.enrich_through_memo(signals, path, scorer, "m", "2024-01-03").collect()
    assert calls.value == 4
    memo.enrich_through_memo(signals, path, scorer, "m", "2024-01-04", retry_errors=True).collect()
    assert calls.value == 5


# --- table upserts ----------------------------------------------------------------------------
@pytest.mark.parametrize("kind, old, new", [
    ("string", "a:1", "b"), ("string", "x/y", "z=%"), ("string", None, "q"), ("string", "", "q"),
    ("boolean", True, False), ("timestamp_ntz", dt.datetime(2024, 1, 1, 5, 6), dt.datetime(2024, 1, 2)),
    ("decimal(5,2)", __import__("decimal").Decimal("1.50"), __import__("decimal").Decimal("2.00")),
])
def test_moved_rows_leave_no_partition_behind(spark, tmp_path, kind, old, new):
    path, schema = str(tmp_path / "t"), f"id int, v int, part {kind}"
    upsert_table(spark, spark.createDataFrame([(1, 1, old)], schema), path, ["id"], "part")
    for value, part in ((2, new), (3, old), (4, new)):
        upsert_table(spark, spark.createDataFrame([(1, value, part)], schema), path, ["id"], "part")
        assert rows(spark.read.schema(schema).parquet(path).select("id", "v", "part")) == [(1, value, part or None if kind == "string" else part)]


def test_rerun_mends_an_upsert_that_broke_off(spark, tmp_path, monkeypatch):
    from trendmill.operators import merge

    path, schema = str(tmp_path / "t"), "id int, v int, w int, part string"
    upsert_table(spark, spark.createDataFrame([(1, 1, 7, "a:"), (2, 1, 7, "b")], schema), path, ["id"], "part")
    change = spark.createDataFrame([(1, 9, 0, "b")], schema)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(merge, "delete_partition", broken)
        with pytest.raises(OSError):
            upsert_table(spark, change, path, ["id"], "part", update_columns=["v", "part"])
    assert spark.read.schema(schema).parquet(path).count() == 3
    upsert_table(spark, change, path, ["id"], "part", update_columns=["v", "part"])
    found = spark.read.schema(schema).parquet(path).select("id", "v", "w", "part")
    assert rows(found) == [(1, 9, 7, "b"), (2, 1, 7, "b")]


# --- bucketed tables --------------------------------------------------------------------------
def test_bucketed_upsert_shuffles_the_source_only(spark):
    import uuid

    from trendmill.operators import bucketed

    name = f"t_{uuid.uuid4().hex}"
    first = spark.createDataFrame([(i, i) for i in range(100)], "id long, v long")
    bucketed.upsert_bucketed(spark, first, name, ["id"], 8)
    change = spark.createDataFrame([(5, -5), (200, 200), (None, 1)], "id long, v long")
    merged = bucketed.merged_buckets(spark.table(name), change, ["id"], 8)
    plan = merged._jdf.queryExecution().sparkPlan().toString() + merged._jdf.queryExecution().executedPlan().toString()
    executed = merged._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    found = bucketed.upsert_bucketed(spark, change, name, ["id"], 8)
    assert rows(found) == rows(spark.createDataFrame(
        [(i, -5 if i == 5 else i) for i in range(100)] + [(200, 200)], "id long, v long"))
    # A swap that broke off between dropping and renaming is ended by the next upsert.
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__next")
    assert bucketed.upsert_bucketed(spark, change, name, ["id"], 8).count() == 101
    spark.sql(f"DROP TABLE {name}")


def test_changes_are_counted_once(spark):
    rows = gold.in_range(
        spark.createDataFrame(
            [("a", "s", "Rust-like (c++) Straße", dt.datetime(2024, 1, 2), ["go"])],
            "signal_id string, source string, title string, created_at timestamp_ntz, tags array<string>",
        ), "2024-01-01", "2024-01-30",
    )
    changes = upkeep.count_changes(rows.where("false"), rows)
    assert {r.term: r.change for r in changes.collect()} == {"go": 1, "rustlike": 1, "c++": 1, "strae": 1}
    # Days, counts and emptied days are read from what was written; no text is split again.
    assert "Generate" not in changes._jdf.queryExecution().optimizedPlan().toString()
