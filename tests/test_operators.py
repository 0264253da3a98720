import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from trendmill.operators import layout, versions
from trendmill.operators.dedup import keep_best, keep_latest, keep_one, split_null_keys
from trendmill.operators.merge import merge_upsert
from trendmill.operators.ranking import rank_all, top_k


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


# --- dedup ------------------------------------------------------------------------------------
def test_best_and_latest(spark):
    frame = spark.createDataFrame(
        [(1, 5, 1, "a"), (1, 9, 0, "b"), (1, 9, 2, "c"), (2, None, 1, "d"), (2, 0, 0, "e")],
        "id int, score int, _ingested_at int, text string",
    )
    assert rows(keep_best(frame, ["id"]).select("id", "text")) == [(1, "c"), (2, "e")]
    assert rows(keep_latest(frame, ["id"]).select("id", "text")) == [(1, "c"), (2, "d")]


def test_null_keys_are_split_off(spark):
    frame = spark.createDataFrame([(1, "a"), (None, "b")], "id int, text string")
    good, bad = split_null_keys(frame, ["id"])
    assert rows(good) == [(1, "a")] and rows(bad) == [(None, "b")]


def test_hot_key_is_cut_before_the_shuffle(spark):
    """One key with a third of the rows; each map task passes on one row of it."""
    frame = spark.range(30_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    best = keep_one(frame, ["k"], [F.col("v").desc()])
    plan = best._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:], "no partial limit below the exchange"
    assert best.count() == 20_001
    assert best.where("k = 0").first()["v"] == 29_997


# --- ranking ----------------------------------------------------------------------------------
def ranked_by_hand(data):
    expected, seen = {}, {}
    for group, n, term in sorted(data, key=lambda r: (str(r[0]), -r[1], r[2])):
        seen[group] = seen.get(group, 0) + 1
        expected[(group, term)] = seen[group]
    return expected


def test_rank_all_equals_brute_force(spark):
    """Half of the rows sit in one group and many frequencies are equal."""
    random.seed(5)
    data = [
        (random.choice(["hot", "hot", "hot", "a", None]), random.randint(1, 4), f"t{i:05d}")
        for i in range(5_000)
    ]
    frame = spark.createDataFrame(data, "g string, n int, term string").repartition(6)
    order = [F.col("n").desc(), F.col("term").asc()]
    got = rank_all(frame, ["g"], order, "r").collect()
    assert {(r["g"], r["term"]): r["r"] for r in got} == ranked_by_hand(data)


def test_rank_all_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, n int")
    assert rank_all(empty, ["g"], [F.col("n").asc()], "r").collect() == []


def test_top_k(spark):
    frame = spark.createDataFrame([("a", i) for i in range(9)] + [("b", 1)], "g string, n int")
    assert rows(top_k(frame, ["g"], [F.col("n").desc()], 2, "r")) == [
        ("a", 7, 2), ("a", 8, 1), ("b", 1, 1),
    ]


# --- merge ------------------------------------------------------------------------------------
TARGET = [(1, "a", 10), (2, "b", 20), (3, None, 30)]
SCHEMA = "id int, name string, score int"


def test_merge_updates_and_inserts(spark):
    target = spark.createDataFrame(TARGET, SCHEMA)
    source = spark.createDataFrame([(2, None, 21), (4, "d", 40)], SCHEMA)
    merged = merge_upsert(target, source, ["id"])
    assert set(map(tuple, merged.collect())) == {
        (1, "a", 10), (2, None, 21), (3, None, 30), (4, "d", 40),
    }
    again = merge_upsert(merged, source, ["id"])
    assert set(map(tuple, again.collect())) == set(map(tuple, merged.collect()))


def test_merge_of_chosen_columns_and_condition(spark):
    target = spark.createDataFrame(TARGET, SCHEMA)
    source = spark.createDataFrame([(1, "x", 5), (2, "y", 50), (9, "z", 1)], SCHEMA)
    some = merge_upsert(target, source, ["id"], ["score"])
    assert set(map(tuple, some.collect())) == {
        (1, "a", 5), (2, "b", 50), (3, None, 30), (9, "z", 1),
    }
    better = merge_upsert(
        target, source, ["id"], update_condition=lambda t, s: s("score") > t("score")
    )
    assert set(map(tuple, better.collect())) == {
        (1, "a", 10), (2, "y", 50), (3, None, 30), (9, "z", 1),
    }


def test_merge_source_with_fewer_columns(spark):
    target = spark.createDataFrame(TARGET, SCHEMA)
    source = spark.createDataFrame([(1, 11), (7, 70)], "id int, score int")
    merged = merge_upsert(target, source, ["id"])
    assert set(map(tuple, merged.collect())) == {
        (1, "a", 11), (2, "b", 20), (3, None, 30), (7, None, 70),
    }
    with pytest.raises(ValueError):
        merge_upsert(source, target, ["id"])


def test_merge_keys_only(spark):
    target = spark.createDataFrame([(1,), (2,)], "id int")
    source = spark.createDataFrame([(2,), (3,)], "id int")
    assert rows(merge_upsert(target, source, ["id"])) == [(1,), (2,), (3,)]


def test_merge_null_keys(spark):
    target = spark.createDataFrame([(1, "a"), (None, "n")], "id int, name string")
    source = spark.createDataFrame([(None, "m"), (2, "b")], "id int, name string")
    merged = merge_upsert(target, source, ["id"])
    assert set(map(tuple, merged.collect())) == {(1, "a"), (None, "n"), (2, "b")}


def test_merge_fails_on_repeated_source_keys(spark):
    target = spark.createDataFrame(TARGET, SCHEMA)
    source = spark.createDataFrame([(2, "x", 1), (2, "y", 2)], SCHEMA)
    with pytest.raises(Exception, match="merge source repeats key"):
        merge_upsert(target, source, ["id"]).collect()


# --- versions ---------------------------------------------------------------------------------
def test_change_log(spark, tmp_path):
    path = str(tmp_path / "log")
    make = lambda data: spark.createDataFrame(data, "id int, v string")
    versions.write_commit(make([(1, "a"), (2, "b")]), path, 1, "2024-01-01", "CREATE")
    versions.write_commit(make([(2, "c")]), path, 2, "2024-01-02", "MERGE")
    versions.write_commit(make([(2, "d"), (3, "e")]), path, 3, "2024-01-03", "MERGE")
    log = versions.read_log(spark, path)
    assert rows(versions.as_of(log, ["id"])) == [(1, "a"), (2, "d"), (3, "e")]
    assert rows(versions.as_of(log, ["id"], version=1)) == [(1, "a"), (2, "b")]
    assert rows(versions.as_of(log, ["id"], timestamp="2024-01-02 01:00:00")) == [
        (1, "a"), (2, "c"),
    ]
    assert rows(versions.as_of(log, ["id"], timestamp="2023-12-31")) == []
    assert versions.earliest_version(log).first()[0] == 1
    history = versions.history(log, ["id"], newest=2).collect()
    assert [(r.version, r.operation, r.num_rows, r.num_inserted, r.num_updated) for r in history] \
        == [(3, "MERGE", 2, 1, 1), (2, "MERGE", 1, 0, 1)]
    assert [r.num_rows for r in versions.history(log).collect()] == [2, 1, 2]

    versions.write_commit(make([(2, "d"), (3, "e")]), path, 3, "2024-01-03", "MERGE")
    log = versions.read_log(spark, path)
    assert log.count() == 5, "a repeated commit replaces itself"

    compacted = str(tmp_path / "compacted")
    versions.compact(log, ["id"], compacted, 4, "2024-01-04")
    fresh = versions.read_log(spark, compacted)
    assert rows(versions.as_of(fresh, ["id"])) == [(1, "a"), (2, "d"), (3, "e")]
    assert fresh.count() == 3


def test_clustered_layout(spark, tmp_path):
    frame = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
        F.col("id").alias("v"),
    )
    # Small partitions would be joined again; with real sizes they stay apart.
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    out = layout.write_clustered(frame.repartition(8), str(tmp_path / "t"), ["k", "v"])
    spark.conf.set(coalesce, "true")
    assert rows(out) == rows(frame)
    files = out.where("k = 'hot'").select(F.input_file_name().alias("f"))
    per_file = [r["count"] for r in files.groupBy("f").count().collect()]
    assert len(per_file) > 1, "rows of a frequent value are split over files"
    assert max(per_file) < 20_000 / 3


def test_commit_columns(spark):
    commit = versions.as_commit(spark.range(1), 7, dt.datetime(2024, 1, 1), "MERGE")
    assert commit.dtypes == [
        ("id", "bigint"), ("_version", "bigint"), ("_committed_at", "timestamp_ntz"),
        ("_operation", "string"),
    ]


def test_bucketed_top_k_equals_plain(spark):
    frame = spark.range(3_000, numPartitions=13).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7))
        .alias("g"),
        F.col("id").alias("n"),
    )
    order = [F.col("n").desc()]
    plain, bucketed = (top_k(frame, ["g"], order, 5, "r", b) for b in (None, 4))
    assert rows(plain) == rows(bucketed)
    plan = bucketed._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 2
    assert "WindowGroupLimit" in plan[plan.rindex("Exchange hashpartitioning"):]
