import datetime as dt

from trendmill.operators import quality

SCHEMA = "source string, signal_id string, title string, created_at timestamp_ntz"
DAY = dt.datetime(2024, 1, 10)


def check(spark, data, **options):
    frame = spark.createDataFrame(data, SCHEMA)
    settings = {"timestamp_column": "created_at", "as_of": "2024-01-11", **options}
    metrics = quality.quality_metrics(frame, ["signal_id"], ["signal_id", "title", "gone"], **settings)
    return {r["source"]: r for r in quality.with_gate(metrics).collect()}


def test_metrics_per_source(spark):
    got = check(
        spark,
        [("a", "1", "t", DAY), ("a", "1", None, DAY), ("a", None, "t", DAY), ("a", None, "t", None),
         ("b", "9", "t", DAY - dt.timedelta(days=5))],
    )
    a, b = got["a"], got["b"]
    assert (a.total_rows, a.duplicate_count) == (4, 2), "a NULL key counts as one key"
    assert a.null_counts == {"signal_id": 2, "title": 1}
    assert (a.freshness_hours, a.is_fresh) == (24.0, True)
    assert a.breaches == ["nulls:signal_id", "nulls:title", "duplicates"]
    assert (b.freshness_hours, b.is_fresh, b.breaches) == (144.0, False, ["stale"])


def test_thresholds_are_exclusive(spark):
    data = [("a", str(i), None if i == 0 else "t", DAY) for i in range(10)]
    assert check(spark, data)["a"].quality_passed, "10 % NULLs still pass"
    data = [("a", str(min(i, 98)), "t", DAY) for i in range(100)]
    assert check(spark, data)["a"].quality_passed, "1 % repeats still pass"
    at_limit = check(spark, [("a", "1", "t", DAY)], as_of="2024-01-12")
    assert at_limit["a"].is_fresh, "48 hours are still fresh"


def test_freshness_without_usable_time(spark):
    data = [("a", "1", "t", None)]
    assert not check(spark, data)["a"].is_fresh
    assert check(spark, data, timestamp_column=None)["a"].is_fresh
    missing = check(spark, data, timestamp_column="not_there")["a"]
    assert (missing.is_fresh, missing.freshness_hours) == (False, None)


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    whole = quality.table_metrics(
        frame, "all", key_columns=["signal_id"], required_columns=["title"],
        timestamp_column="created_at", as_of="2024-01-11",
    )
    row = quality.with_gate(whole).first()
    assert (row.total_rows, row.duplicate_count, row.breaches) == (0, 0, ["empty"])
    assert not row.quality_passed


def test_log_rows_are_repeatable(spark, tmp_path):
    frame = spark.createDataFrame([("a", "1", "t", DAY)], SCHEMA)
    gated = quality.with_gate(
        quality.quality_metrics(frame, ["signal_id"], ["title"], "created_at", "2024-01-11")
    )
    rows = quality.log_rows(gated, "batch", "2024-01-11")
    assert rows.first() == quality.log_rows(gated, "batch", "2024-01-11").first()
    path = str(tmp_path / "log")
    quality.append_log(rows, path)
    quality.append_log(rows, path)
    quality.append_log(quality.log_rows(gated, "007", "2024-01-12"), path)
    saved = quality.read_log(spark, path)
    assert saved.columns == rows.columns
    assert sorted(r.batch_id for r in saved.collect()) == ["007", "batch"]
    assert {r["null_counts"] for r in saved.collect()} == {'{"title":0}'}


def test_freshness_of_text_times(spark):
    frame = spark.createDataFrame(
        [("a", "2024-01-10T00:00:00Z"), ("b", "soon"), ("c", None)], "source string, at string"
    )
    got = {
        r["source"]: (r["newest"], r["freshness_hours"], r["is_fresh"])
        for r in quality.quality_metrics(
            frame, ["source"], [], "at", "2024-01-11T12:00:00"
        ).collect()
    }
    assert got == {
        "a": ("2024-01-10T00:00:00Z", 36.0, True), "b": ("soon", None, False),
        "c": (None, None, False),
    }
