import datetime as dt
import math

from trendmill.plans import analytics, gold

SCHEMA = (
    "signal_id string, source string, title string, body string, url string, author string, "
    "score int, created_at timestamp_ntz, tags array<string>, language string"
)


def signal(key, source="s", title=None, score=1, day=1, tags=(), author="ann", body="body"):
    created = dt.datetime(2024, 1, 1) + dt.timedelta(days=day - 1)
    return (key, source, title, body, f"u{key}", author, score, created, list(tags), None)


def dated(spark, *rows, first="2024-01-01", last="2024-01-31"):
    return gold.in_range(spark.createDataFrame(list(rows), SCHEMA), first, last)


def test_term_frequency_ranks_ties_by_term(spark):
    rows = dated(
        spark,
        signal("1", tags=["b", "bb"], title="alpha beta beta"),
        signal("2", tags=["bb"], title="this alpha"),
        signal("3", source="t", tags=["bb"]),
    )
    got = {(r.source, r.term): (r.frequency, r.rank_in_source)
           for r in gold.term_frequency(rows).collect()}
    assert got == {
        ("s", "alpha"): (2, 1), ("s", "bb"): (2, 2), ("s", "beta"): (2, 3), ("t", "bb"): (1, 1),
    }
    top = {(r.source, r.term) for r in gold.top_term_frequency(rows, 1).collect()}
    assert top == {("s", "alpha"), ("t", "bb")}


def test_trending_keeps_fifty_per_day(spark):
    rows = dated(spark, *[signal(f"{i:03d}", score=i, day=1 + i % 2) for i in range(150)])
    got = gold.trending_signals(rows, "2024-01-03").collect()
    assert len(got) == 100
    best = next(r for r in got if r.rank_in_source == 1 and r.date == dt.date(2024, 1, 2))
    assert best.score == 149 and abs(best.composite_score - 149 * math.log(2) / 2) < 1e-9
    for day in (1, 2):
        ranks = sorted(r.rank_in_source for r in got if r.date.day == day)
        assert ranks == list(range(1, 51))


def test_source_summary(spark):
    rows = dated(
        spark,
        signal("1", score=1, tags=["y", "x"], author="ann", body="abc"),
        signal("2", score=2, tags=["x", "y"], author="ann", body="a"),
        signal("3", score=2, author="bob", body=None),
        signal("4", source="t", author=None),
    )
    got = {r.source: r for r in gold.source_summary(rows).collect()}
    s, t = got["s"], got["t"]
    assert (s.signal_count, s.avg_score, s.max_score) == (3, 1.67, 2)
    assert (s.unique_authors, s.avg_body_length, s.top_tag) == (2, 2.0, "x")
    assert (t.unique_authors, t.top_tag) == (0, None)
    close = gold.source_summary(rows, approximate_authors=True).where("source = 's'").first()
    assert close.unique_authors == 2


def test_velocity_over_gap_weeks(spark):
    rows = dated(
        spark,
        *[signal(f"a{i}", day=1, tags=["go"]) for i in range(2)],
        *[signal(f"b{i}", day=8, tags=["go"]) for i in range(3)],
        signal("c", day=22, tags=["go"]),
        signal("d", day=8, tags=["new", "x"]),
    )
    got = {(r.term, r.week_start.day): r for r in gold.tech_velocity(rows).collect()}
    assert set(got) == {("go", 1), ("go", 8), ("go", 22), ("new", 8)}
    assert (got["go", 8].last_week_count, got["go", 8].velocity) == (2, 0.5)
    assert got["go", 8].is_accelerating
    assert (got["go", 22].last_week_count, got["go", 22].velocity) == (0, 1.0), "gap gives zero"
    assert got["new", 8].velocity == 1.0


def test_week_aligned_range(spark):
    frame = spark.createDataFrame([signal(str(d), day=d) for d in range(1, 32)], SCHEMA)
    kept = sorted(r.date.day for r in gold.in_weeks(frame, "2024-01-17", "2024-01-18").collect())
    assert kept == list(range(8, 22)), "the week of the range and the week before it"


def test_trending_report(spark):
    rows = dated(spark, *[signal(f"{i:02d}", score=i, day=25 + i % 7) for i in range(70)])
    gold_rows = gold.trending_signals(rows, "2024-02-01")
    report = analytics.trending(gold_rows, "2024-02-01")
    assert report.count() == 20
    assert analytics.trending(gold_rows, "2024-02-01", source="nobody").count() == 0
    assert analytics.trending(gold_rows, "2024-06-01").count() == 0


def test_emerging_radar_has_a_row_for_each_title(spark):
    frame = spark.createDataFrame([signal(f"{i:08x}", title=f"t{i:03d}") for i in range(100)], SCHEMA)
    enriched = frame.selectExpr(
        "signal_id", "if(signal_id < '0000001e', 'Web', 'Cloud') as category",
        "true as is_emerging", "created_at as enriched_at",
    )
    rows = analytics.emerging_radar(enriched, frame, "2024-01-01").collect()
    assert sorted(r.title for r in rows) == [f"t{i:03d}" for i in range(100)]
    assert {(r.category, r.emerging_count) for r in rows} == {("Web", 30), ("Cloud", 70)}


def test_reports_without_an_enrichment_table_are_empty(spark):
    frame = spark.createDataFrame([signal("1")], SCHEMA)
    enriched = frame.selectExpr(
        "signal_id", "'Web' as category", "'neutral' as sentiment", "true as is_emerging",
        "created_at as enriched_at",
    )
    for report in (
        lambda e: analytics.emerging_radar(e, frame, "2024-01-01"),
        lambda e: analytics.sentiment_share(e, frame),
    ):
        assert report(None).collect() == [] and report(None).dtypes == report(enriched).dtypes


def test_run_report(spark):
    log = spark.createDataFrame(
        [("a", "SUCCESS", "x" * 300, 1.25), ("b", "FAILED", None, 2.0), ("c", "SKIPPED", "", 0.0)],
        "step string, status string, result string, duration double",
    )
    rows = {r.step: r for r in analytics.run_report(log).collect()}
    assert len(rows["a"].result) == 300 and rows["a"].duration_sec == 1.3
    assert tuple(analytics.run_totals(log).first()) == (3, 1, 1, 1, 3.3)


def test_author_leaderboard(spark):
    frame = spark.createDataFrame(
        [signal("1", author="ann", score=5), signal("2", author="ann", score=4, source="t"),
         signal("3", author="ann", score=None, day=9), signal("4", author="bob"),
         *[signal(f"x{i}", author="unknown", score=99) for i in range(5)],
         *[signal(f"y{i}", author=None, score=99) for i in range(5)]],
        SCHEMA,
    )
    rows = analytics.author_leaderboard(frame).collect()
    assert [(r.author, r.signal_count, r.avg_score, r.active_sources) for r in rows] == [
        ("ann", 3, 4.5, ["s", "t"])
    ]
    assert rows[0].latest_signal == dt.datetime(2024, 1, 9)


def test_quality_dashboard_and_filters(spark):
    log = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 31, 5), 10, 1, 1.25, True),
         ("a", dt.datetime(2024, 1, 31, 9), 5, 0, None, False),
         ("a", dt.datetime(2024, 1, 20), 5, 0, 1.0, True),
         ("b", dt.datetime(2024, 1, 30), 2, 0, 3.0, True)],
        "source string, checked_at timestamp_ntz, total_rows long, duplicate_count long, "
        "freshness_hours double, quality_passed boolean",
    )
    rows = [tuple(r) for r in analytics.quality_dashboard(log, "2024-02-01").collect()]
    assert rows == [
        ("a", dt.date(2024, 1, 31), 15, 1, 1.3, 1, 2), ("b", dt.date(2024, 1, 30), 2, 0, 3.0, 1, 1),
    ]
    assert analytics.quality_dashboard(log, "2024-02-01", "b").count() == 1


def test_sentiment_share_adds_up(spark):
    frame = spark.createDataFrame([signal(str(i)) for i in range(7)], SCHEMA)
    enriched = frame.selectExpr(
        "signal_id", "if(signal_id = '6', 'error', 'Web') as category",
        "if(signal_id < '2', 'positive', 'neutral') as sentiment",
    )
    rows = analytics.sentiment_share(enriched, frame).collect()
    assert [(r.sentiment, r.signal_count, r.pct) for r in rows] == [
        ("neutral", 4, 66.7), ("positive", 2, 33.3),
    ]


def test_newest_day_without_terms_is_passed_over(spark):
    rows = dated(
        spark, signal("1", title="alpha beta", day=3), signal("2", title="gamma", day=2),
        signal("3", title="a b c", day=5), signal("4", title=None, day=9),
    )
    newest = analytics.top_terms(gold.newest_top_terms(rows, 1)).collect()
    assert [(r.term, r.rank_in_source) for r in newest] == [("alpha", 1)]
    by_table = analytics.top_terms(gold.term_frequency(rows), k=1).collect()
    assert by_table == newest
    nothing = rows.where("signal_id > '2'")
    assert analytics.top_terms(gold.newest_top_terms(nothing, 1)).collect() == []
