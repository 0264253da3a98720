"""What the plans of the registered queries must and must not contain."""

import pytest

from contract import load

FOLDER = "/root/testdata/sf0.001"
QUERIES, _ = load()


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


# Streams and the full ranking return tables already written, so there is nothing to see in them.
@pytest.mark.parametrize(
    "name",
    ["trending_signals", "source_summary", "tech_velocity", "q01_trending", "q05_top_terms",
     "q06_overlap", "q07_emerging", "q08_sentiment", "q09_authors", "q10_quality", "quality_log",
     "unified_signals", "merge_upsert", "enrich_candidates", "enrich_resume"],
)
def test_no_cross_joins(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_date_range_reaches_the_scan(spark):
    text = plan(spark, "date_range_filter")
    assert "GreaterThanOrEqual(ts,2024-01-08T00:00)" in text
    assert "LessThan(ts,2024-01-15T00:00)" in text


def test_only_needed_columns_are_read(spark):
    text = plan(spark, "q08_sentiment")
    scans = [line for line in text.splitlines() if "documents.parquet" in line]
    assert scans and all("ReadSchema: struct<doc_id:bigint>" in line for line in scans)
    text = plan(spark, "q09_authors")
    assert "html:" not in text and "text:" not in text


def test_source_filter_drops_scans_of_other_sources(spark):
    assert plan(spark, "source_filter").count("FileScan") < plan(spark, "q04_daily_volume").count(
        "FileScan"
    )


@pytest.mark.parametrize(
    "name", ["trending_signals", "top_tag_mode", "dedup_best_score", "dedup_latest",
             "dedup_first_wins", "silver_stories", "as_of_version"],
)
def test_groups_are_cut_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert "WindowGroupLimit" in text[text.index("Exchange hashpartitioning"):]


@pytest.mark.parametrize("name", ["latest_signals", "q01_trending"])
def test_top_k_is_not_a_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


@pytest.mark.parametrize("name", ["bronze_stories", "bronze_repos", "bronze_questions"])
def test_records_are_parsed_once(spark, name):
    assert plan(spark, name).count("from_json(") == 1


def test_entries_are_parsed_once(spark):
    assert plan(spark, "bronze_papers_xml").count("from_xml(") == 1


def test_velocity_reads_tags_once(spark):
    text = plan(spark, "tech_velocity")
    assert "Join" not in text and text.count("events.parquet") == 1


def test_python_only_in_the_scorer(spark):
    for name in QUERIES:
        if name.startswith(("q0", "q1", "silver", "quality", "bronze_s", "scalar", "enrich")):
            text = plan(spark, name)
            assert "EvalPython" not in text
            assert ("MapInPandas" in text) == (name == "enrich_python")


def test_daily_volume_reads_no_texts(spark):
    text = plan(spark, "q04_daily_volume")
    assert "html:" not in text and "text:" not in text


def test_rows_are_not_dealt_out_by_number(spark):
    for name in ("unified_signals", "title_tokens", "bronze_repos", "q06_overlap"):
        assert "RoundRobinPartitioning" not in plan(spark, name)
