"""Results have the columns and types of the tables they are written to."""

from pyspark.sql import functions as F

from contract import enrichment as enrichment_queries
from contract import load
from trendmill import schemas
from trendmill.sources.landing import high_water_mark, with_ingestion_columns

FOLDER = "/root/testdata/sf0.001"
QUERIES, _ = load()


def types(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def test_tables(spark):
    expected = {
        "silver_stories": schemas.SIGNALS,
        "silver_repos": schemas.SIGNALS,
        "silver_papers": schemas.SIGNALS,
        "silver_questions": schemas.SIGNALS,
        "quality_log": schemas.QUALITY_LOG,
        "enrich_apply": schemas.ENRICHED,
        "enrich_default": schemas.ENRICHED,
        "high_water_mark": schemas.CHECKPOINTS,
    }
    for name, schema in expected.items():
        assert QUERIES[name](spark, FOLDER).dtypes == types(schema), name
    assert enrichment_queries.enriched(spark, FOLDER).dtypes == types(schemas.ENRICHED)
    frequency = QUERIES["term_frequency"](spark, FOLDER)
    assert sorted(frequency.dtypes) == sorted(types(schemas.TERM_FREQUENCY))


def test_now_is_utc_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        row = with_ingestion_columns(spark.range(1), "s", "b").select(
            (F.unix_micros(F.current_timestamp()) / 1e6).alias("now"),
            F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), "_ingested_at")
            .alias("stamp"),
        ).first()
        assert abs(row.now - row.stamp) < 5
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_marks_of_an_empty_table(spark):
    empty = with_ingestion_columns(spark.range(0), "s", "b")
    assert high_water_mark(empty, "id", "_ingested_at").collect() == []
