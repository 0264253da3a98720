import datetime as dt

from pyspark.sql import functions as F

from trendmill.functions import scalars as x
from trendmill.functions.scoring import composite_score, days_since
from trendmill.functions.terms import all_terms, tag_terms


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("v")).first()["v"]


def test_surrogate_key_of_null_is_null(spark):
    frame = spark.createDataFrame([(1,), (None,)], "id long")
    keys = [r[0] for r in frame.select(x.surrogate_key("github", "id")).collect()]
    import hashlib

    assert keys == [hashlib.md5(b"github1").hexdigest(), None]


def test_epoch(spark):
    assert one(spark, x.epoch_to_timestamp("s"), s=1704067200) == dt.datetime(2024, 1, 1)
    assert one(spark, x.epoch_to_timestamp("s"), s=10**17) is None


def test_iso_text_of_any_kind(spark):
    assert one(spark, x.iso_to_timestamp("s"), s="2024-01-02T03:04:05Z") == dt.datetime(
        2024, 1, 2, 3, 4, 5
    )
    assert one(spark, x.iso_to_timestamp("s"), s="2024-01-02T03:04:05+02:00") == dt.datetime(
        2024, 1, 2, 1, 4, 5
    )
    assert one(spark, x.iso_to_timestamp("s"), s="2024-01-02") == dt.datetime(2024, 1, 2)
    assert one(spark, x.iso_to_timestamp("s"), s="yesterday") is None


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, x.epoch_to_timestamp("s"), s=1704067200) == dt.datetime(2024, 1, 1)
        assert one(spark, x.iso_to_timestamp("s"), s="2024-01-02T03:04:05Z") == dt.datetime(
            2024, 1, 2, 3, 4, 5
        )
        assert one(spark, x.iso_to_timestamp("s"), s="2024-01-02T03:04:05") == dt.datetime(
            2024, 1, 2, 3, 4, 5
        )
        assert one(spark, x.iso_to_timestamp("s"), s="2024-01-02") == dt.datetime(2024, 1, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_json_arrays(spark):
    texts = ['["a","b"]', "[]", "not json", '{"a": 1}', None, "[1, 2]"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select(
        x.json_strings("t"), x.first_element(x.json_strings("t")),
        x.first_element(x.json_strings("t"), "unknown"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (["a", "b"], "a", "a"), ([], None, "unknown"), ([], None, "unknown"),
        ([], None, "unknown"), ([], None, "unknown"), (["1", "2"], "1", "1"),
    ]


def test_html_and_whitespace(spark):
    assert one(spark, x.strip_html("t"), t="<p>a</p>b") == " a b"
    assert one(spark, x.strip_html("t"), t="1 < b and c > 2") == "1   2"
    assert one(spark, x.collapse_whitespace("t"), t=" a\n\t b c ") == "a b c"
    assert one(spark, x.after_last("t", "/abs/"), t="http://x/abs/2301.1v2") == "2301.1v2"
    assert one(spark, x.after_last("t", "/abs/"), t="2301.1v2") == "2301.1v2"


def test_date_range_is_closed(spark):
    stamps = [dt.datetime(2024, 1, 7, 23, 59, 59), dt.datetime(2024, 1, 8),
              dt.datetime(2024, 1, 9, 23, 59, 59, 999999), dt.datetime(2024, 1, 10)]
    frame = spark.createDataFrame([(s,) for s in stamps], "t timestamp_ntz")
    kept = frame.where(x.in_dates("t", "2024-01-08", "2024-01-09")).collect()
    assert [r["t"] for r in kept] == stamps[1:3]


def test_future_rows_count_as_today(spark):
    row = dict(t="2024-02-03")
    assert one(spark, days_since(F.col("t").cast("timestamp_ntz"), "2024-02-01"), **row) == 0.0
    score = composite_score(
        F.lit(10), F.array(F.lit("a")), F.col("t").cast("timestamp_ntz"), "2024-02-01"
    )
    assert abs(one(spark, score, **row) - 10 * 1.0986122886681098) < 1e-12


def test_terms(spark):
    frame = spark.createDataFrame(
        [
            ("s", "  The (C++) compiler, this THAT a.b.c abcd!", [" Tag ", "x", "a ", None]),
            ("s", None, ["y z"]),
            ("s", "C#11 news news", None),
        ],
        "source string, title string, tags array<string>",
    )
    tags = sorted(r["term"] for r in tag_terms(frame, "source").collect())
    assert tags == ["a", "tag", "y z"]
    every = sorted(r["term"] for r in all_terms(frame, "source").collect())
    # "this" and "that" are stop words, "the" is too short before cleaning, "a.b.c" gives "abc".
    assert every == sorted(tags + ["c++", "compiler", "abc", "abcd", "c#11", "news", "news"])


def test_iso_time_of_a_long_text_is_read_in_one_pass(spark):
    """Each of its blanks would be a search of all that follows."""
    import time

    long = F.repeat(F.lit("T "), 150_000)
    begun = time.monotonic()
    found = spark.range(1).select(x.iso_to_timestamp(F.concat(long, F.lit("end."))).alias("t")).first()["t"]
    assert found is None
    assert time.monotonic() - begun < 20


def test_iso_zones_are_told_apart(spark):
    from datetime import datetime as d

    cases = {
        "2024-01-02T03:04:05Z": d(2024, 1, 2, 3, 4, 5), "2024-01-02 03:04:05+02:00": d(2024, 1, 2, 1, 4, 5),
        "2024-01-02T03:04:05 UTC": d(2024, 1, 2, 3, 4, 5), "2024-01-02T03:04:05 Europe/Paris": d(2024, 1, 2, 2, 4, 5),
        "2024-01-02": d(2024, 1, 2), "2024-01-02T03:04:05": d(2024, 1, 2, 3, 4, 5),
        "Tuesday": None, " 2024-01-02T03:04:05Z ": d(2024, 1, 2, 3, 4, 5),
    }
    rows = spark.createDataFrame([(k,) for k in cases], "s string")
    found = {r.s: r.t for r in rows.select("s", x.iso_to_timestamp("s").alias("t")).collect()}
    assert found == cases
