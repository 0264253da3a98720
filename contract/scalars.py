"""Scalar functions."""

from pyspark.sql import functions as F

from contract import query
from contract.sql import PAGE, seconds, spread
from trendmill.functions import scalars as x
from trendmill.functions.scoring import days_since
from trendmill.sources import standins as s
from trendmill.sources.standins import table


@query("scalar_casts", """
SELECT o_orderkey, o_orderkey::VARCHAR AS key_text, trunc(o_totalprice)::INT AS price_int,
  o_totalprice AS price_double, NULL::INT AS bad_int, o_orderdate::DATE AS day,
  o_orderdate::TIMESTAMP AS stamp FROM orders""")
def scalar_casts(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_totalprice").cast("int").alias("price_int"),
        F.col("o_totalprice").cast("string").cast("double").alias("price_double"),
        F.col("o_orderpriority").try_cast("int").alias("bad_int"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS").cast("timestamp_ntz")
        .alias("stamp"),
    )


@query("scalar_epoch", """
SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS created_at, NULL::TIMESTAMP AS impossible
FROM events""")
def scalar_epoch(spark, folder):
    epoch = s.seconds(F.col("ts").cast("timestamp_ntz"))
    return table(spark, folder, "events").select(
        "event_id",
        x.epoch_to_timestamp(epoch).alias("created_at"),
        x.epoch_to_timestamp(epoch * 1_000_000).alias("impossible"),
    )


@query("scalar_iso_ts", f"""
SELECT doc_id, {spread('doc_id')} AS utc, {spread('doc_id')} - INTERVAL 2 HOUR AS offset_zone,
  NULL::TIMESTAMP AS unreadable FROM documents""")
def scalar_iso_ts(spark, folder):
    written = s.iso(s.spread_day("doc_id"))
    return table(spark, folder, "documents").select(
        "doc_id",
        x.iso_to_timestamp(written).alias("utc"),
        x.iso_to_timestamp(F.replace(written, F.lit("Z"), F.lit("+02:00"))).alias("offset_zone"),
        x.iso_to_timestamp(F.col("text")).alias("unreadable"),
    )


@query("scalar_dates", """
SELECT event_id, ts::DATE AS day, ts::DATE + 7 AS week_later, ts::DATE - 30 AS month_before,
  date_diff('day', ts::DATE, DATE '2024-02-01')::DOUBLE AS age_days,
  date_trunc('week', ts)::DATE AS week_start,
  ts::DATE >= DATE '2024-02-01' - 7 AS past_week FROM events""")
def scalar_dates(spark, folder):
    day = F.to_date("ts")
    return table(spark, folder, "events").select(
        "event_id", day.alias("day"), F.date_add(day, 7).alias("week_later"),
        F.date_sub(day, 30).alias("month_before"), days_since("ts", s.AS_OF).alias("age_days"),
        F.date_trunc("week", "ts").cast("date").alias("week_start"),
        x.since_days(day, s.AS_OF, 7).alias("past_week"),
    )


def _array_texts(spark, folder):
    """JSON texts of all kinds: arrays, empty arrays, broken text, objects and NULL."""
    kind = F.col("event_type")
    good = F.to_json(F.array(kind, F.concat(F.lit("k"), s.props_key())))
    written = (
        F.when(kind == "view", "[]").when(kind == "error", "not json")
        .when(kind == "signup", F.col("props")).when(kind == "purchase", good)
    )
    return table(spark, folder, "events").select("event_id", written.alias("written"))


_PURCHASE = """CASE WHEN event_type = 'purchase'
  THEN ['purchase', 'k' || regexp_extract(props, '"k": *([0-9]+)', 1)] ELSE []::VARCHAR[] END"""


@query("json_array_parse", f"SELECT event_id, {_PURCHASE} AS tags FROM events")
def json_array_parse(spark, folder):
    rows = _array_texts(spark, folder)
    return rows.select("event_id", x.json_strings("written").alias("tags"))


@query("array_first", """
SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'purchase' END AS first_tag,
  CASE WHEN event_type = 'purchase' THEN 'purchase' ELSE 'unknown' END AS first_or_default
FROM events""")
def array_first(spark, folder):
    tags = x.json_strings("written")
    return _array_texts(spark, folder).select(
        "event_id",
        x.first_element(tags).alias("first_tag"),
        x.first_element(tags, "unknown").alias("first_or_default"),
    )


@query("array_ops", f"""
SELECT tag, count(*) AS uses, count(*) FILTER (n = 2) AS in_pairs,
  count(*) FILTER (bought) AS bought
FROM (SELECT unnest(tags) AS tag, len(tags) AS n, list_contains(tags, 'purchase') AS bought
      FROM (SELECT {_PURCHASE} AS tags FROM events)) GROUP BY tag""")
def array_ops(spark, folder):
    """Size, membership and explode; rows without tags vanish."""
    rows = _array_texts(spark, folder).select(x.json_strings("written").alias("tags"))
    exploded = rows.select(
        F.explode("tags").alias("tag"), F.size("tags").alias("n"),
        F.array_contains("tags", "purchase").alias("bought"),
    )
    return exploded.groupBy("tag").agg(
        F.count(F.lit(1)).alias("uses"), F.count_if(F.col("n") == 2).alias("in_pairs"),
        F.count_if("bought").alias("bought"),
    )


@query("html_strip", f"""
SELECT page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') AS body, {PAGE['title']} AS title,
  {seconds(spread('page_id'))} AS created FROM pages""")
def html_strip(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", x.strip_html("html").alias("body"), s.page_title().alias("title"),
        s.seconds(s.spread_day("page_id")).alias("created"),
    )
