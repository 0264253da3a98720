"""Gold tables built from the signals table."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from trendmill import constants as c
from trendmill.functions.scalars import in_dates
from trendmill.functions.scoring import composite_score, velocity
from trendmill.functions.terms import all_terms, tag_terms
from trendmill.operators.ranking import rank_all, top_k

_DAY = ["source", "date"]

# Groups of map tasks that settle their best signals among themselves first.
_TRENDING_BUCKETS = 64


def in_range(signals, first, last):
    """Signals created in a closed date range, with their ``date``."""
    return signals.where(in_dates("created_at", first, last)).withColumn(
        "date", F.to_date("created_at")
    )


def weeks_around(first, last):
    """Condition for the whole weeks of a date range and the week before them.

    Velocity compares full weeks, so a range cut in the middle of a week would fake a change.
    """

    def monday(day):
        return F.date_trunc("week", F.lit(str(day)).cast("date")).cast("date")

    created = F.col("created_at")
    lower, upper = F.date_sub(monday(first), 7), F.date_add(monday(last), 7)
    return (created >= lower.cast("timestamp_ntz")) & (created < upper.cast("timestamp_ntz"))


def in_weeks(signals, first, last):
    """As ``in_range`` with the range widened by ``weeks_around``."""
    return signals.where(weeks_around(first, last)).withColumn("date", F.to_date("created_at"))


def term_counts(dated):
    """Occurrences of every term per source and day."""
    return (
        all_terms(dated, *_DAY)
        .groupBy("term", *_DAY)
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


def _by_frequency():
    return [F.col("frequency").desc(), F.col("term").asc()]


def term_frequency(dated):
    """Term counts with the rank of each term in its source and day."""
    ranked = rank_all(term_counts(dated), _DAY, _by_frequency(), "rank_in_source")
    return ranked.withColumn("rank_in_source", F.col("rank_in_source").cast("int"))


def top_term_frequency(dated, k):
    """Only the ``k`` most frequent terms of each source and day, without ranking the rest."""
    return top_k(term_counts(dated), _DAY, _by_frequency(), k, "rank_in_source")


def newest_top_terms(dated, k):
    """As ``top_term_frequency`` for the newest day with terms.

    Days are tried from the newest on, which mostly is the one: finding it reads dates alone, and
    only its own texts are split and counted.
    """
    day = dated.agg(F.max("date")).first()[0]
    while day is not None:
        rows = dated.where(F.col("date") == F.lit(day))
        if not all_terms(rows, *_DAY).isEmpty():
            return top_term_frequency(rows, k)
        day = dated.where(F.col("date") < F.lit(day)).agg(F.max("date")).first()[0]
    return top_term_frequency(dated.where(F.lit(False)), k)


def trending_signals(dated, as_of, k=c.TRENDING_PER_GROUP):
    """Top signals of each source and day by composite score."""
    scored = dated.select(
        "signal_id", "source", "title", "url", "score",
        composite_score("score", "tags", "created_at", as_of).alias("composite_score"),
        "date", "tags",
    )
    order = [F.col("composite_score").desc(), F.col("signal_id").asc()]
    return top_k(scored, _DAY, order, k, "rank_in_source", _TRENDING_BUCKETS).select(
        "signal_id", "source", "title", "url", "score", "composite_score", "rank_in_source",
        "date", "tags",
    )


def top_tags(dated):
    """Most frequent tag of each source and day, the alphabetically first one among equals."""
    counts = (
        dated.select(*_DAY, F.explode("tags").alias("tag"))
        .groupBy(*_DAY, "tag")
        .agg(F.count(F.lit(1)).alias("tag_count"))
    )
    order = [F.col("tag_count").desc(), F.col("tag").asc()]
    return top_k(counts, _DAY, order, 1, "_rank").select(*_DAY, F.col("tag").alias("top_tag"))


def daily_figures(dated, approximate_authors=False):
    """Daily figures per source."""
    authors = F.approx_count_distinct if approximate_authors else F.countDistinct
    return dated.groupBy(*_DAY).agg(
        F.count(F.lit(1)).alias("signal_count"),
        F.round(F.avg("score"), 2).alias("avg_score"),
        F.max("score").alias("max_score"),
        authors("author").alias("unique_authors"),
        F.round(F.avg(F.length("body")), 1).alias("avg_body_length"),
    )


def daily_counts(dated):
    """Signals per source and day alone."""
    return dated.groupBy(*_DAY).agg(F.count(F.lit(1)).alias("signal_count"))


def source_summary(dated, approximate_authors=False):
    """Daily figures per source with the top tag."""
    return daily_figures(dated, approximate_authors).join(top_tags(dated), _DAY, "left")


def tech_velocity(dated):
    """Tag counts per week against the week before.

    The previous week is read from a range frame of exactly seven days back, so gaps give 0 and the
    counts are used where they are instead of being joined with themselves.
    """
    weekly = (
        tag_terms(dated, "date")
        .groupBy("term", F.date_trunc("week", "date").cast("date").alias("week_start"))
        .agg(F.count(F.lit(1)).alias("this_week_count"))
    )
    day = F.unix_date("week_start").cast("bigint")
    week_before = Window.partitionBy("term").orderBy(day).rangeBetween(-7, -7)
    compared = weekly.withColumn(
        "last_week_count",
        F.coalesce(F.sum("this_week_count").over(week_before), F.lit(0).cast("bigint")),
    )
    change = velocity(F.col("this_week_count"), F.col("last_week_count"))
    return compared.withColumn("velocity", change).withColumn(
        "is_accelerating", F.col("velocity") > c.ACCELERATION
    )
