"""Reports over the silver and gold tables.

Each takes the tables it reads and, where the report looks back in time, the day it is made for.
``source`` restricts a report to one source; "all" or None keeps every source.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from trendmill import constants as c
from trendmill.functions.scalars import since_days

def only_source(df, source):
    return df if source in (None, "all") else df.where(F.col("source") == source)


def trending(trending_signals, as_of, source=None, k=20):
    """Highest composite scores of the past week."""
    recent = only_source(trending_signals, source).where(since_days("date", as_of, 7))
    return (
        recent.orderBy(F.col("composite_score").desc(), "signal_id")
        .limit(k)
        .select(
            F.col("rank_in_source").alias("rank"), "source", "title",
            F.col("score").alias("raw_score"),
            F.round("composite_score", 2).alias("composite_score"), "url",
        )
    )


def accelerating(tech_velocity, k=15):
    """Steepest week-over-week growth among terms with at least three mentions."""
    return (
        tech_velocity.where(F.col("is_accelerating") & (F.col("this_week_count") >= 3))
        .orderBy(F.col("velocity").desc(), "term", "week_start")
        .limit(k)
        .select(
            "term", "this_week_count", "last_week_count",
            F.round("velocity", 2).alias("velocity"),
            F.when(F.col("is_accelerating"), "ACCELERATING").otherwise("stable").alias("status"),
        )
    )


def source_activity(source_summary, as_of, source=None):
    """Volume and score per source over 30 days; authors are the sum of daily distinct authors."""
    return (
        only_source(source_summary, source)
        .where(since_days("date", as_of, 30))
        .groupBy("source")
        .agg(
            F.sum("signal_count").alias("total_signals"),
            # Daily averages have two decimals; adding them as decimals makes the result the same
            # for every order of rows.
            F.round(F.avg(F.col("avg_score").cast("decimal(18,2)")).cast("double"), 1).alias(
                "avg_score"
            ),
            F.max("max_score").alias("peak_score"),
            F.sum("unique_authors").alias("total_authors"),
        )
        .orderBy(F.col("total_signals").desc(), "source")
    )


def daily_volume(source_summary, as_of, source=None):
    return (
        only_source(source_summary, source)
        .where(since_days("date", as_of, 30))
        .select("date", "source", "signal_count")
        .orderBy("date", "source")
    )


def top_terms(term_frequency, source=None, k=10):
    """Most frequent terms of each source on the newest day of the table."""
    # The filter the join would add anyway; given to both uses, it lets them share one computation.
    dated = term_frequency.where(F.col("date").isNotNull())
    newest = dated.agg(F.max("date").alias("date"))
    return (
        only_source(dated, source)
        .where(F.col("rank_in_source") <= k)
        .join(F.broadcast(newest), "date")
        .select("source", "term", "frequency", "rank_in_source")
        .orderBy("source", "rank_in_source")
    )


def term_overlap(term_counts, as_of, min_sources=3, k=20):
    """Terms of the past week that occur in several sources."""
    return (
        term_counts.where(since_days("date", as_of, 7))
        .groupBy("term", "source")
        .agg(F.sum("frequency").alias("mentions"))
        .groupBy("term")
        .agg(
            F.count(F.lit(1)).alias("source_count"),
            F.sum("mentions").alias("total_mentions"),
            F.array_sort(F.collect_list("source")).alias("sources"),
        )
        .where(F.col("source_count") >= min_sources)
        .orderBy(F.col("total_mentions").desc(), "term")
        .limit(k)
    )


def emerging_radar(enriched, signals, as_of, source=None):
    """Emerging signals of the past week: one row a signal with its category's total.

    The totals are counted on ids alone, so texts are joined once. Without an enrichment table the
    report is empty.
    """
    wanted = only_source(signals, source)
    if enriched is None:
        return wanted.where(F.lit(False)).select(
            F.lit("").alias("category"), "signal_id", "title",
            F.lit(0).cast("bigint").alias("emerging_count"),
        )
    emerging = enriched.where(
        F.col("is_emerging")
        & (F.col("enriched_at") >= F.date_sub(F.lit(str(as_of)).cast("date"), 7))
    ).select("signal_id", "category")
    totals = (
        emerging.join(wanted.select("signal_id"), "signal_id")
        .groupBy("category").agg(F.count(F.lit(1)).alias("emerging_count"))
    )
    return (
        emerging.join(wanted.select("signal_id", "title"), "signal_id")
        .join(totals, "category")
        .select("category", "signal_id", "title", "emerging_count")
    )


def sentiment_share(enriched, signals, source=None):
    """Sentiment counts and percentages per source, failed enrichments left out.

    Without an enrichment table the report is empty.
    """
    wanted = only_source(signals, source)
    if enriched is None:
        return wanted.where(F.lit(False)).select(
            "source", F.lit("").alias("sentiment"), F.lit(0).cast("bigint").alias("signal_count"),
            F.lit(0.0).alias("pct"),
        )
    counts = (
        enriched.where(F.col("category") != c.ERROR_CATEGORY)
        .select("signal_id", "sentiment")
        .join(wanted.select("signal_id", "source"), "signal_id")
        .groupBy("source", "sentiment")
        .agg(F.count(F.lit(1)).alias("signal_count"))
    )
    total = F.sum("signal_count").over(Window.partitionBy("source"))
    return counts.withColumn(
        "pct", F.round(F.col("signal_count") * F.lit(100.0).cast("double") / total, 1)
    ).orderBy("source", F.col("signal_count").desc(), "sentiment")


def author_leaderboard(signals, source=None, min_signals=3, k=20):
    """Named authors with several signals, best average score first.

    Counted per author and source first, which Spark does by hashing on the map side; collecting
    sources straight from the signals would sort all of them.
    """
    named = F.col("author").isNotNull() & ~F.col("author").isin("anonymous", "unknown")
    per_source = (
        only_source(signals, source)
        .where(named)
        .groupBy("author", "source")
        .agg(
            F.count(F.lit(1)).alias("signals"),
            F.sum("score").alias("points"),
            F.count("score").alias("scored"),
            F.max("created_at").alias("latest"),
        )
    )
    return (
        per_source.groupBy("author")
        .agg(
            F.sum("signals").alias("signal_count"),
            F.round(F.try_divide(F.sum("points"), F.sum("scored")), 1).alias("avg_score"),
            F.array_sort(F.collect_list("source")).alias("active_sources"),
            F.max("latest").alias("latest_signal"),
        )
        .where(F.col("signal_count") >= min_signals)
        .orderBy(F.col("avg_score").desc(), "author")
        .limit(k)
    )


def quality_dashboard(quality_log, as_of, source=None):
    """Checks of the past week per source and day."""
    return (
        only_source(quality_log, source)
        .where(F.col("checked_at") >= F.date_sub(F.lit(str(as_of)).cast("date"), 7))
        .groupBy("source", F.to_date("checked_at").alias("check_date"))
        .agg(
            F.sum("total_rows").alias("total_rows"),
            F.sum("duplicate_count").alias("total_duplicates"),
            F.round(
                F.avg(F.col("freshness_hours").cast("decimal(18,2)")).cast("double"), 1
            ).alias("avg_freshness_hours"),
            F.count_if("quality_passed").alias("checks_passed"),
            F.count(F.lit(1)).alias("total_checks"),
        )
        .orderBy(F.col("check_date").desc(), "source")
    )


def category_histogram(enriched):
    return (
        enriched.groupBy("category")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), "category")
    )


def latest_enriched(enriched, rows=10):
    return enriched.orderBy(F.col("enriched_at").desc(), "signal_id").limit(rows)


def run_report(run_log):
    """Steps of a run with their whole results and rounded durations."""
    return run_log.select(
        "step", "status", "result",
        F.round("duration", 1).alias("duration_sec"),
    )


def run_totals(run_log):
    """Number of steps by outcome and their total duration."""
    return run_log.agg(
        F.count(F.lit(1)).alias("total_steps"),
        F.count_if(F.col("status") == "SUCCESS").alias("successful"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.count_if(F.col("status") == "SKIPPED").alias("skipped"),
        F.round(F.sum(F.col("duration").cast("decimal(18,3)")).cast("double"), 1).alias(
            "total_duration"
        ),
    )
