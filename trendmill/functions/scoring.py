"""Scores computed per signal."""

from pyspark.sql import functions as F

from trendmill.functions.scalars import as_column


def days_since(created_at, as_of):
    """Whole days up to ``as_of``; rows from the future count as today."""
    days = F.datediff(F.lit(str(as_of)).cast("date"), as_column(created_at))
    return F.greatest(days, F.lit(0)).cast("double")


def composite_score(score, tags, created_at, as_of):
    """score x ln(2 + number of tags) x 1 / (1 + age in days)."""
    recency = F.lit(1.0) / (F.lit(1.0) + days_since(created_at, as_of))
    return as_column(score) * F.log(F.lit(2.0) + F.size(as_column(tags))) * recency


def velocity(this_week, last_week):
    """Relative change against last week, with at least one in the divisor."""
    return (this_week - last_week) / F.greatest(last_week, F.lit(1).cast("bigint"))
