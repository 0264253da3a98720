"""Upkeep of gold counts by signed changes instead of a rebuild.

A changed signal takes its old terms back and adds its new ones. Only the days that a change touches are
counted, ranked and replaced.
"""

from pyspark.sql import functions as F

from trendmill.functions.terms import all_terms
from trendmill.operators.ranking import rank_all
from trendmill.session import written

_KEY = ["term", "source", "date"]


def count_changes(before, after):
    """``term``, ``source``, ``date``, ``change`` from the old and the new rows of changed signals.

    ``before`` has the rows as they were counted, ``after`` as they are now; either may lack a signal. The
    changes are written, as the days they touch, the counts and the emptied days all read them.
    """
    def signed(rows, sign):
        return all_terms(rows, "source", "date").select(*_KEY, F.lit(sign).cast("long").alias("change"))

    both = signed(before, -1).unionAll(signed(after, 1))
    changes = both.groupBy(*_KEY).agg(F.sum("change").alias("change")).where("change <> 0")
    return written(changes, "term-changes")


def apply_changes(frequencies, changes):
    """Term frequencies of the days that ``changes`` touches, counted and ranked anew.

    Fails if more of a term would be taken back than was counted, as the stored counts then belong to
    other rows than ``before``.
    """
    days = changes.select("date").distinct()
    # A NULL day never was stored under a day.
    stored = frequencies.join(days, "date", "left_semi").select(*_KEY, F.col("frequency").alias("change"))
    total = F.sum("change")
    counted = F.when(total >= 0, total).otherwise(
        F.raise_error(F.concat(F.lit("more taken back than counted of "), F.to_json(F.struct(*_KEY)))).cast("long")
    )
    summed = stored.unionAll(changes.select(*_KEY, "change")).groupBy(*_KEY).agg(counted.alias("frequency"))
    by_frequency = [F.col("frequency").desc(), F.col("term").asc()]
    ranked = rank_all(summed.where("frequency > 0"), ["source", "date"], by_frequency, "rank_in_source")
    return ranked.withColumn("rank_in_source", F.col("rank_in_source").cast("int"))


def touched_days(changes):
    """The days whose counts change; a bounded list, one entry a day."""
    return sorted(r["date"] for r in changes.select("date").distinct().collect() if r["date"] is not None)


def author_sketches(dated, log_size=14):
    """A mergeable sketch of the authors of every source and day; ``log_size`` sets its size and error."""
    return dated.groupBy("source", "date").agg(F.hll_sketch_agg("author", F.lit(log_size)).alias("authors"))


def authors_over(sketches, group=("source",)):
    """Distinct authors over all days of a group, estimated from its daily sketches."""
    return sketches.groupBy(*group).agg(
        F.hll_sketch_estimate(F.hll_union_agg("authors")).alias("authors")
    )
