"""Terms of a signal: its tags and the significant words of its title."""

import string

from pyspark.sql import functions as F

from trendmill.constants import STOP_WORDS


def tag_terms(signals, *keep):
    """One row per usable tag. The length test comes before the trim."""
    return (
        signals.select(*keep, F.explode("tags").alias("_raw"))
        .where(F.length("_raw") > 1)
        .select(*keep, F.lower(F.trim("_raw")).alias("term"))
    )


# Listed one by one, Java looks characters up in a table; it tries ranges in turn, which takes ten times as long.
_UNUSABLE = f"[^{string.ascii_lowercase}{string.digits}+#]"


def clean_word(word):
    return F.regexp_replace(word, _UNUSABLE, "")


def all_terms(signals, *keep):
    """Tag terms and title words from one scan of the signals.

    Both word lists are laid side by side and exploded together, so the table is read once and not
    once per list. Title words need four characters before cleaning and three after it.
    """
    lists = F.array(
        F.struct(F.lit(False).alias("is_title"), F.col("tags").alias("words")),
        F.struct(F.lit(True).alias("is_title"), F.split(F.lower("title"), r"\s+").alias("words")),
    )
    words = signals.select(*keep, F.explode(lists).alias("_list")).select(
        *keep, F.col("_list.is_title").alias("_is_title"), F.explode("_list.words").alias("_raw")
    )
    long_enough = F.length("_raw") >= F.when(F.col("_is_title"), 4).otherwise(2)
    term = F.when(F.col("_is_title"), clean_word(F.col("_raw"))).otherwise(
        F.lower(F.trim("_raw"))
    )
    # A filter on a computed column is pushed below the projection and computes the column again;
    # a one-element explode keeps the cleaning to one evaluation per word.
    return (
        words.where(long_enough)
        .select(*keep, "_is_title", F.explode(F.array(term)).alias("term"))
        .where(
            ~F.col("_is_title")
            | ((F.length("term") >= 3) & ~F.col("term").isin(STOP_WORDS))
        )
        .select(*keep, "term")
    )
