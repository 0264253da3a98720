"""Bronze rows of each source to the unified signals table."""

from functools import reduce

from pyspark.sql import functions as F

from trendmill import constants as c
from trendmill.functions.scalars import (
    as_column,
    epoch_to_timestamp,
    first_element,
    iso_to_timestamp,
    json_strings,
    strip_html,
    surrogate_key,
    utc_now,
)
from trendmill.operators.dedup import keep_best, keep_latest


def _signals(rows, source, native_id, processed_at, carry, **columns):
    stamp = utc_now() if processed_at is None else as_column(processed_at)
    return rows.select(
        surrogate_key(source, native_id).alias("signal_id"),
        F.lit(source).alias("source"),
        *[
            columns[name].alias(name)
            for name in ("title", "body", "url", "author", "score", "created_at", "tags")
        ],
        columns["language"].alias("language"),
        stamp.cast("timestamp_ntz").alias("_silver_processed_at"),
        *carry,
    )


def stories_to_signals(bronze, processed_at=None, each=False, carry=()):
    """Best-scored row per story; the item page stands in for a missing url."""
    rows = bronze if each else keep_best(bronze, ["id"], ties=["title", "url", "text"])
    fallback = F.concat(F.lit(c.STORY_URL_PREFIX), F.col("id").cast("string"))
    return _signals(
        rows, c.STORIES, "id", processed_at, carry,
        title=F.col("title"), body=F.col("text"), url=F.coalesce("url", fallback),
        author=F.col("by"), score=F.col("score").cast("int"),
        created_at=epoch_to_timestamp("time"), tags=F.array().cast("array<string>"),
        language=F.lit(None).cast("string"),
    )


def repos_to_signals(bronze, processed_at=None, each=False, carry=()):
    """Newest row per repository, stars as score, topics as tags."""
    rows = bronze if each else keep_latest(bronze, ["full_name"], ties=["id", "stargazers_count", "description"])
    return _signals(
        rows, c.REPOS, "full_name", processed_at, carry,
        title=F.col("name"), body=F.col("description"), url=F.col("html_url"),
        author=F.col("owner_login"), score=F.col("stargazers_count").cast("int"),
        created_at=iso_to_timestamp("created_at"), tags=json_strings("topics"),
        language=F.col("language"),
    )


def papers_to_signals(bronze, processed_at=None, each=False, carry=()):
    """Newest row per paper; papers carry no engagement, so their score is 0."""
    rows = bronze if each else keep_latest(bronze, ["arxiv_id"], ties=["title", "summary", "link"])
    return _signals(
        rows, c.PAPERS, "arxiv_id", processed_at, carry,
        title=F.col("title"), body=F.col("summary"), url=F.col("link"),
        author=first_element(json_strings("authors"), "unknown"), score=F.lit(0),
        created_at=iso_to_timestamp("published"), tags=json_strings("categories"),
        language=F.lit(None).cast("string"),
    )


def questions_to_signals(bronze, processed_at=None, each=False, carry=()):
    """Best-scored row per question, body without HTML, first tag as language."""
    rows = bronze if each else keep_best(bronze, ["question_id"], ties=["title", "body", "link"])
    tags = json_strings("tags")
    return _signals(
        rows, c.QUESTIONS, "question_id", processed_at, carry,
        title=F.col("title"), body=strip_html("body"), url=F.col("link"),
        author=F.coalesce("owner_display_name", F.lit("anonymous")),
        score=F.col("score").cast("int"), created_at=epoch_to_timestamp("creation_date"),
        tags=tags, language=first_element(tags),
    )


TRANSFORMS = {
    c.STORIES: stories_to_signals,
    c.REPOS: repos_to_signals,
    c.PAPERS: papers_to_signals,
    c.QUESTIONS: questions_to_signals,
}


#: How each source picks one row a key: whether the score counts, and what decides between equals before the signal's
#: own body and url do. A story's text, a repository's description, and a paper's summary and link are those.
_PICKS = {
    c.STORIES: (True, ("title", "url")),
    c.REPOS: (False, ("id", "stargazers_count")),
    c.PAPERS: (False, ("title",)),
    c.QUESTIONS: (True, ("title", "body")),
}
#: Order in which rows of one signal are preferred, for rows of :func:`fetched_signals`; what is added to a signal for it.
PREFERENCE = ("_by_score", "_fetched_at", "_ties")
#: What goes on where these are equal.
LAST_TIES = ("body", "url")
_NO_SCORE = -(2**40)


def fetched_signals(source, bronze, processed_at=None):
    """Every bronze row as a signal, with the columns that say which row of a signal is preferred.

    Needs no other row, so it works on streams. Highest ``_by_score``, then ``_fetched_at``, then the smallest
    ``_ties``, then :data:`LAST_TIES` is the row that the source's transform would keep. ``_ties`` doesn't repeat the
    long texts that the signal holds anyway.
    """
    by_score, ties = _PICKS[source]
    kinds = dict(bronze.dtypes)
    texts = [
        F.lpad(F.col(t).cast("string"), 20, "0") if kinds[t] in ("int", "bigint") else F.col(t).cast("string")
        for t in ties
    ]
    score = F.coalesce(F.col("score").cast("long"), F.lit(_NO_SCORE)) if by_score else F.lit(0).cast("long")
    return TRANSFORMS[source](
        bronze, processed_at, each=True,
        carry=[score.alias("_by_score"), F.col("_ingested_at").alias("_fetched_at"), F.array(*texts).alias("_ties")],
    )


def unify(bronze_by_source, processed_at=None):
    """Signals of all known sources in one DataFrame; unknown sources are skipped."""
    frames = [
        TRANSFORMS[source](bronze, processed_at)
        for source, bronze in bronze_by_source.items()
        if source in TRANSFORMS
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)


def breakdown(signals):
    """Count, average score and newest signal per source."""
    return (
        signals.groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("score").alias("avg_score"),
            F.max("created_at").alias("latest_signal"),
        )
        .orderBy("source")
    )


def latest(signals, rows=10):
    return signals.orderBy(F.col("created_at").desc(), "signal_id").limit(rows)
