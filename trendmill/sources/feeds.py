"""Landed feed records to bronze rows.

Every function takes a DataFrame with one text column holding one record per row and works the same
on ``spark.read.text(dir)`` and ``spark.readStream.text(dir)``. The text itself is kept as
``_raw_json``, so a bronze row can always be rebuilt.
"""

from pyspark.sql import functions as F

from trendmill import schemas
from trendmill.functions.scalars import after_last, collapse_whitespace, unfold


def _parsed(records, schema, column):
    raw = F.col(column).alias("_raw_json")
    return unfold(records, F.from_json(column, schema), raw)


def stories(records, column="value"):
    """Stories only; an empty reply list becomes NULL."""
    rows = _parsed(records, schemas.STORY_RECORD, column).where(F.col("type") == "story")
    kids = F.when(F.size("kids") > 0, F.to_json("kids"))
    return rows.select(
        F.coalesce("id", F.lit(0)).alias("id"), "by", "title", "url", "score", "time", "type",
        "descendants", kids.alias("kids"), "text", "_raw_json",
    )


def repos(records, column="value"):
    """Owner flattened, topics as JSON text, missing search score as 0."""
    rows = _parsed(records, schemas.REPO_RECORD, column)
    return rows.select(
        F.coalesce("id", F.lit(0)).alias("id"), "name", "full_name", "description", "html_url",
        "stargazers_count", "forks_count", "language", "created_at", "updated_at", "pushed_at",
        F.col("owner.login").alias("owner_login"),
        F.coalesce(F.to_json("topics"), F.lit("[]")).alias("topics"),
        "open_issues_count", F.coalesce("score", F.lit(0.0)).alias("score"), "_raw_json",
    )


def questions(records, column="value"):
    """Owner flattened, tags as JSON text, body left as HTML."""
    rows = _parsed(records, schemas.QUESTION_RECORD, column)
    return rows.select(
        F.coalesce("question_id", F.lit(0)).alias("question_id"), "title", "body",
        F.coalesce(F.to_json("tags"), F.lit("[]")).alias("tags"),
        "score", "view_count", "answer_count", "is_answered", "creation_date", "link",
        F.col("owner.display_name").alias("owner_display_name"),
        F.col("owner.reputation").alias("owner_reputation"), "_raw_json",
    )


def paper_entries(entries):
    """Parsed Atom entries to bronze papers; entries without an id are dropped."""
    names = F.filter(
        F.transform(F.coalesce("author", F.array()), lambda a: F.trim(a["name"])),
        lambda name: F.length(name) > 0,
    )
    terms = F.filter(
        F.transform(F.coalesce("category", F.array()), lambda c: c["_term"]),
        lambda term: F.length(term) > 0,
    )
    alternate = F.get(F.filter("link", lambda x: x["_rel"] == "alternate"), F.lit(0))["_href"]
    link = F.coalesce(
        F.when(alternate != "", alternate), F.get("link", F.lit(0))["_href"], F.lit("")
    )

    def text(name):
        return F.coalesce(F.trim(name), F.lit(""))

    papers = entries.select(
        after_last(text("id"), "/abs/").alias("arxiv_id"),
        collapse_whitespace(text("title")).alias("title"),
        collapse_whitespace(text("summary")).alias("summary"),
        F.to_json(names).alias("authors"),
        text("published").alias("published"),
        text("updated").alias("updated"),
        F.to_json(terms).alias("categories"),
        link.alias("link"),
    )
    return papers.where("arxiv_id <> ''").withColumn("_raw_json", F.to_json(F.struct("*")))


def papers(records, column="value"):
    """Papers from rows holding the XML text of one entry each."""
    return paper_entries(
        unfold(records, F.from_xml(column, schemas.PAPER_ENTRY.simpleString()))
    )


def read_papers(spark, path):
    """Papers from landed Atom files; Spark splits the files by entry."""
    return paper_entries(
        spark.read.schema(schemas.PAPER_ENTRY).option("rowTag", "entry").format("xml").load(path)
    )


READERS = {"stories": stories, "repos": repos, "questions": questions}


def read_feed(spark, kind, path):
    """Bronze rows of a landed JSON-lines feed."""
    return READERS[kind](spark.read.text(path))
