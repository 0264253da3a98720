"""Signals and feed records derived from a folder of general-purpose parquet tables.

They give the feeds and tables of this package a data source of any size: every derived row comes
from a row of ``events``, ``documents``, ``pages``, ``conversations`` or ``labels``.
"""

import datetime as dt

from pyspark.sql import functions as F

from trendmill import constants as c
from trendmill.functions.scalars import ntz, strip_html, surrogate_key

AS_OF = "2024-02-01"
FIRST_DAY = "2024-01-01"
LAST_DAY = "2024-01-30"
BASE = dt.datetime(2024, 1, 1)
_EPOCH = dt.datetime(1970, 1, 1)
_NO_TAGS = "array<string>"


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text(column):
    return F.col(column).cast("string")


def spread_day(id_column):
    """A creation time for tables without one: days of January by id."""
    return F.timestamp_add("DAY", F.pmod(F.col(id_column), F.lit(30)), ntz(BASE))


def seconds(timestamp):
    return F.timestamp_diff("SECOND", ntz(_EPOCH), timestamp)


def iso(timestamp):
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def page_title():
    return F.regexp_extract("html", "<title>([^<]*)</title>", 1)


def page_host():
    return F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1)


def page_lang():
    return F.regexp_extract("html", '<html[^>]*lang="([^"]*)"', 1)


def props_key():
    return F.get_json_object("props", "$.k")


def _signals(rows, source, native_id, title, body, url, author, score, created, tags, language):
    return rows.select(
        surrogate_key(source, native_id).alias("signal_id"),
        F.lit(source).alias("source"),
        title.alias("title"),
        body.alias("body"),
        url.alias("url"),
        author.alias("author"),
        score.cast("int").alias("score"),
        created.alias("created_at"),
        tags.alias("tags"),
        language.alias("language"),
    )


def event_signals(events):
    return _signals(
        events, "events", F.col("event_id"), F.col("event_type"), F.col("props"),
        F.concat(F.lit("event://"), text("event_id")), text("user_id"), F.floor("value"),
        F.col("ts").cast("timestamp_ntz"),
        F.array("event_type", F.concat(F.lit("k"), props_key())), F.lit(None).cast("string"),
    )


def document_signals(documents):
    return _signals(
        documents, "documents", F.col("doc_id"), F.col("text"), F.col("text"),
        F.concat(F.lit("doc://"), text("doc_id")), F.col("source"), F.col("n_chars"),
        spread_day("doc_id"), F.array("lang", "source"), F.col("lang"),
    )


def page_signals(pages):
    return _signals(
        pages, "pages", F.col("page_id"), page_title(), strip_html("html"), F.col("url"),
        page_host(), F.lit(0), spread_day("page_id"), F.array(page_lang()), page_lang(),
    )


def turn_signals(conversations):
    native = F.concat_ws(":", "conv_id", "turn")
    return _signals(
        conversations, "conversations", native, F.col("text"), F.col("text"),
        F.concat(F.lit("conv://"), native), F.col("role"), F.col("turn"), spread_day("conv_id"),
        F.array().cast(_NO_TAGS), F.lit(None).cast("string"),
    )


def signals(spark, folder):
    """The signals table over all four sources."""
    return (
        event_signals(table(spark, folder, "events"))
        .unionByName(document_signals(table(spark, folder, "documents")))
        .unionByName(page_signals(table(spark, folder, "pages")))
        .unionByName(turn_signals(table(spark, folder, "conversations")))
    )


# --- feed records as they would land ----------------------------------------------------------
def _as_json(rows, **fields):
    record = F.struct(*[column.alias(name) for name, column in fields.items()])
    return rows.withColumn("value", F.to_json(record))


def story_records(events, score=None, body=None):
    """Story items from events; errors play the items that are not stories."""
    kind = F.col("event_type")
    return _as_json(
        events,
        id=F.col("event_id"), by=text("user_id"), title=kind,
        url=F.when(kind != "view", F.concat(F.lit("event://"), text("event_id"))),
        score=(F.floor("value") if score is None else score).cast("int"),
        time=seconds(F.col("ts").cast("timestamp_ntz")),
        type=F.when(kind == "error", "comment").otherwise("story"),
        descendants=F.length("props"),
        kids=F.when(kind == "signup", F.array().cast("array<bigint>")).otherwise(
            F.array("event_id", "user_id")
        ),
        text=F.col("props") if body is None else body,
    )


def story_records_again(events):
    """The same items fetched again: purchases gain a point, clicks keep theirs, others lose one."""
    kind = F.col("event_type")
    change = F.when(kind == "purchase", 1).when(kind == "click", 0).otherwise(-1)
    return story_records(
        events, F.floor("value") + change, F.concat(F.col("props"), F.lit(" again"))
    )


def story_records_with_extra(events):
    """Story items as a later version of a feed might send them, with an object that no column reads."""
    value = F.concat(
        F.expr("left(value, length(value) - 1)"), F.lit(',"extra":'), F.coalesce("props", F.lit("null")), F.lit("}")
    )
    return story_records(events).withColumn("value", value)


def repo_records(documents, more_stars=0):
    created = spread_day("doc_id")
    return _as_json(
        documents,
        id=F.col("doc_id"), name=F.col("text"),
        full_name=F.concat_ws("/", "source", text("doc_id")), description=F.col("text"),
        html_url=F.concat(F.lit("doc://"), text("doc_id")),
        stargazers_count=(F.col("n_chars") + more_stars).cast("int"),
        forks_count=F.length("source"), language=F.col("lang"), created_at=iso(created),
        updated_at=iso(created), pushed_at=iso(F.timestamp_add("DAY", F.lit(1), created)),
        owner=F.struct(F.col("source").alias("login")),
        topics=F.when(F.col("lang") != "es", F.array("lang", "source")),
        open_issues_count=F.length("lang"),
        score=F.when(F.col("lang") != "de", F.col("n_chars") / 2),
    )


def question_records(pages):
    host = page_host()
    secure = F.col("url").startswith("https")
    return _as_json(
        pages,
        question_id=F.col("page_id"), title=page_title(), body=F.col("html"),
        tags=F.when(secure, F.array(page_lang())), score=F.length("url"),
        view_count=F.length("html"), answer_count=F.length(host), is_answered=secure,
        creation_date=seconds(spread_day("page_id")), link=F.col("url"),
        owner=F.when(
            secure, F.struct(host.alias("display_name"), F.length(host).alias("reputation"))
        ),
    )


def _escape(column):
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        column = F.replace(column, F.lit(raw), F.lit(entity))
    return column


def _entry(native, title, summary, authors, published, terms, link):
    """Atom entry text."""
    people = F.transform(
        authors, lambda a: F.concat(F.lit("<author><name>"), _escape(a), F.lit("</name></author>"))
    )
    categories = F.transform(
        terms, lambda t: F.concat(F.lit('<category term="'), _escape(t), F.lit('"/>'))
    )
    return F.concat(
        F.lit('<entry xmlns="http://www.w3.org/2005/Atom"><id>http://papers.example/abs/'),
        _escape(native), F.lit("</id><title>"), _escape(title), F.lit("</title><summary>"),
        _escape(summary), F.lit("</summary><published>"), published,
        F.lit("</published><updated>"), published, F.lit("</updated>"),
        F.array_join(people, ""), F.array_join(categories, ""),
        F.lit('<link rel="related" href="http://papers.example/pdf"/><link rel="alternate" href="'),
        _escape(link), F.lit('"/></entry>'),
    )


def document_entries(documents):
    published = iso(spread_day("doc_id"))
    return documents.withColumn(
        "value",
        _entry(
            text("doc_id"), F.col("text"), F.col("text"),
            F.array("source", F.concat(F.lit("co-"), F.col("source"))), published,
            F.array("lang"), F.concat(F.lit("doc://"), text("doc_id")),
        ),
    )


def turn_entries(conversations):
    native = F.concat_ws(":", "conv_id", "turn")
    people = F.when(F.col("role") == "system", F.array().cast(_NO_TAGS)).otherwise(F.array("role"))
    return conversations.withColumn(
        "value",
        _entry(
            native, F.col("text"), F.col("text"), people, iso(spread_day("conv_id")),
            F.array("role", F.lit("turn")), F.concat(F.lit("conv://"), native),
        ),
    )


# --- enrichment -------------------------------------------------------------------------------
def enriched(labels):
    """Enrichment rows for the labelled documents."""
    doc = F.col("doc_id")
    taxonomy = F.array(*[F.lit(name) for name in c.CATEGORIES])
    failed = F.pmod(doc, F.lit(17)) == 0
    category = F.when(failed, F.lit(c.ERROR_CATEGORY)).otherwise(
        F.get(taxonomy, F.pmod(doc, F.lit(len(c.CATEGORIES))).cast("int"))
    )
    sentiment = (
        F.when(F.col("toxic") == 1, "negative")
        .when(F.col("quality") == 1, "positive")
        .otherwise("neutral")
    )
    return labels.select(
        surrogate_key("documents", "doc_id").alias("signal_id"),
        category.alias("category"),
        F.concat(F.lit("Summary of document "), text("doc_id")).alias("summary"),
        sentiment.alias("sentiment"),
        ((F.col("quality") == 1) & ~failed).alias("is_emerging"),
        F.lit("labels").alias("model_used"),
        spread_day("doc_id").alias("enriched_at"),
    )


def responses(labels):
    """Response texts as a model might give them: plain, fenced, cut off, or off the taxonomy."""
    doc = F.col("doc_id")
    made = enriched(labels)
    named = made.select(
        "signal_id",
        F.to_json(
            F.struct("category", "summary", "sentiment", "is_emerging")
        ).alias("plain"),
        F.regexp_extract("summary", "([0-9]+)$", 1).cast("bigint").alias("doc_id"),
    )
    fence = F.concat(F.lit(" ```json\n"), F.col("plain"), F.lit("\n```\n"))
    cut = F.expr("substring(plain, 1, length(plain) - 9)")
    return named.select(
        "signal_id",
        F.when(F.pmod(doc, F.lit(19)) == 0, cut)
        .when(F.pmod(doc, F.lit(5)) == 0, fence)
        .otherwise(F.col("plain"))
        .alias("response"),
    )
