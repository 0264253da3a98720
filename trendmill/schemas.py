"""Explicit schemas of the landed feeds and of the tables."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(*fields):
    return StructType([StructField(name, kind, nullable) for name, kind, nullable in fields])


def _nullable(kind, *names):
    return [(name, kind, True) for name in names]


_STRINGS = ArrayType(StringType())

# --- landed feed records ----------------------------------------------------------------------
STORY_RECORD = _struct(
    *_nullable(LongType(), "id", "time"),
    *_nullable(StringType(), "by", "title", "url", "type", "text"),
    *_nullable(IntegerType(), "score", "descendants"),
    ("kids", ArrayType(LongType()), True),
)

REPO_RECORD = _struct(
    ("id", LongType(), True),
    *_nullable(StringType(), "name", "full_name", "description", "html_url", "language"),
    *_nullable(StringType(), "created_at", "updated_at", "pushed_at"),
    *_nullable(IntegerType(), "stargazers_count", "forks_count", "open_issues_count"),
    ("owner", _struct(("login", StringType(), True)), True),
    ("topics", _STRINGS, True),
    ("score", DoubleType(), True),
)

QUESTION_RECORD = _struct(
    *_nullable(LongType(), "question_id", "creation_date"),
    *_nullable(StringType(), "title", "body", "link"),
    *_nullable(IntegerType(), "score", "view_count", "answer_count"),
    ("is_answered", BooleanType(), True),
    ("tags", _STRINGS, True),
    (
        "owner",
        _struct(("display_name", StringType(), True), ("reputation", IntegerType(), True)),
        True,
    ),
)

PAPER_ENTRY = _struct(
    *_nullable(StringType(), "id", "title", "summary", "published", "updated"),
    ("author", ArrayType(_struct(("name", StringType(), True))), True),
    ("category", ArrayType(_struct(("_term", StringType(), True))), True),
    ("link", ArrayType(_struct(*_nullable(StringType(), "_rel", "_href"))), True),
)

# --- tables -----------------------------------------------------------------------------------
STORIES_RAW = _struct(
    ("id", LongType(), False),
    *_nullable(StringType(), "by", "title", "url"),
    ("score", IntegerType(), True),
    ("time", LongType(), True),
    ("type", StringType(), True),
    ("descendants", IntegerType(), True),
    *_nullable(StringType(), "kids", "text", "_raw_json"),
)

REPOS_RAW = _struct(
    ("id", LongType(), False),
    *_nullable(StringType(), "name", "full_name", "description", "html_url"),
    *_nullable(IntegerType(), "stargazers_count", "forks_count"),
    *_nullable(StringType(), "language", "created_at", "updated_at", "pushed_at"),
    *_nullable(StringType(), "owner_login", "topics"),
    ("open_issues_count", IntegerType(), True),
    ("score", DoubleType(), True),
    ("_raw_json", StringType(), True),
)

PAPERS_RAW = _struct(
    ("arxiv_id", StringType(), False),
    *_nullable(StringType(), "title", "summary", "authors", "published", "updated"),
    *_nullable(StringType(), "categories", "link", "_raw_json"),
)

QUESTIONS_RAW = _struct(
    ("question_id", LongType(), False),
    *_nullable(StringType(), "title", "body", "tags"),
    *_nullable(IntegerType(), "score", "view_count", "answer_count"),
    ("is_answered", BooleanType(), True),
    ("creation_date", LongType(), True),
    *_nullable(StringType(), "link", "owner_display_name"),
    ("owner_reputation", IntegerType(), True),
    ("_raw_json", StringType(), True),
)

CHECKPOINTS = _struct(
    ("source", StringType(), False),
    *_nullable(StringType(), "last_id", "last_timestamp", "last_batch_id"),
    ("updated_at", TimestampNTZType(), True),
)

SIGNALS = _struct(
    *_nullable(StringType(), "signal_id", "source", "title", "body", "url", "author"),
    ("score", IntegerType(), True),
    ("created_at", TimestampNTZType(), True),
    ("tags", _STRINGS, True),
    ("language", StringType(), True),
    ("_silver_processed_at", TimestampNTZType(), True),
)

QUALITY_LOG = _struct(
    *[(name, StringType(), False) for name in ("log_id", "source", "batch_id")],
    ("total_rows", LongType(), False),
    ("null_counts", StringType(), True),
    ("duplicate_count", LongType(), True),
    ("freshness_hours", DoubleType(), True),
    *_nullable(BooleanType(), "is_fresh", "quality_passed"),
    ("checked_at", TimestampNTZType(), False),
)

ENRICHED = _struct(
    ("signal_id", StringType(), False),
    *_nullable(StringType(), "category", "summary", "sentiment"),
    ("is_emerging", BooleanType(), True),
    ("model_used", StringType(), True),
    ("enriched_at", TimestampNTZType(), True),
)

RUN_LOG = _struct(
    ("step", StringType(), False),
    ("status", StringType(), False),
    ("result", StringType(), True),
    ("duration", DoubleType(), False),
)

TERM_FREQUENCY = _struct(
    *_nullable(StringType(), "term", "source"),
    ("date", DateType(), True),
    ("frequency", LongType(), True),
    ("rank_in_source", IntegerType(), True),
)
