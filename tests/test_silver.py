import datetime as dt
import hashlib

from pyspark.sql import functions as F

from trendmill import constants as c
from trendmill import schemas
from trendmill.plans import silver

EARLY, LATE = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
DONE = dt.datetime(2024, 1, 3)


def bronze(spark, schema, *rows):
    """Bronze rows from dicts; columns left out are NULL."""
    names = schema.fieldNames()
    loose = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in schema.fields)
    data = [tuple(r.get(n) for n in names) + (r["at"],) for r in rows]
    return spark.createDataFrame(data, loose + "_ingested_at timestamp_ntz")


def signals(frame):
    return {r["title"]: r for r in frame.collect()}


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def stamp():
    return F.lit(DONE)


def test_stories(spark):
    frame = bronze(
        spark, schemas.STORIES_RAW,
        dict(id=1, title="low", score=3, time=1704067200, by="ann", url="u", at=LATE),
        dict(id=1, title="high", score=9, time=1704067200, by="ann", text="x", at=EARLY),
        dict(id=2, title="older", score=5, url="u2", at=EARLY),
        dict(id=2, title="newer", score=5, url="u2", at=LATE),
    )
    got = signals(silver.stories_to_signals(frame, stamp()))
    assert set(got) == {"high", "newer"}
    row = got["high"]
    assert row.signal_id == md5("hackernews1") and row.source == "hackernews"
    assert row.url == "https://news.ycombinator.com/item?id=1"
    assert (row.author, row.score, row.body) == ("ann", 9, "x")
    assert row.created_at == dt.datetime(2024, 1, 1) and row.tags == [] and row.language is None
    assert got["newer"].created_at is None


def test_repos(spark):
    frame = bronze(
        spark, schemas.REPOS_RAW,
        dict(id=1, full_name="o/r", name="first", stargazers_count=99, at=EARLY),
        dict(id=1, full_name="o/r", name="second", stargazers_count=7, topics='["x","y"]',
             created_at="2024-01-01T10:00:00Z", owner_login="o", language="Go", at=LATE),
        dict(id=2, full_name="o/s", name="broken", topics="oops", created_at="?", at=LATE),
    )
    got = signals(silver.repos_to_signals(frame, stamp()))
    assert set(got) == {"second", "broken"}
    row = got["second"]
    assert (row.signal_id, row.score, row.tags) == (md5("githubo/r"), 7, ["x", "y"])
    assert row.created_at == dt.datetime(2024, 1, 1, 10) and row.author == "o"
    assert got["broken"].tags == [] and got["broken"].created_at is None


def test_papers(spark):
    frame = bronze(
        spark, schemas.PAPERS_RAW,
        dict(arxiv_id="1", title="a", authors='["Ann","Bob"]', categories='["cs.AI"]',
             published="2024-01-01T00:00:00Z", at=EARLY),
        dict(arxiv_id="2", title="b", authors="[]", at=EARLY),
    )
    got = signals(silver.papers_to_signals(frame, stamp()))
    assert (got["a"].author, got["a"].score, got["a"].tags) == ("Ann", 0, ["cs.AI"])
    assert got["b"].author == "unknown"


def test_questions(spark):
    frame = bronze(
        spark, schemas.QUESTIONS_RAW,
        dict(question_id=1, title="q", body="<p>Why</p>?", tags='["python","spark"]', score=2,
             creation_date=1704067200, at=EARLY),
        dict(question_id=2, title="r", tags="[]", owner_display_name="eve", at=EARLY),
    )
    got = signals(silver.questions_to_signals(frame, stamp()))
    assert (got["q"].body, got["q"].language, got["q"].author) == (" Why ?", "python", "anonymous")
    assert (got["r"].language, got["r"].author) == (None, "eve")


def test_unify(spark):
    story = bronze(spark, schemas.STORIES_RAW, dict(id=1, title="s", score=1, at=EARLY))
    paper = bronze(spark, schemas.PAPERS_RAW, dict(arxiv_id="1", title="p", at=EARLY))
    frame = silver.unify({c.STORIES: story, c.PAPERS: paper, "other": story}, stamp())
    assert frame.count() == 2
    assert frame.columns == schemas.SIGNALS.fieldNames()
    assert [t for _, t in frame.dtypes] == [f.dataType.simpleString() for f in schemas.SIGNALS]
    assert {r["_silver_processed_at"] for r in frame.collect()} == {DONE}


def test_breakdown_and_latest(spark):
    story = bronze(
        spark, schemas.STORIES_RAW,
        dict(id=1, title="s", score=1, time=10, at=EARLY),
        dict(id=2, title="t", score=4, time=20, at=EARLY),
    )
    frame = silver.stories_to_signals(story, stamp())
    row = silver.breakdown(frame).first()
    assert (row["count"], row["avg_score"]) == (2, 2.5)
    assert [r["title"] for r in silver.latest(frame, 1).collect()] == ["t"]
