import datetime as dt
import json

from pyspark.sql import functions as F

from trendmill import schemas
from trendmill.functions.scalars import ntz
from trendmill.sources import catalog, feeds, landing


def land(tmp_path, name, *lines):
    folder = tmp_path / name
    folder.mkdir(exist_ok=True)
    (folder / f"{len(list(folder.iterdir()))}.json").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_stories_from_files(spark, tmp_path):
    story = {"id": 1, "by": "ann", "title": "é", "score": 5, "time": 10, "type": "story",
             "kids": [2, 3], "extra": 1}
    path = land(
        tmp_path, "stories", json.dumps(story), json.dumps({**story, "id": 2, "kids": []}),
        json.dumps({"id": 3, "type": "job"}), "not json", json.dumps({"type": "story"}),
    )
    frame = feeds.read_feed(spark, "stories", path)
    assert frame.columns == schemas.STORIES_RAW.fieldNames()
    rows = {r.id: r for r in frame.collect()}
    assert set(rows) == {0, 1, 2}
    assert (rows[1].kids, rows[2].kids, rows[1].title) == ("[2,3]", None, "é")
    assert json.loads(rows[1]["_raw_json"]) == story


def test_repos_from_files(spark, tmp_path):
    path = land(
        tmp_path, "repos",
        json.dumps({"id": 1, "full_name": "o/r", "owner": {"login": "o"}, "topics": ["a"],
                    "score": 2}),
        json.dumps({"id": 2, "full_name": "o/s", "owner": None}),
    )
    frame = feeds.read_feed(spark, "repos", path)
    assert frame.columns == schemas.REPOS_RAW.fieldNames()
    rows = {r.id: r for r in frame.collect()}
    assert (rows[1].owner_login, rows[1].topics, rows[1].score) == ("o", '["a"]', 2.0)
    assert (rows[2].owner_login, rows[2].topics, rows[2].score) == (None, "[]", 0.0)


def test_questions_from_files(spark, tmp_path):
    path = land(
        tmp_path, "questions",
        json.dumps({"question_id": 1, "tags": ["x"], "body": "<b>", "is_answered": True,
                    "owner": {"display_name": "eve", "reputation": 9}}),
    )
    frame = feeds.read_feed(spark, "questions", path)
    assert frame.columns == schemas.QUESTIONS_RAW.fieldNames()
    row = frame.first()
    assert (row.tags, row.owner_display_name, row.owner_reputation) == ('["x"]', "eve", 9)


ATOM = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom"><title>feed</title>
<entry><id>http://papers.example/abs/2301.1v2</id><title>A
   title &amp; more</title><summary> text </summary><published>2024-01-01T00:00:00Z</published>
<author><name>Ann</name></author><author><name> Bob </name></author>
<category term="cs.AI"/><category term="cs.LG"/>
<link rel="related" href="pdf"/><link rel="alternate" href="abs"/></entry>
<entry><id>plain-id</id><link href="only"/></entry>
<entry><title>no id</title></entry>
</feed>"""


def test_papers_from_atom_files(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(ATOM)
    frame = feeds.read_papers(spark, str(tmp_path / "feed.xml"))
    assert frame.columns == schemas.PAPERS_RAW.fieldNames()
    rows = {r.arxiv_id: r for r in frame.collect()}
    assert set(rows) == {"2301.1v2", "plain-id"}
    paper = rows["2301.1v2"]
    assert (paper.title, paper.summary, paper.link) == ("A title & more", "text", "abs")
    assert (paper.authors, paper.categories) == ('["Ann","Bob"]', '["cs.AI","cs.LG"]')
    bare = rows["plain-id"]
    assert (bare.title, bare.authors, bare.categories, bare.link) == ("", "[]", "[]", "only")
    assert json.loads(paper["_raw_json"])["title"] == "A title & more"


def test_first_occurrence(spark):
    hits = spark.createDataFrame(
        [("a", 2, 0), ("a", 1, 5), ("a", 1, 4), (None, 1, 0), ("", 1, 1), ("b", 3, 0)],
        "k string, q int, p int",
    )
    rows = landing.first_occurrence(hits, "k", "q", "p").collect()
    assert sorted(map(tuple, rows)) == [("a", 1, 4), ("b", 3, 0)]


def test_pulls_by_id_skip_nothing(spark):
    """Batches taken one after the other cover the feed."""
    feed = spark.range(25).withColumnRenamed("id", "n").orderBy(F.rand(1))
    mark, seen = None, []
    while batch := [r.n for r in landing.newer_ids(feed, "n", mark, 10).collect()]:
        seen += batch
        mark = max(batch)
    assert seen == list(range(25))


def test_pulls_by_time(spark):
    frame = spark.createDataFrame([("2024-01-02", 5), (None, None), ("2024-01-03", 6)],
                                  "t string, e long")
    assert landing.newer_text(frame, "t", "2024-01-02").count() == 1
    assert landing.newer_text(frame, "t", None).count() == 3
    assert landing.newer_epoch(frame, "e", "5").count() == 1
    assert landing.newer_epoch(frame, "e", "soon").count() == 3
    assert landing.newer_epoch(frame, "e", None).count() == 3


def test_append_and_marks(spark, tmp_path):
    path = str(tmp_path / "bronze")
    make = spark.range(3).withColumn("t", F.lit("2024"))
    assert landing.append_bronze(make, path, "s", "b1", ntz("2024-01-01")) == 3
    wider = spark.range(5, 7).withColumns({"t": F.lit("2025"), "new": F.lit(1)})
    assert landing.append_bronze(wider, path, "s", "b2", ntz("2024-01-02")) == 2
    table = landing.read_bronze(spark, path)
    assert table.where("new is null").count() == 3
    mark = landing.read_mark(landing.high_water_mark(table, "id", "t", "2024-02-01"), "s")
    assert (mark["last_id"], mark["last_timestamp"], mark["last_batch_id"]) == ("6", "2025", "b2")
    assert landing.read_mark(landing.high_water_mark(table, "id", "t"), "unknown") == {}
    assert [r.id for r in landing.batch_sample(table, "b1", "id", 2).collect()] == [0, 1]


def test_marks_of_columns_without_values(spark):
    frame = spark.createDataFrame(
        [("s", "b", dt.datetime(2024, 1, 1), None, None)],
        "_source string, _batch_id string, _ingested_at timestamp_ntz, id long, t string",
    )
    row = landing.high_water_mark(frame, "id", "t", "2024-01-01").first()
    assert (row.last_id, row.last_timestamp, row.last_batch_id) == (None, None, "b")


def test_batch_ids_are_stable(spark):
    frame = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),)], "t timestamp_ntz")
    made = [frame.select(landing.batch_id(F.lit("s"), "t", F.lit(7))).first()[0] for _ in range(2)]
    assert made[0] == made[1] and made[0].startswith("s_20240102_030405_")
    assert len(made[0].rsplit("_", 1)[1]) == 8


def test_catalog(spark):
    catalog.create_databases(spark, ["bronze_test"])
    name = "bronze_test.checkpoints"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert catalog.create_table(spark, name, schemas.CHECKPOINTS, properties={"made.by": "test"})
    assert not catalog.create_table(spark, name, schemas.CHECKPOINTS)
    assert spark.table(name).columns == schemas.CHECKPOINTS.fieldNames()
    parted = "bronze_test.parted"
    spark.sql(f"DROP TABLE IF EXISTS {parted}")
    catalog.create_table(spark, parted, schemas.TERM_FREQUENCY, ["date"])
    row = spark.createDataFrame(
        [("t", "s", 1, 1, dt.date(2024, 1, 1))],
        "term string, source string, frequency long, rank_in_source int, date date",
    )
    row.write.insertInto(parted)
    tables = catalog.open_tables(spark, [name, parted, "bronze_test.missing"])
    counts = {r["table"]: r.row_count for r in catalog.row_counts(spark, tables).collect()}
    assert counts == {name: 0, parted: 1, "bronze_test.missing": -1}
    spark.sql("DROP DATABASE bronze_test CASCADE")
