import datetime as dt
import json
import os

from pyspark.sql import functions as F

from contract import streams
from trendmill import constants as c

from trendmill.functions.scalars import ntz
from trendmill.operators.versions import read_log
from trendmill.streaming import loads


def write(spark, path, rows, schema="k int, score int, t timestamp_ntz"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


T0 = dt.datetime(2024, 1, 1)


def test_each_file_is_read_once(spark, tmp_path):
    land, out, mark = (str(tmp_path / n) for n in ("land", "out", "mark"))
    total = []
    for rows in ([(1, 1, T0), (2, 1, T0)], [], [(3, 1, T0)]):
        if rows:
            write(spark, land, rows)
        stream = loads.landed_parquet(spark, land, files_per_batch=1)
        loads.append_new(stream, out, mark)
        total.append(spark.read.parquet(out).count())
    assert total == [2, 2, 3]


def test_upsert_stream(spark, tmp_path):
    land, log_path, mark = (str(tmp_path / n) for n in ("land", "log", "mark"))
    order = [F.col("score").desc()]

    def run():
        stream = loads.landed_parquet(spark, land).select("k", "score")
        loads.upsert_new(stream, log_path, mark, ["k"], order, clock=lambda: T0)

    write(spark, land, [(1, 5, T0), (1, 9, T0), (2, 1, T0), (None, 1, T0)])
    run()
    write(spark, land, [(1, 7, T0), (3, 3, T0)])
    run()
    run()
    log = read_log(spark, log_path)
    assert sorted(map(tuple, loads.current_rows(log, ["k"]).collect())) == [(1, 7), (2, 1), (3, 3)]
    best = loads.current_rows(log, ["k"], order)
    assert sorted(map(tuple, best.collect())) == [(1, 9), (2, 1), (3, 3)]


def test_repeated_micro_batch_replaces_itself(spark, tmp_path):
    """After losing the progress folder the same batch is written again, without doubling rows."""
    land, out = str(tmp_path / "land"), str(tmp_path / "out")
    (tmp_path / "land").mkdir()
    story = {"id": 1, "type": "story", "title": "t"}
    (tmp_path / "land" / "a.json").write_text(json.dumps(story) + "\n")
    for mark in ("mark1", "mark2"):
        stream = loads.landed_feed(spark, "stories", land, files_per_batch=5)
        loads.append_bronze_new(stream, out, str(tmp_path / mark), "stories")
    rows = spark.read.parquet(out).collect()
    assert [(r.id, r["_source"]) for r in rows] == [(1, "stories")]


def test_repeats_across_batches(spark, tmp_path):
    land, out, mark = (str(tmp_path / n) for n in ("land", "out", "mark"))
    for rows in ([(1, 1, T0), (1, 1, T0)], [(1, 2, T0), (2, 1, T0)]):
        write(spark, land, rows)
        stream = loads.landed_parquet(spark, land).withColumn("t", F.col("t").cast("timestamp"))
        loads.append_new(loads.drop_repeats(stream, ["k"], "t", "1 day"), out, mark)
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [1, 2]


# --- state, weeks and checks ------------------------------------------------------------------
def _landed(spark, path, files, schema):
    for n, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{n}")
    return loads.landed_parquet(
        spark, f"{path}/*", spark.createDataFrame([], schema).schema, files_per_batch=1
    )


def test_best_rows_emit_changes_only_and_keep_a_row_a_key(spark, tmp_path):
    files = [[("a", 1.0, 5), ("a", 3.0, 9), ("b", 1.0, 1)], [("a", 2.0, 1), (None, 9.0, 1), ("b", 1.0, 0)],
             [("a", 3.0, 8), ("c", None, 1)]]
    stream = _landed(spark, str(tmp_path / "in"), files, "key string, score double, tie long")
    query = loads.write_changes(
        loads.best_rows(stream, "key", "score", "tie"), str(tmp_path / "out"), str(tmp_path / "progress")
    )
    found = spark.read.schema("key string, score double, tie long, _batch long").parquet(str(tmp_path / "out"))
    assert sorted(tuple(r) for r in found.collect()) == [
        ("a", 3.0, 8, 2), ("a", 3.0, 9, 0), ("b", 1.0, 0, 1), ("b", 1.0, 1, 0),
    ]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 2


def test_late_rows_within_the_watermark_count_and_later_ones_are_told(spark, tmp_path):
    day = lambda d, m=1: dt.datetime(2024, m, d, 12)
    files = [[(day(1), ["xx"]), (day(9), ["xx"])], [(day(5), ["xx"])], [(day(28), ["yy"])], [(day(28), ["-"])], [(day(2), ["xx"])],
             [(day(20, 3), ["-"])], [(day(21, 3), ["-"])]]
    stream = _landed(spark, str(tmp_path / "in"), files, "at timestamp, tags array<string>")
    query = loads.append_new(
        loads.weekly_tags(stream, "at", "7 days"), str(tmp_path / "out"), str(tmp_path / "progress")
    )
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["term"], r["week_start"].day, r["count"]) for r in found) == [("xx", 1, 2), ("xx", 8, 1), ("yy", 22, 1)]
    assert loads.dropped_late(query) == 1


def test_checked_load_logs_each_batch_once(spark, tmp_path):
    files = [[(1, "a"), (None, "b")], [(2, None)]]
    stream = _landed(spark, str(tmp_path / "in"), files, "id long, text string")
    for checkpoint in ("one", "two"):  # a lost checkpoint repeats both batches
        loads.append_checked(
            stream, str(tmp_path / "out"), str(tmp_path / checkpoint), str(tmp_path / "log"), "s", ["id", "text"]
        )
    log = sorted((r["total_rows"], r["null_counts"]) for r in spark.read.parquet(str(tmp_path / "log")).collect())
    assert log == [(1, '{"id": 0, "text": 1}'), (2, '{"id": 1, "text": 0}')]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def _stories(spark, path, rows):
    schema = "id long, by string, title string, url string, text string, score int, time long, _ingested_at timestamp_ntz"
    rows = [(i, "a", title, "u", None, score, 0, T0 + dt.timedelta(days=day)) for i, title, score, day in rows]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def _papers(spark, path, rows):
    schema = (
        "arxiv_id string, title string, summary string, link string, authors string, categories string,"
        " published string, _ingested_at timestamp_ntz"
    )
    rows = [(i, title, "s", "l", "[]", "[]", None, T0 + dt.timedelta(days=day)) for i, title, day in rows]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_one_stream_over_uneven_feeds(spark, tmp_path):
    """A feed nine days behind loses nothing; a row that lands twice and a replayed run change nothing."""
    from trendmill import constants as c
    from trendmill.plans import silver

    stories, papers, mark = (str(tmp_path / n) for n in ("stories", "papers", "mark"))
    name = "uneven_signals"
    spark.sql(f"DROP TABLE IF EXISTS {name}")

    def bronze():
        return {c.STORIES: spark.read.parquet(stories), c.PAPERS: spark.read.parquet(papers)}

    def run(progress=mark):
        streams = {
            c.STORIES: loads.landed_parquet(spark, stories, files_per_batch=1),
            c.PAPERS: loads.landed_parquet(spark, papers, files_per_batch=1),
            "mailing lists": None,
        }
        signals = loads.one_stream(streams, ntz(T0.isoformat()), "1 day")
        loads.upsert_signals(signals, name, progress, buckets=2)
        return sorted(map(tuple, spark.table(name).select("source", "title", "score").collect()))

    def whole():
        rows = silver.unify(bronze(), ntz(T0.isoformat())).select("source", "title", "score")
        return sorted(map(tuple, rows.collect()))

    try:
        _stories(spark, stories, [(1, "old", 5, 9), (2, "two", 1, 9)])
        _papers(spark, papers, [("p", "A", 0), ("q", "Q", 0)])
        assert run() == whole()
        # A text that comes back after another one is the newest again; a lower score doesn't win.
        _stories(spark, stories, [(1, "new", 4, 10), (2, "two", 1, 9)])
        _papers(spark, papers, [("p", "B", 1)])
        _papers(spark, papers, [("p", "A", 2)])
        assert run() == whole() == [("arxiv", "A", 0), ("arxiv", "Q", 0), ("hackernews", "old", 5), ("hackernews", "two", 1)]
        assert run(str(tmp_path / "mark2")) == whole()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


SMALL = "/root/testdata/sf0.001"


def _micro_batches(spark, tmp_path, monkeypatch, query):
    """Micro-batches that a query runs when its tables come, and so land, in eight files each."""
    folder = tmp_path / "many"
    folder.mkdir()
    for name in os.listdir(SMALL):
        if name in ("events.parquet", "documents.parquet"):
            spark.read.parquet(f"{SMALL}/{name}").repartition(8).write.parquet(str(folder / name))
        else:
            (folder / name).symlink_to(f"{SMALL}/{name}")
    work = tmp_path / "work"
    monkeypatch.setattr(streams, "work_path", lambda spark, label: str(work))
    # Every file is a partition of its own.
    spark.conf.set("spark.sql.files.openCostInBytes", "1g")
    try:
        assert query(spark, str(folder)).count()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    return sum(n.isdigit() for progress in work.rglob("progress/commits") for n in os.listdir(progress))


def test_a_landing_of_one_stream_is_a_micro_batch_whatever_its_files(spark, tmp_path, monkeypatch):
    # Four runs, with a batch without rows where the watermark moved.
    assert _micro_batches(spark, tmp_path, monkeypatch, streams.stream_unified) <= 8


def test_state_of_one_stream_tells_rows_apart_by_all_their_digits(spark, tmp_path):
    """Two fetches within a millisecond are two rows; the state's digest must not round their times."""
    schema = "id long, `by` string, title string, url string, score int, time long, text string, _ingested_at timestamp_ntz"
    at = [dt.datetime(2024, 1, 1, 0, 0, 0, micros) for micros in (100, 200, 200)]
    spark.createDataFrame([(1, "a", "t", "u", 5, 0, "x", t) for t in at], schema).write.parquet(f"{tmp_path}/land")
    rows = loads.landed_parquet(spark, f"{tmp_path}/land")
    stream = loads.one_stream({c.STORIES: rows}, ntz(T0.isoformat()))
    loads.append_new(stream, f"{tmp_path}/data", f"{tmp_path}/mark")
    found = spark.read.parquet(f"{tmp_path}/data")
    assert sorted(r["_fetched_at"].microsecond for r in found.collect()) == [100, 200]


def test_a_landing_is_a_micro_batch_for_best_rows(spark, tmp_path, monkeypatch):
    # One each for four landings; state of an aggregate needs no batch without rows.
    assert _micro_batches(spark, tmp_path, monkeypatch, streams.stream_best_row) == 4


def test_best_rows_take_ties_at_both_ends_of_a_long(spark, tmp_path):
    files = [[("a", 1.0, 2**63 - 1), ("a", 1.0, -(2**63)), ("a", float("nan"), 7)]]
    stream = _landed(spark, str(tmp_path / "in"), files, "key string, score double, tie long")
    rows = loads.best_rows(stream.where("not isnan(score)"), "key", "score", "tie")
    loads.write_changes(rows, str(tmp_path / "out"), str(tmp_path / "progress"))
    found = spark.read.schema("key string, score double, tie long").parquet(str(tmp_path / "out"))
    assert [tuple(r) for r in found.select("key", "score", "tie").collect()] == [("a", 1.0, -(2**63))]


def test_a_landing_is_a_micro_batch_for_papers(spark, tmp_path, monkeypatch):
    assert _micro_batches(spark, tmp_path, monkeypatch, streams.stream_papers) == 4


def test_a_landing_is_a_micro_batch_for_reprocessing(spark, tmp_path, monkeypatch):
    assert _micro_batches(spark, tmp_path, monkeypatch, streams.reprocess_equals_incremental) == 2


# --- one stream in parts ----------------------------------------------------------------------
def _story_stream(spark, path, **options):
    rows = loads.landed_parquet(spark, path, spark.read.parquet(path).schema, **options)
    return loads.one_stream({c.STORIES: rows}, ntz(T0.isoformat()))


def test_a_run_of_many_micro_batches_rewrites_the_table_once(spark, tmp_path, monkeypatch):
    """The disk of a run's shuffles is that of a micro-batch; taken files go, and so does what was gathered."""
    land, mark, name, merges = str(tmp_path / "land"), str(tmp_path / "mark"), "parted_signals", []
    merge = loads.upsert_bucketed
    monkeypatch.setattr(loads, "upsert_bucketed", lambda *a, **b: (merges.append(1), merge(*a, **b)))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for n in range(4):
        _stories(spark, land, [(n, "a", 1, 0), (9, f"t{n}", n % 3, 0)])
    left = []

    def taken():
        left.append(len(list((tmp_path / "land").glob("part-*"))))

    try:
        stream = _story_stream(spark, land, bytes_per_batch=1, keep=False)
        query = loads.upsert_signals(stream, name, mark, buckets=2, taken=taken)
        assert query.lastProgress["batchId"] >= 3 and len(merges) == 1 and left[0] <= 1
        found = spark.table(name).select("url", "title", "score").collect()
        assert sorted((r["url"], r["title"], r["score"]) for r in found) == [
            ("u", "a", 1), ("u", "a", 1), ("u", "a", 1), ("u", "a", 1), ("u", "t2", 2)
        ]
        assert not spark.catalog.tableExists(f"{name}__gathered")
        # A run without rows leaves the table as it is.
        loads.upsert_signals(_story_stream(spark, land, keep=False), name, mark, buckets=2)
        assert len(merges) == 1 and spark.table(name).count() == 5
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_what_a_broken_run_gathered_is_merged_by_the_next(spark, tmp_path, monkeypatch):
    land, mark, name = str(tmp_path / "land"), str(tmp_path / "mark"), "broken_signals"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    _stories(spark, land, [(1, "a", 1, 0), (2, "b", 1, 0)])

    def broken():
        raise OSError("broken off")

    try:
        try:
            loads.upsert_signals(_story_stream(spark, land), name, mark, buckets=2, taken=broken)
        except OSError:
            pass
        assert not spark.catalog.tableExists(name)
        loads.upsert_signals(_story_stream(spark, land), name, mark, buckets=2)
        assert sorted(r["title"] for r in spark.table(name).collect()) == ["a", "b"]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_rows_of_a_signal_hold_no_text_twice_and_ties_are_those_of_the_batch(spark, tmp_path):
    """Equal score and time: the smallest link, then text, NULLs first, in whatever order they land."""
    from trendmill.plans import silver

    schema = "arxiv_id string, title string, summary string, link string, authors string, categories string, published string, _ingested_at timestamp_ntz"
    texts = [("t", "s2", "k"), ("t", "s1", "z"), ("t", "s1", "b"), ("t", "s1", None), ("u", None, None), ("t", None, "x")]
    name = "tied_signals"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    land, mark = str(tmp_path / "land"), str(tmp_path / "mark")
    try:
        for n, (title, summary, link) in enumerate(texts):
            row = ("p", title, summary, link, "[]", "[]", None, T0)
            spark.createDataFrame([row], schema).coalesce(1).write.parquet(f"{land}/{n}")
            rows = loads.landed_parquet(spark, f"{land}/*", spark.read.parquet(f"{land}/{n}").schema)
            loads.upsert_signals(loads.one_stream({c.PAPERS: rows}, ntz(T0.isoformat())), name, mark, buckets=2)
            whole = silver.papers_to_signals(spark.read.parquet(f"{land}/*"), ntz(T0.isoformat()))
            kept = spark.table(name).first()
            assert [kept[k] for k in ("title", "body", "url")] == list(whole.select("title", "body", "url").first())
            assert "s1" not in kept["_ties"] and "s2" not in kept["_ties"]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
