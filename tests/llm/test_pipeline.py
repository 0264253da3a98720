import pytest

import corpus_pipeline
from trendmill.llm import contamination, pii
from trendmill.llm.registry import ORACLES, QUERIES
from trendmill.session import written


def test_stages_take_effect_one_after_another(spark):
    # Large enough for the labels to teach something.
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    docs, counts = documents, [documents.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, folder), name)
        assert docs.columns == documents.columns
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4] > 0
    assert contamination.find_leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).count() == 0
    assert pii.find_personal_data(docs).where("size(spans) > 0").count() == 0
    before = {r["doc_id"]: r for r in documents.collect()}
    for row in docs.collect():
        source = before[row["doc_id"]]
        spans = pii.spans_of(source["text"])
        assert row["text"] == pii.masked(source["text"], spans)
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert tokens.count() == counts[-1]
    assert corpus_pipeline.run(spark, folder).exceptAll(tokens).count() == 0


def test_stages_take_odd_rows(spark, folder, odd, none):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, none):
            out = stage(spark, docs, folder)
            out.collect()
            if name != "tokens":
                assert out.columns == docs.columns


def test_queries_are_registered():
    from trendmill.llm import queries  # noqa: F401

    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in QUERIES and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ["op3_simhash_decontamination", "op5_recompression_repeats"])
def test_queries_equal_their_sql(spark, folder, name):
    from tests.compare import connect, differences

    assert differences(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) == ""
