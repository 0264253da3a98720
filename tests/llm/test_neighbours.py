import math

import numpy as np
import pytest

from trendmill.llm import neighbours


def plain(rows, queries, k=20):
    """Nearest by all products, equal ones by id."""
    out = {}
    for q, vector in queries:
        scores = [(-float(np.dot(vector, v)), i) for i, v in rows if i != q]
        out[q] = [i for _, i in sorted(scores)[:k]]
    return out


def test_quantile_of_chi_square():
    assert neighbours.chi_square_quantile(0.95, 2) == pytest.approx(-2 * math.log(0.05))
    assert neighbours.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)


def test_recall_of_the_query(spark, folder):
    from trendmill.llm.queries import op10_projected_neighbours

    rows = [
        (r["vec_id"], np.array(r["embedding"], np.float64))
        for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ]
    found = {}
    for r in op10_projected_neighbours(spark, folder).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    want = plain(rows, [r for r in rows if r[0] % 20 == 0])
    assert found.keys() == want.keys()
    hits = sum(len({v for _, v in found[q]} & set(want[q])) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert all(sorted(r for r, _ in f) == list(range(1, len(f) + 1)) for f in found.values())


def clustered(n, centres, rng):
    vectors = np.repeat(rng.normal(size=(centres, 32)), n // centres, axis=0) + rng.normal(size=(n, 32)) * 0.05
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def recall(vectors, queries, at, found):
    hits = 0
    for i, q in enumerate(queries):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        hits += len(set(found[at == i]) & set(np.argsort(-scores, kind="stable")[:20]))
    return hits / (20 * len(queries))


def test_search_stops_early_on_clustered_rows():
    vectors = clustered(6000, 60, np.random.default_rng(3))
    project, queries = neighbours.projections(32), np.arange(0, 6000, 60)
    tree = neighbours.KdTree(np.arange(6000), vectors, 1.0, project)
    at, found, _ = tree.search(queries, vectors[queries], project)
    assert recall(vectors, queries, at, found) >= 0.9
    assert tree.verified < 0.2 * len(queries) * 6000


def test_search_stops_on_the_given_vectors(spark):
    """Vectors without clusters: the stopping test holds before all rows of 2,000 are verified."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    vectors = np.array([r["embedding"] for r in rows], np.float64)
    longest = (vectors**2).sum(axis=1).max()
    project, queries = neighbours.projections(vectors.shape[1]), np.arange(0, len(rows), 20)
    tree = neighbours.KdTree(np.arange(len(rows)), vectors, longest, project)
    at, found, _ = tree.search(queries, vectors[queries], project)
    assert recall(vectors, queries, at, found) >= 0.9
    assert tree.verified < 0.8 * len(queries) * len(rows)


def test_a_bound_only_lets_better_rows_through():
    vectors = clustered(600, 6, np.random.default_rng(5))
    project = neighbours.projections(32)
    tree = neighbours.KdTree(np.arange(600), vectors, 1.0, project)
    at, found, scores = tree.search(np.array([0, 1]), vectors[:2], project, bounds=np.array([0.999, 2.0]))
    assert not (at == 1).any() and (scores >= 0.999 - 1e-9).all()


def test_queries_reach_few_blocks(spark, monkeypatch):
    """Rows aren't copied; on clustered rows the queries sent grow with the rows, not with rows times blocks."""
    sent, send = [], neighbours._sent

    def counted(*args, **kwargs):
        frame = send(*args, **kwargs)
        sent.append(frame.count())
        return frame

    monkeypatch.setattr(neighbours, "_sent", counted)
    for n in (2000, 8000):
        vectors = clustered(n, n // 100, np.random.default_rng(6))
        rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
        queries, sent[:] = np.arange(0, n, 20), []
        found = neighbours.nearest(rows, rows.where("vec_id % 20 = 0"), rows=125).collect()
        at = np.array([r["query_id"] // 20 for r in found])
        assert recall(vectors, queries, at, np.array([r["vec_id"] for r in found])) >= 0.9
        assert len(found) == n and sent[0] == n // 20
        # 16 and 64 blocks: a query goes to about the same few in both.
        assert sent[1] <= 8 * n // 20


def test_cells_are_even():
    places = np.random.default_rng(7).normal(size=(4096, 8))
    sizes = np.bincount(neighbours.Cells(places, 4).of(places))
    assert len(sizes) == 16 and sizes.min() == sizes.max() == 256


def test_a_cell_that_grew_is_cut_by_hash(spark, monkeypatch):
    """Cuts learned from two places leave cells that are too large; all rows are still found."""
    vectors = clustered(600, 3, np.random.default_rng(8))
    monkeypatch.setattr(neighbours, "SAMPLE", 2)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(rows, rows.where("vec_id % 20 = 0"), rows=20).collect()
    at = np.array([r["query_id"] // 20 for r in found])
    assert len({(r["query_id"], r["vec_id"]) for r in found}) == len(found) == 600
    assert recall(vectors, np.arange(0, 600, 20), at, np.array([r["vec_id"] for r in found])) >= 0.9


def test_ties_blocks_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    hot = [1.0, 0.0, 0.0]
    rows = [(i, hot) for i in range(200)] + [(200 + i, rng.normal(size=3).tolist()) for i in range(100)]
    odd = [
        (None, hot), (400, None), (401, []), (402, [0.0, 0.0, 0.0]), (403, [1.0, None, 0.0]),
        (404, [float("nan"), 1.0, 0.0]), (405, [float("inf"), 1.0, 0.0]), (5, hot), (406, [1.0, 2.0]),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows + odd], "vec_id long, embedding array<double>, score string")
    found = {}
    queries = df.where("vec_id % 20 = 0")
    for r in neighbours.nearest(df, queries, rows=60).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    want = plain(rows, [r for r in rows if r[0] % 20 == 0])
    assert found.keys() == want.keys()
    assert all(found[q] == want[q] for q in want if q < 200)
    assert sum(len(set(found[q]) & set(want[q])) for q in want) >= 0.95 * 20 * len(want)
    assert neighbours.nearest(df.where("1 = 0"), queries).count() == 0
    few = neighbours.nearest(df.where("vec_id between 210 and 214"), df.where("vec_id = 210"))
    assert few.count() == 4
