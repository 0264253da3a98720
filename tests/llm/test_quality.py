import zlib

import numpy as np
import pytest

from trendmill.llm import quality
from trendmill.llm.queries import op1_byte_cnn_quality


def test_chunks_cover_every_window():
    data = bytes(range(1, 256)) * 5
    chunks = quality.chunks_of(data)
    windows = {bytes(c[i : i + quality.WIDTH]) for c in chunks for i in range(quality.CHUNK)}
    assert {data[i : i + quality.WIDTH] for i in range(len(data) - quality.WIDTH + 1)} <= windows
    assert len(quality.chunks_of(b"")) == 1


def test_pair_tables_give_the_filters_sums():
    rng = np.random.default_rng(1)
    filters = rng.normal(size=(quality.WIDTH, 256, quality.FILTERS)).astype(np.float32)
    chunks = quality.chunks_of(rng.integers(1, 256, 700, dtype=np.uint8).tobytes())
    fast = quality._activations(chunks, quality._tables(filters), np.zeros(quality.FILTERS, np.float32))
    plain = sum(filters[j][chunks[:, j : j + quality.CHUNK]] for j in range(quality.WIDTH))
    assert np.allclose(fast, plain, atol=1e-4)


def test_slopes_agree_with_differences():
    rng = np.random.default_rng(2)
    texts = [rng.integers(97, 123, n, dtype=np.uint8).tobytes() for n in (30, 400)]
    samples = [quality.chunks_of(t) for t in texts]
    wanted, weights = np.array([1.0, 0.0], np.float32), np.ones(2, np.float32)
    net = quality.fit(texts, wanted, weights, seed=3)

    def loss():
        chunks = np.concatenate(samples)
        counts = np.array([len(s) for s in samples])
        pooled = quality._pooled(chunks, quality._tables(net.filters), net.bias)
        p = quality._combine(net, pooled, quality._fill(chunks), quality._starts(counts), counts)[0]
        return -np.mean(wanted * np.log(p) + (1 - wanted) * np.log(1 - p))

    grads = quality._slopes(net, samples, wanted, weights)
    for array, grad in zip(net.arrays()[2:], grads[2:]):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        before, step = array[at], 1e-3
        array[at] = before + step
        up = loss()
        array[at] = before - step
        down = loss()
        array[at] = before
        assert (up - down) / (2 * step) == pytest.approx(grad[at], rel=0.05, abs=1e-4)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = quality.score(docs, quality.train(docs, labels)).join(labels, "doc_id").collect()
    assert all(0 <= r["score"] <= 1 for r in scored)
    held = [r for r in scored if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([r["predicted"] == r["quality"] for r in held]) >= 0.93


def _plain_score(net, data):
    """The network's probability by loops over places, without tables or shared chunks."""
    count = max(1, -(-(len(data) + quality.WIDTH - 1) // quality.CHUNK))
    padded = data + bytes(count * quality.CHUNK + quality.WIDTH - 1 - len(data))
    units = []
    for c in range(count):
        chunk = padded[c * quality.CHUNK : (c + 1) * quality.CHUNK + quality.WIDTH - 1]
        best = np.full(quality.FILTERS, -np.inf)
        for i in range(quality.CHUNK):
            best = np.maximum(best, sum(net.filters[j][chunk[i + j]] for j in range(quality.WIDTH)))
        fill = quality._fill(np.frombuffer(chunk, np.uint8)[None])[0]
        pooled = np.append(np.tanh(best + net.bias), fill)
        units.append(np.maximum(pooled @ net.hidden + net.hidden_bias, 0))
    logit = np.mean(units, 0) @ net.mean_out + np.max(units, 0) @ net.max_out + net.out_bias[0]
    return 1 / (1 + np.exp(-logit))


def test_query_equals_plain_convolution(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    net = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    found = {r["doc_id"]: r for r in op1_byte_cnn_quality(spark, folder).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    assert set(found) == set(texts)
    for doc_id, row in found.items():
        assert row["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert row["predicted"] == int(row["score"] >= 0.3)
    for doc_id in sorted(texts)[::20]:
        assert found[doc_id]["score"] == pytest.approx(_plain_score(net, texts[doc_id].encode()), abs=2e-4)


def test_odd_rows_and_missing_labels(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    net = quality.train(docs, labels)
    rows = quality.score(odd, net).collect()
    assert len(rows) == odd.count()
    same = [r["score"] for r in rows if r["doc_id"] == 1]
    assert same[0] == same[1]
    assert len({r["score"] for r in rows if r["doc_id"] in (2, 3)}) == 1
    assert quality.score(none, net).count() == 0
    assert quality.train(docs, labels.where("1 = 0")) is None
    assert {r["score"] for r in quality.score(odd, None).collect()} == {0.5}
    assert quality.keep_good(odd, net).columns == odd.columns
