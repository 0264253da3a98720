"""Quality classifier: a small convolutional network over the bytes of a text, in numpy.

A text is read as UTF-8 bytes and cut into chunks of ``CHUNK + WIDTH - 1`` bytes; neighbours overlap by
``WIDTH - 1`` bytes, so every window of ``WIDTH`` bytes of the whole text lies in one chunk. Learned
filters run over each chunk and are max-pooled in it. A hidden layer combines the pooled filters
of a chunk; its units are averaged and max-pooled over all chunks of the text and give one
probability. Beside the filters, a chunk tells how far it is filled, as the pooled values of a few words
are lower than those of a full chunk.

The network is fitted on a bounded sample of labelled rows (``SAMPLE`` of each class), with all chunks
of their whole texts. Scores use whole texts likewise.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import functions as F

from trendmill.llm.shared import crc_part, id_and_text, map_texts

WIDTH, FILTERS, HIDDEN = 5, 24, 16
CHUNK = 256
#: Labelled rows of each class that the fit uses at most.
SAMPLE = 1200
EPOCHS, BATCH, RATE = 10, 32, 0.01
#: Score from which a text counts as good.
THRESHOLD = 0.3
HELD_OUT_PARTS = 5
#: Chunks that pass through the filters at a time.
_SLAB = 512


@dataclass
class Network:
    """Filters by position and byte, bias, hidden layer, and the output of mean and max units."""

    filters: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    mean_out: np.ndarray
    max_out: np.ndarray
    out_bias: np.ndarray

    def arrays(self):
        return list(vars(self).values())


def chunks_of(data):
    """The chunks of one text as rows of bytes; zeros pad the end, an empty text has one chunk."""
    count = max(1, -(-(len(data) + WIDTH - 1) // CHUNK))
    padded = np.zeros(count * CHUNK + WIDTH - 1, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK + WIDTH - 1)[::CHUNK]


def _fill(chunks):
    """Filled part of each chunk, as a logarithm from 0 to 1."""
    filled = CHUNK - (chunks[:, CHUNK - 1 :: -1] != 0).argmax(axis=1)
    filled = np.where((chunks[:, :CHUNK] != 0).any(axis=1), filled, 0)
    return (np.log1p(filled) / np.log1p(CHUNK)).astype(np.float32)[:, None]


def _activations(chunks, tables, bias):
    """Filter values ``[chunk, place, filter]``; ``tables`` hold pairs of positions, the last may be single."""
    total = None
    for j, pairs in enumerate(tables):
        codes = chunks[:, 2 * j : 2 * j + CHUNK].astype(np.int32)
        if len(pairs) > 256:
            codes = codes * 256 + chunks[:, 2 * j + 1 : 2 * j + 1 + CHUNK]
        part = np.take(pairs, codes, axis=0)
        total = part if total is None else np.add(total, part, out=total)
    return np.add(total, bias, out=total)


def _tables(filters):
    """Sums of two neighbouring positions' filters for every pair of bytes halve the lookups."""
    tables = [
        (filters[j][:, None, :] + filters[j + 1][None, :, :]).reshape(65536, -1)
        for j in range(0, WIDTH - 1, 2)
    ]
    return tables + ([filters[WIDTH - 1]] if WIDTH % 2 else [])


def _pooled(chunks, tables, bias):
    return np.concatenate([
        _activations(chunks[i : i + _SLAB], tables, bias).max(axis=1)
        for i in range(0, len(chunks), _SLAB)
    ])


def _combine(net, pooled, fill, starts, counts):
    """Probability of each text from the pooled filters of its chunks, and what the fit needs."""
    bounded = np.concatenate([np.tanh(pooled), fill], axis=1)
    units = np.maximum(bounded @ net.hidden + net.hidden_bias, 0)
    means = np.add.reduceat(units, starts, axis=0) / counts[:, None]
    tops = np.maximum.reduceat(units, starts, axis=0)
    logit = means @ net.mean_out + tops @ net.max_out + net.out_bias[0]
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30))), bounded, units, means, tops


def _starts(counts):
    return np.concatenate([[0], np.cumsum(counts)[:-1]])


def fit(samples, wanted, weights, seed=7):
    """A network from texts as bytes, 0/1 labels and row weights; Adam steps."""
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, FILTERS**-0.5, (FILTERS + 1, HIDDEN)).astype(np.float32),
        np.zeros(HIDDEN, np.float32),
        rng.normal(0, 0.2, HIDDEN).astype(np.float32),
        rng.normal(0, 0.2, HIDDEN).astype(np.float32),
        np.zeros(1, np.float32),
    )
    first = [np.zeros_like(a) for a in net.arrays()]
    second = [np.zeros_like(a) for a in net.arrays()]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(samples))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            step += 1
            grads = _slopes(net, [chunks_of(samples[i]) for i in pick], wanted[pick], weights[pick])
            for a, g, m, v in zip(net.arrays(), grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                a -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _slopes(net, samples, wanted, weights):
    """Gradients of the weighted log loss, in the order of ``Network``; only maxima pass them on."""
    chunks, counts = np.concatenate(samples), np.array([len(s) for s in samples])
    starts, owner = _starts(counts), np.repeat(np.arange(len(samples)), counts)
    place = np.empty((len(chunks), FILTERS), np.int64)
    pooled = np.empty((len(chunks), FILTERS), np.float32)
    for at in range(0, len(chunks), _SLAB):
        some = chunks[at : at + _SLAB]
        values = np.zeros((len(some), CHUNK, FILTERS), np.float32)
        for j in range(WIDTH):
            values += np.take(net.filters[j], some[:, j : j + CHUNK], axis=0)
        place[at : at + _SLAB] = best = values.argmax(axis=1)
        pooled[at : at + _SLAB] = np.take_along_axis(values, best[:, None, :], axis=1)[:, 0] + net.bias
    score, bounded, units, means, tops = _combine(net, pooled, _fill(chunks), starts, counts)

    d_logit = ((score - wanted) * weights / len(samples)).astype(np.float32)
    is_top = units == tops[owner]
    d_units = d_logit[owner, None] * (
        net.mean_out / counts[owner, None] + is_top * net.max_out
    ) * (units > 0)
    d_pooled = ((d_units @ net.hidden.T) * (1 - bounded**2))[:, :FILTERS]
    d_filters = np.empty_like(net.filters)
    lanes = np.arange(FILTERS)
    for j in range(WIDTH):
        seen = np.take_along_axis(chunks, place + j, axis=1).astype(np.int64)
        d_filters[j] = np.bincount(
            (seen * FILTERS + lanes).ravel(), d_pooled.ravel(), 256 * FILTERS
        ).reshape(256, FILTERS)
    return [
        d_filters, d_pooled.sum(0), bounded.T @ d_units, d_units.sum(0),
        means.T @ d_logit, tops.T @ d_logit, np.array([d_logit.sum()]),
    ]


def train(docs, labels, sample=SAMPLE):
    """Fits a network on rows of ``labels`` outside the held-out part.

    Rows are chosen by the hash of their id, ``sample`` of each class at most. Weights restore the
    shares of the classes. Ids labelled twice count with their highest label; null ids and null
    labels take no part. Returns None when a class is missing; :func:`score` then gives 0.5.
    """
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("_quality"))
        .where("doc_id is not null and _quality in (0, 1)")
        .where(crc_part(F.col("doc_id"), HELD_OUT_PARTS) != 0)
        .groupBy("doc_id").agg(F.max("_quality").alias("_quality"))
    )
    classes = {r["_quality"]: r["count"] for r in known.groupBy("_quality").count().collect()}
    if len(classes) < 2:
        return None
    by_hash = F.xxhash64("doc_id")
    chosen = known.where("_quality = 0").orderBy(by_hash, "doc_id").limit(sample).unionAll(
        known.where("_quality = 1").orderBy(by_hash, "doc_id").limit(sample)
    )
    # At most 2 * sample ids.
    texts = id_and_text(docs).join(F.broadcast(chosen), "doc_id")
    # Equal ids with several texts: the one of the smallest hash, so that every run learns the same.
    rows = texts.groupBy("doc_id", "_quality").agg(F.min_by("text", F.xxhash64("text")).alias("text")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    wanted = np.array([r["_quality"] for r in rows], np.float32)
    if len(set(wanted)) < 2:
        return None
    shares = {q: n / sum(classes.values()) / max(1, (wanted == q).sum()) for q, n in classes.items()}
    weights = np.array([shares[int(q)] for q in wanted], np.float32) * len(rows)
    return fit([r["text"].encode() for r in rows], wanted, weights)


def scorer(net):
    """``texts -> probabilities`` for a network, rounded so that no batch of texts sways them."""
    tables = _tables(net.filters)

    def score_texts(texts):
        parts = [chunks_of(t.encode()) for t in texts]
        counts = np.array([len(p) for p in parts])
        chunks = np.concatenate(parts)
        pooled = _pooled(chunks, tables, net.bias)
        return _combine(net, pooled, _fill(chunks), _starts(counts), counts)[0].astype(float).round(6)

    return score_texts


def score(docs, net, threshold=THRESHOLD):
    """``doc_id``, ``score`` and ``predicted`` of every row from its whole text.

    Null and empty texts get the score of one chunk of zeros. Rows with a null or repeated id are
    scored like any other. Without a network every score is 0.5.
    """
    rows = id_and_text(docs)
    if net is None:
        scored = rows.select("doc_id", F.lit(0.5).alias("score"))
    else:
        def make():
            give = scorer(net)
            return lambda texts: {"score": give(texts)}

        scored = map_texts(rows, make, "score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs, net, threshold=THRESHOLD):
    """``docs`` without the rows whose score is below ``threshold``; columns are kept as they are."""
    if net is None:
        return docs
    names = docs.columns
    rows = docs.select(
        *[F.col(n).alias(f"_{i}") for i, n in enumerate(names)],
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def make():
        give = scorer(net)
        return lambda texts: {"_score": give(texts)}

    scored = map_texts(rows, make, "_score double").where(F.col("_score") >= threshold)
    return scored.select(*[F.col(f"_{i}").alias(n) for i, n in enumerate(names)])
