"""Nearest neighbours by largest inner product, through a few stable projections and kd-trees.

Inner products become distances: a row gets one more component that brings all rows to the largest
length, a query gets zero there; the nearest row is then the one of the largest inner product.
Gaussian projections (2-stable) take the vectors to ``PROJECTED`` dimensions, where the squared distance
of two points over their true one follows a chi-square law with that many degrees of freedom.

Rows are dealt to blocks by their projected place: median cuts, learned from a bounded sample of places,
give cells of about ``ROWS`` rows, and a cell that grew larger is cut again by hash. Each block has one
kd-tree. A query takes its leaves, and the rows in them, in the order of projected distance, and verifies
rows with the original vectors. It stops where a row as near as the k-th found so far would, with
probability ``CERTAINTY``, have been projected nearer than the next one. Every row is indexed.

A query goes to the block nearest to it first. The k-th product found there is its bound: in a second
round it goes only to blocks that the stopping test leaves open, and they give back only rows that reach
the bound. Each row lies in one block and is never copied; a task holds the rows of one block and a
batch of queries.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from trendmill.llm.shared import on_workers
from trendmill.session import written

K, PROJECTED, LEAF, CERTAINTY, SEED = 20, 16, 64, 0.93, 11
#: Rows of a block, places that cuts are learned from, and blocks at most (then they get larger).
ROWS, SAMPLE, BLOCKS = 8192, 200_000, 65_536
#: Queries whose distances are held at a time, leaves of a first step, copies of queries sent at a time.
_BATCH, _STEP, _SENT = 256, 4, 2048


def chi_square_quantile(share, freedom):
    """The value a chi-square variable with an even ``freedom`` stays below with probability ``share``."""
    low, high = 0.0, 1000.0
    for _ in range(80):
        half = (low + high) / 4
        term = total = 1.0
        for i in range(1, freedom // 2):
            term *= half / i
            total += term
        if 1 - math.exp(-half) * total < share:
            low = (low + high) / 2
        else:
            high = (low + high) / 2
    return high


def projections(dimensions, projected=PROJECTED, seed=SEED):
    return np.random.default_rng(seed).normal(size=(dimensions + 1, projected))


def placed(vectors, longest, project):
    """Projected rows, each with the component that brings it to the largest length."""
    spare = np.sqrt(np.maximum(0, longest - (vectors**2).sum(axis=1)))
    return vectors @ project[:-1] + spare[:, None] * project[-1]


def box_gaps(places, low, high):
    """Squared distances of places from boxes."""
    gaps = np.zeros((len(places), len(low)))
    for i in range(places.shape[1]):
        here = places[:, i, None]
        gaps += np.maximum(0, np.maximum(low[:, i] - here, here - high[:, i])) ** 2
    return gaps


class KdTree:
    """Rows of a block in leaf order, with the box of each leaf in the projected space."""

    def __init__(self, ids, vectors, longest, project, leaf=LEAF):
        self.longest, self.verified = longest, 0
        points = placed(vectors, longest, project)
        leaves, todo = [], [np.arange(len(ids))]
        while todo:
            rows = todo.pop()
            if len(rows) <= leaf:
                leaves.append(rows)
                continue
            part = points[rows]
            axis = np.argmax(part.max(axis=0) - part.min(axis=0))
            half = len(rows) // 2
            order = np.argpartition(part[:, axis], half)
            todo += [rows[order[half:]], rows[order[:half]]]
        order = np.concatenate(leaves)
        self.ids, self.vectors, self.points = ids[order], vectors[order], points[order]
        self.squares = (self.points**2).sum(axis=1)
        self.ends = np.cumsum([len(rows) for rows in leaves])
        self.starts = self.ends - [len(rows) for rows in leaves]
        self.low = np.array([points[rows].min(axis=0) for rows in leaves])
        self.high = np.array([points[rows].max(axis=0) for rows in leaves])

    def search(self, ids, queries, project, k=K, certainty=CERTAINTY, bounds=None):
        """Arrays of query places (in ``ids``), row ids and inner products, at most ``k`` rows a query.

        With ``bounds``, only rows whose product reaches the query's bound.
        """
        reach = chi_square_quantile(certainty, project.shape[1])
        bounds = np.full(len(ids), -np.inf) if bounds is None else bounds
        found = [
            self._batch(i, ids[i : i + _BATCH], queries[i : i + _BATCH], project, k, reach, bounds[i : i + _BATCH])
            for i in range(0, len(ids), _BATCH)
        ]
        return [np.concatenate(c) for c in zip(*found)]

    def _batch(self, start, ids, queries, project, k, reach, bounds):
        places = queries @ project[:-1]
        gaps = box_gaps(places, self.low, self.high)
        order = np.argsort(gaps, axis=1, kind="stable")
        offsets = (queries**2).sum(axis=1) + self.longest
        out = [], [], []
        for q, own in enumerate(ids):
            rows, scores = self._nearest(
                own, queries[q], places[q], order[q], gaps[q], offsets[q], k, reach, bounds[q]
            )
            out[0].append(np.full(len(rows), start + q))
            out[1].append(self.ids[rows])
            out[2].append(scores)
        return [np.concatenate(c) for c in out]

    def _nearest(self, own, query, place, order, gaps, offset, k, reach, kth):
        rows, scores = np.empty(0, np.int64), np.empty(0)
        step, taken = 0, _STEP
        while step < len(order):
            # Equal rows are projected alike up to rounding, so the test leaves some room.
            limit = reach * max(0.0, offset - 2 * kth) + 1e-9 * (1 + offset)
            leaves = order[step : step + taken]
            leaves = leaves[gaps[leaves] <= limit]
            if not len(leaves):
                break
            # The k-th product settles soon, so ever more leaves are taken in one step.
            step, taken = step + taken, 2 * taken
            seen = np.concatenate([np.arange(self.starts[leaf], self.ends[leaf]) for leaf in leaves])
            far = self.squares[seen] - 2 * (self.points.take(seen, axis=0) @ place)
            seen = seen[far <= limit - place @ place]
            self.verified += len(seen)
            new = self.vectors.take(seen, axis=0) @ query
            near = np.flatnonzero((new >= kth - 1e-9) & (self.ids[seen] != own))
            if not len(near):
                continue
            old = scores >= kth - 1e-9
            rows = np.concatenate([rows[old], seen[near]])
            scores = np.concatenate([scores[old], new[near]])
            if len(rows) >= k:
                kth = max(kth, np.partition(scores, len(scores) - k)[len(scores) - k])
        rows = rows[scores >= kth - 1e-9]
        # Products of the best are taken anew, row by row, so that equal rows get equal values.
        exact = (self.vectors[rows] * query).sum(axis=1)
        best = np.lexsort((self.ids[rows], -exact))[:k]
        return rows[best], exact[best]


class Cells:
    """Median cuts of the projected space, as a complete binary tree."""

    def __init__(self, places, depth):
        self.depth = depth
        self.axis, self.cut = np.zeros(2**depth - 1, np.int64), np.zeros(2**depth - 1)
        todo = [places]
        for node in range(2**depth - 1):
            part, todo[node] = todo[node], None
            if len(part):
                self.axis[node] = np.argmax(part.max(axis=0) - part.min(axis=0))
                self.cut[node] = np.median(part[:, self.axis[node]])
            right = part[:, self.axis[node]] > self.cut[node]
            todo += [part[~right], part[right]]

    def of(self, places):
        node = np.zeros(len(places), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (places[np.arange(len(places)), self.axis[node]] > self.cut[node])
        return node - (2**self.depth - 1)


def usable(vectors):
    """Distinct ``vec_id``, ``vector`` (array of double) that take part.

    Null ids and vectors, empty and zero vectors, and vectors with null or non-finite components
    don't.
    """
    vector = F.col("embedding").cast("array<double>")
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
        .where("vec_id is not null and vector is not null")
        .where(sound & F.exists("vector", lambda x: x != 0))
    )


def _runs(*columns):
    """Starts and ends of the runs of equal values."""
    n = len(columns[0])
    change = np.zeros(n, bool)
    for column in columns:
        change[1:] |= column[1:] != column[:-1]
    starts = np.concatenate([[0], np.flatnonzero(change)]) if n else np.empty(0, np.int64)
    return zip(starts.tolist(), [*starts[1:].tolist(), n])


def _matrix(column):
    """Vectors of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _by_length(batch):
    """Row numbers of a batch and the matrix of their vectors, for each length."""
    lengths = batch.column("d").to_numpy()
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield int(d), rows, _matrix(batch.column("vector").take(pa.array(rows)))


def _in_cells(rows, cells, longest):
    """Rows with their projected ``place`` and their ``cell`` (0 without ``cells``)."""

    def add(batches):
        for batch in batches:
            place, cell = np.empty((batch.num_rows, PROJECTED)), np.zeros(batch.num_rows, np.int64)
            for d, here, vectors in _by_length(batch):
                place[here] = placed(vectors, longest, projections(d))
                if cells is not None:
                    cell[here] = cells.of(place[here])
            arrays = [*batch.columns, pa.array(list(place), pa.list_(pa.float64())), pa.array(cell)]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "vector", "d", "place", "cell"])

    return rows.mapInArrow(add, "vec_id long, vector array<double>, d int, place array<double>, cell long")


_ASKED = ["vec_id", "vector", "d", "ask", "bound"]


def _sent(asked, boxes, longest, certainty, home):
    """Queries once for each block they go to.

    With ``home`` that is the nearest block. Otherwise, with the ``bound`` found there, all other blocks
    of which the stopping test can't say that they hold nothing nearer.
    """
    reach = chi_square_quantile(certainty, PROJECTED)
    schema = "vec_id long, vector array<double>, d int, ask long, bound double, cell long, salt int"

    def send(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, _BATCH):
                batch = whole.slice(start, _BATCH)
                for d, rows, vectors in _by_length(batch):
                    if d not in boxes:
                        continue
                    cell, low, high, salts = boxes[d]
                    part = batch.take(pa.array(rows))
                    gaps = box_gaps(vectors @ projections(d)[:-1], low, high)
                    nearest_box = np.argmin(gaps, axis=1)
                    if home:
                        q, b = np.arange(len(rows)), nearest_box
                        salt = np.zeros(len(q), np.int32)
                    else:
                        bound = part.column("bound").to_numpy(zero_copy_only=False)
                        offset = (vectors**2).sum(axis=1) + longest
                        limit = reach * np.maximum(0, offset - 2 * bound) + 1e-9 * (1 + offset)
                        q, b = np.nonzero(gaps <= limit[:, None])
                        copies = salts[b]
                        q, b = np.repeat(q, copies), np.repeat(b, copies)
                        salt = (np.arange(len(q)) - np.repeat(np.cumsum(copies) - copies, copies)).astype(np.int32)
                        new = (b != nearest_box[q]) | (salt != 0)
                        q, b, salt = q[new], b[new], salt[new]
                    # Copies are made for a few queries at a time.
                    for i in range(0, len(q), _SENT):
                        sent = part.take(pa.array(q[i : i + _SENT]))
                        blocks = [pa.array(cell[b[i : i + _SENT]]), pa.array(salt[i : i + _SENT])]
                        yield pa.RecordBatch.from_arrays(
                            [*[sent.column(n) for n in _ASKED], *blocks], names=[*_ASKED, "cell", "salt"]
                        )

    return asked.select(*_ASKED).mapInArrow(send, schema)


def _searched(rows, sent, longest, k, certainty):
    """Rows that the queries ``sent`` to blocks find there; a block's rows come before its queries."""
    none = [F.lit(None).cast("long").alias("ask"), F.lit(None).cast("double").alias("bound")]
    met = rows.select("vec_id", "vector", "d", *none, "cell", "salt", F.lit(False).alias("asked")).unionByName(
        sent.withColumn("asked", F.lit(True))
    )
    block = ["d", "cell", "salt"]

    def search(batches):
        here, parts, tree = None, [], None
        for batch in batches:
            keys = [batch.column(n).to_numpy(zero_copy_only=False) for n in (*block, "asked")]
            for start, end in _runs(*keys):
                *place, is_query = (key[start] for key in keys)
                if here != place:
                    here, parts, tree = place, [], None
                part = batch.slice(start, end - start)
                ids, vectors = part.column("vec_id").to_numpy(), _matrix(part.column("vector"))
                if not is_query:
                    parts.append((ids, vectors))
                    continue
                project = projections(int(place[0]))
                if tree is None:
                    if not parts:
                        continue
                    tree = KdTree(*[np.concatenate(c) for c in zip(*parts)], longest, project)
                    parts = []
                bounds = part.column("bound").to_numpy()
                at, found, scores = tree.search(ids, vectors, project, k, certainty, bounds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), part.column("ask").take(pa.array(at)), pa.array(found), pa.array(scores)],
                    names=["query_id", "ask", "vec_id", "score"],
                )

    parallel = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        met.repartition(parallel, *block).sortWithinPartitions(*block, "asked")
        .mapInArrow(search, "query_id long, ask long, vec_id long, score double")
    )


def nearest(vectors, queries, k=K, certainty=CERTAINTY, rows=ROWS):
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``: the ``k`` nearest rows of each query.

    ``vectors`` and ``queries`` have ``vec_id`` and ``embedding``; other columns don't matter. A row is no
    candidate of the query with its own id. Equal scores go by the smaller id. Vectors only meet
    others of their length. Rows that :func:`usable` leaves out are neither queries nor candidates;
    rows repeated with id and vector count once; with fewer than ``k`` candidates all are returned.

    Of rows with one and the same vector only the ``k + 1`` smallest ids can be among the nearest of
    any query, so the others are left out before the search.
    """
    on_workers(vectors.sparkSession)
    same = Window.partitionBy("vector").orderBy("vec_id")
    candidates = written(
        usable(vectors).distinct()
        .withColumn("_copy", F.row_number().over(same)).where(F.col("_copy") <= k + 1)
        .select("vec_id", "vector", F.size("vector").alias("d")),
        "candidates",
    )
    asked = written(
        usable(queries).distinct()
        .select("vec_id", "vector", F.size("vector").alias("d"), F.xxhash64("vector").alias("ask")),
        "queries",
    )
    squares = F.aggregate("vector", F.lit(0.0), lambda t, x: t + x * x)
    count, longest, lengths = candidates.agg(F.count("*"), F.max(squares), F.count_distinct("d")).first()
    longest, limit = longest or 0.0, max(1, BLOCKS // max(1, lengths))
    depth = min(math.ceil(math.log2(max(1, count / rows))), int(math.log2(limit)))
    cells = None
    if depth:
        every = max(1, math.ceil(count / SAMPLE))
        sample = candidates.where(F.pmod(F.xxhash64("vec_id"), F.lit(every)) == 0)
        places = _in_cells(sample, None, longest).select("place").toPandas()["place"]
        cells = Cells(np.array(places.tolist()).reshape(-1, PROJECTED), depth)
    in_cells = written(_in_cells(candidates, cells, longest), "cells")
    axes = [f(F.col("place")[i]).alias(f"{n}{i}") for n, f in (("low", F.min), ("high", F.max)) for i in range(PROJECTED)]
    found = in_cells.groupBy("d", "cell").agg(F.count("*").alias("n"), *axes).toPandas()
    found["salts"] = np.maximum(1, -(-found["n"] // (2 * rows))).astype(np.int32)
    boxes = {
        int(d): (
            part["cell"].to_numpy(), part[[f"low{i}" for i in range(PROJECTED)]].to_numpy(),
            part[[f"high{i}" for i in range(PROJECTED)]].to_numpy(), part["salts"].to_numpy(),
        )
        for d, part in found.groupby("d")
    }
    large = found[found["salts"] > 1]
    salts = F.lit(1)
    for d, cell, n in zip(large["d"], large["cell"], large["salts"]):
        salts = F.when((F.col("d") == int(d)) & (F.col("cell") == int(cell)), int(n)).otherwise(salts)
    in_cells = in_cells.withColumn("salt", F.pmod(F.xxhash64("vec_id"), salts).cast("int"))

    unbound = F.lit(float("-inf"))
    sent = _sent(asked.withColumn("bound", unbound), boxes, longest, certainty, home=True)
    at_home = written(_searched(in_cells, sent, longest, k, certainty), "home")
    bounds = at_home.groupBy(F.col("query_id").alias("vec_id"), "ask").agg(
        F.when(F.count("*") >= k, F.min("score")).otherwise(unbound).alias("bound")
    )
    bound = asked.join(bounds, ["vec_id", "ask"], "left").withColumn("bound", F.coalesce("bound", unbound))
    others = _searched(
        in_cells, _sent(bound, boxes, longest, certainty, home=False), longest, k, certainty
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        at_home.unionAll(others)
        .withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
