"""Near-duplicates by SimHash: all fingerprints compared in tiles with exclusive-or and bit counts.

Texts with one fingerprint are one case, so only distinct fingerprints are compared. They are dealt
to tiles by their population count (the number of one bits, 0 to 64) and a hash, at most about
``TILE`` fingerprints a tile. Fingerprints that differ in ``radius`` bits differ in population count by
``radius`` at most, so pairs of tiles further apart are skipped; every other pair is compared
exactly, in blocks. Inside a pair of tiles, blocks are in the order of the counts of the four
quarters of a fingerprint, and blocks whose quarters differ by more than the radius are skipped
too. A pair of tiles gives a spanning forest of its links, not the links themselves, so a large
group of near copies gives as many rows as it has members.
"""

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from trendmill.llm.components import smallest_reachable
from trendmill.llm.shared import id_and_text, map_texts, on_workers
from trendmill.session import written

SHINGLE, SEED, RADIUS = 3, 42, 2
#: Fingerprints in a tile, and in a block that numpy compares at a time.
TILE, BLOCK = 16_384, 1024

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SLAB = 65_536


def fingerprint(text):
    """Signed 64-bit SimHash of a text; zero without words.

    Words are split at ASCII white space, A-Z lower-cased; features are the runs of three words,
    repeats included, or the whole sequence when there are fewer words.
    """
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    size = min(SHINGLE, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _SLAB):
        hashes = np.array(
            [digest(joined[s:e], SEED) for s, e in zip(starts[at : at + _SLAB], ends[at : at + _SLAB])],
            np.uint64,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(set_bits.view(np.int64)[0])


def fingerprints(docs):
    """``doc_id`` and ``fp`` of every row, from its whole text; null texts count as empty."""
    return map_texts(
        id_and_text(docs), lambda: lambda t: {"fp": [fingerprint(x) for x in t]}, "fp long"
    )


def _quarters(prints):
    return np.bitwise_count(prints.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def _blocks(prints):
    """Fingerprints in the order of their quarters' counts, with the range of counts of each block."""
    counts = _quarters(prints)
    order = np.lexsort(counts.T)
    prints, counts = prints[order], counts[order]
    cuts = range(0, len(prints), BLOCK)
    low = np.array([counts[i : i + BLOCK].min(0) for i in cuts]).reshape(-1, 4)
    high = np.array([counts[i : i + BLOCK].max(0) for i in cuts]).reshape(-1, 4)
    return prints, low, high


def close_blocks(left, right, radius, same):
    """Blocks of two tiles and the matrix of their pairs within ``radius`` bits, where there are any."""
    a, a_low, a_high = left
    b, b_low, b_high = right
    for i in range(len(a_low)):
        gaps = np.maximum(0, np.maximum(a_low[i] - b_high, b_low - a_high[i])).sum(axis=1)
        for j in np.flatnonzero(gaps <= radius):
            if same and j < i:
                continue
            x, y = a[i * BLOCK : (i + 1) * BLOCK], b[j * BLOCK : (j + 1) * BLOCK]
            near = np.bitwise_count(x[:, None] ^ y[None, :]) <= radius
            if near.any():
                yield x, y, near


def forest(left, right, radius, same):
    """Links of a spanning forest of the close pairs, as rows of two fingerprints."""
    parent, out = {}, []

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def roots(values):
        return np.array([root(v) for v in values.tolist()], np.uint64)

    for x, y, near in close_blocks(left, right, radius, same):
        p, q = np.nonzero(near)
        while len(p):
            # A link of each left fingerprint at a time; then pairs joined by now are left out.
            _, first = np.unique(p, return_index=True)
            for u, v in zip(x[p[first]].tolist(), y[q[first]].tolist()):
                a, b = root(u), root(v)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    out.append((u, v))
            apart = roots(x)[p] != roots(y)[q]
            p, q = p[apart], q[apart]
    return np.array(out, np.uint64).reshape(-1, 2).view(np.int64)


def links(prints, radius=RADIUS, tile=TILE):
    """Long columns ``a`` and ``b`` that join distinct fingerprints into groups linked within ``radius``.

    ``prints`` has distinct ``fp``. Two fingerprints within the radius are in one group of the result;
    not each such pair has a row of its own.
    """
    on_workers(prints.sparkSession)
    counted = prints.select("fp", F.bit_count("fp").alias("ones"))
    # At most 65 rows, one for each population count.
    sizes = counted.groupBy("ones").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    tiled = counted.join(F.broadcast(sizes), "ones").withColumn(
        "tile", F.pmod(F.xxhash64("fp"), F.col("tiles"))
    )
    partners = sizes.select(F.col("ones").alias("other_ones"), F.col("tiles").alias("other_tiles"))
    reach = F.expr(f"explode(sequence(ones - {radius}, ones + {radius})) as other_ones")
    pairs = (
        tiled.select("*", reach).join(F.broadcast(partners), "other_ones")
        .select(
            "*", F.expr("explode(sequence(0L, other_tiles - 1)) as other_tile")
        )
        .withColumn(
            "first",
            F.expr("ones < other_ones or (ones = other_ones and tile <= other_tile)"),
        )
        .select(
            "fp", "first",
            F.expr("if(first, ones, other_ones)").alias("p"),
            F.expr("if(first, tile, other_tile)").alias("i"),
            F.expr("if(first, other_ones, ones)").alias("q"),
            F.expr("if(first, other_tile, tile)").alias("j"),
        )
    )

    def compare(key, frame):
        p, i, q, j = key
        prints = frame["fp"].to_numpy().view(np.uint64)
        first = frame["first"].to_numpy()
        left = _blocks(prints[first])
        same = (p, i) == (q, j)
        right = left if same else _blocks(prints[~first])
        found = forest(left, right, radius, same)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    return pairs.groupBy("p", "i", "q", "j").applyInPandas(compare, "a long, b long").where("a <> b")


def components(prints, radius=RADIUS, tile=TILE):
    """``fp`` and ``component``, one fingerprint that stands for its group, for each ``fp`` of ``prints``."""
    distinct = written(prints.select("fp").distinct(), "distinct-fingerprints")
    groups = smallest_reachable(links(distinct, radius, tile), "fp")
    return distinct.join(groups, "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component")
    )


def near_duplicates(docs, radius=RADIUS, tile=TILE):
    """``doc_id``, ``fp`` and ``component_id`` of every row.

    Rows whose fingerprints differ in at most ``radius`` bits are linked; ``component_id`` is the smallest
    id that can be reached, the row's own included. Rows without words have fingerprint zero and
    are linked like any other. Null ids don't count as smallest; a component of null ids only has
    a null ``component_id``. Repeated rows each give a row.
    """
    rows = written(fingerprints(docs), "fingerprints")
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = written(least.join(components(rows, radius, tile), "fp"), "components")
    named = found.join(
        found.groupBy("component").agg(F.min("least").alias("component_id")), "component"
    ).select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs, radius=RADIUS, tile=TILE):
    """``docs`` with one row of each component: the one with the smallest id, nulls last.

    Of rows repeated with that id, one stays. All columns are kept as they are.
    """
    names = docs.columns
    rows = docs.select(
        *[F.col(n).alias(f"_{i}") for i, n in enumerate(names)],
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = written(
        map_texts(rows, lambda: lambda t: {"fp": [fingerprint(x) for x in t]}, "fp long")
        .withColumn("_row", F.monotonically_increasing_id()),
        "fingerprinted",
    )
    narrow = rows.select("fp", "doc_id", "_row")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    # First within each fingerprint, which exact copies share, then within each component.
    firsts = narrow.groupBy("fp").agg(F.min(order).alias("first"))
    kept = (
        firsts.join(components(narrow, radius, tile), "fp")
        .groupBy("component").agg(F.min("first").alias("first"))
        .select(F.col("first")["_row"].alias("_row"))
    )
    return rows.join(kept, "_row", "left_semi").select(
        *[F.col(f"_{i}").alias(n) for i, n in enumerate(names)]
    )
