"""Documents that hold passages of a benchmark, by SimHash of windows as long as the items.

Texts and items are compared as lower-cased words of letters and digits and their runs of five
words, counted with repeats. A window of a document with as many words as an item matches it when
the weighted similarity (sum of the smaller counts over sum of the larger counts) is 0.8 or more.

A window that matches can be moved right until its first run is one of the item's, or the document
ends, without losing a common run. So the windows that start with a run of an item of their length,
and the last window, are enough. Each gets a 64-bit SimHash of its runs, each taken with its number
among equal ones, so that a repeat is a feature of weight one like any other. Fingerprints within
``radius`` bits agree in at least one of ``radius + 1`` blocks, so equal blocks find all of them; pairs
within the radius are verified by their exact similarity. Two windows of similarity 0.8 differ in
about 10 bits, with a deviation of 3; the radius leaves more than four deviations.

Only DataFrame functions are used. Benchmark tables are broadcast after their rows are counted;
with more than ``BROADCAST_ROWS`` runs, documents are read once for each part of that size.
"""

import math

from pyspark.sql import functions as F

from trendmill.session import written

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 23
BITS = 64
#: Rows of a table that is broadcast, of about 20 bytes each.
BROADCAST_ROWS = 1_000_000


def words_of(text):
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def shingles(hashes, size):
    """Hashes of all runs of ``size`` words of an array of word hashes."""
    if size == 1:
        return F.transform(hashes, lambda h: F.xxhash64(h))
    count = F.size(hashes) - size + 1
    return F.when(
        count > 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1),
            lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(size)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def features(runs):
    """The hashes of an array, each hashed with its number among equal ones from the second on."""
    def number(sorted_runs):
        def feature(h, i):
            repeat = i + 1 - F.array_position(sorted_runs, h)
            return F.when(repeat == 0, h).otherwise(F.xxhash64(h, repeat))

        return F.transform(sorted_runs, feature)

    # An array of one binds its value for the lambda, which would work it out for each element.
    repeats = F.transform(F.array(F.sort_array(runs)), number)[0]
    return F.when(F.size(F.array_distinct(runs)) == F.size(runs), runs).otherwise(repeats)


def simhash(runs):
    """SimHash of the features of an array of hashes: a bit is 1 if it is in more than half of them."""
    def of(found):
        def with_bit(fp, bit):
            ones = F.filter(found, lambda h: F.call_function("getbit", h, bit) == 1)
            value = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
            return F.when(F.size(ones) * 2 > F.size(found), fp.bitwiseOR(value)).otherwise(fp)

        return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), with_bit)

    return F.transform(F.array(features(runs)), of)[0]


def blocks(radius):
    """``(number, shift, width)`` of the ``radius + 1`` blocks of a fingerprint."""
    count = radius + 1
    widths = [BITS // count + (i < BITS % count) for i in range(count)]
    return [(i, sum(widths[:i]), w) for i, w in enumerate(widths)]


def _block_of(fp, shift, width):
    return F.shiftrightunsigned(fp, shift).bitwiseAND(2**width - 1)


def block_rows(fp, radius):
    """An array of ``(block, value)``, one for each block of a fingerprint."""
    return F.array(*[
        F.struct(F.lit(i).alias("block"), _block_of(fp, shift, width).alias("value"))
        for i, shift, width in blocks(radius)
    ])


def first_equal_block(differing, radius):
    """The first block in which two fingerprints with these differing bits agree; null if none."""
    return F.coalesce(*[
        F.when(_block_of(differing, shift, width) == 0, F.lit(i)) for i, shift, width in blocks(radius)
    ])


def similarity(one, other):
    """Weighted similarity of two arrays of hashes with repeats."""
    def count(array, x):
        return F.size(F.filter(array, lambda y: y == x))

    plain = (F.size(F.array_distinct(one)) == F.size(one)) & (
        F.size(F.array_distinct(other)) == F.size(other)
    )
    common = F.when(plain, F.size(F.array_intersect(one, other))).otherwise(
        F.aggregate(
            F.array_distinct(F.array_intersect(one, other)), F.lit(0),
            lambda total, x: total + F.least(count(one, x), count(other, x)),
        )
    )
    return common / (F.size(one) + F.size(other) - common)


def _items(benchmark, radius):
    """Items numbered by ``item``: ``length`` in words, ``size`` of runs, their hashes ``runs``, SimHash ``item_fp``."""
    words = benchmark.select(
        F.col("item_id"), words_of(F.col("text").cast("string")).alias("w")
    ).where(F.size("w") > 0)
    hashed = words.select(
        "item_id", F.size("w").alias("length"), F.transform("w", lambda x: F.xxhash64(x)).alias("h")
    )
    parts = [
        hashed.where(F.least("length", F.lit(SHINGLE)) == k)
        .select("item_id", "length", F.lit(k).alias("size"), shingles(F.col("h"), k).alias("runs"))
        for k in range(1, SHINGLE + 1)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    numbered = out.withColumns({
        "item_fp": simhash(F.col("runs")), "item": F.monotonically_increasing_id(),
    })
    return written(numbered, "benchmark-items")


def _listed(docs, size):
    """Documents with their number of words ``n`` and the hashes of all their runs."""
    hashed = docs.select(
        "doc_id", "t", F.transform(words_of("text"), lambda x: F.xxhash64(x)).alias("h")
    )
    return hashed.select(
        "doc_id", "t", F.size("h").alias("n"), shingles(F.col("h"), size).alias("all_runs")
    )


def _windows(docs, items, size):
    """Windows of documents that start with a run of an item, or are the last: one row each.

    Places are found first, on rows without arrays, and gathered by document; then only documents
    with a place are taken apart once more.
    """
    runs = (
        items.where(F.col("size") == size)
        .select(F.explode("runs").alias("run"), "length").distinct()
    )
    parts = max(1, math.ceil(runs.count() / BROADCAST_ROWS))
    # Without "outer" a filter on the array's size would be pushed down and build the array again.
    opened = _listed(docs, size).select(
        "doc_id", "t", "n", F.posexplode_outer("all_runs").alias("at", "run")
    )
    found = None
    for part in range(parts):
        mine = runs.where(F.pmod("run", F.lit(parts)) == part)
        met = opened.join(F.broadcast(mine), "run").drop("run")
        found = met if found is None else found.unionAll(met)
    start = F.least("at", F.greatest(F.lit(0), F.col("n") - F.col("length")))
    places = written(
        found.groupBy("doc_id", "t")
        .agg(F.collect_set(F.struct("length", start.alias("start"))).alias("places"))
        .select(F.col("doc_id").alias("_doc"), F.col("t").alias("_t"), "places"),
        "leak-places",
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("t") == F.col("_t"))
    # Places grow with the documents, so they are never broadcast, however few they are.
    met = docs.join(places.hint("merge"), same).drop("_doc", "_t")
    listed = met.select("doc_id", "t", "places", F.transform(
        words_of("text"), lambda x: F.xxhash64(x)
    ).alias("h")).select("doc_id", "t", "places", shingles(F.col("h"), size).alias("all_runs"))

    def window(place):
        runs = F.slice("all_runs", place["start"] + 1, place["length"] - size + 1)
        return F.struct(
            place["length"].alias("length"), place["start"].alias("start"), runs.alias("window")
        )

    return listed.select(
        "doc_id", "t", F.explode_outer(F.transform("places", window)).alias("w")
    ).select("doc_id", "t", "w.*")


def _bounded(df, rows):
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _matches(docs, benchmark, at_least, radius):
    """Matching pairs with the row's id, a hash of its text, and the window."""
    items = _items(benchmark, radius)
    counts = {r["size"]: r["count"] for r in items.groupBy("size").count().collect()}
    total = sum(counts.values())
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("t"),
    )
    index = items.select(
        "item", "item_id", "length", "item_fp",
        F.explode(block_rows(F.col("item_fp"), radius)).alias("b"),
    ).select("item", "item_id", "length", "item_fp", "b.*")
    texts = items.select("item", F.col("runs").alias("item_runs"))
    out = None
    for size in sorted(counts):
        windows = _windows(rows, items, size).withColumn("fp", simhash(F.col("window")))
        probed = windows.select("*", F.explode(block_rows(F.col("fp"), radius)).alias("b")).select(
            "doc_id", "t", "length", "start", "window", "fp", "b.*"
        )
        differing = F.col("fp").bitwiseXOR(F.col("item_fp"))
        near = (
            probed.join(_bounded(index, total * (radius + 1)), ["length", "block", "value"])
            .where(F.bit_count(differing) <= radius)
            .where(F.col("block") == first_equal_block(differing, radius))
        )
        checked = near.join(_bounded(texts, total), "item").select(
            "doc_id", "t", "item_id", "length", "start",
            F.bit_count(differing).cast("int").alias("distance"),
            similarity(F.col("window"), F.col("item_runs")).alias("similarity"),
        ).where(F.col("similarity") >= at_least)
        out = checked if out is None else out.unionAll(checked)
    return out


def find_leaks(docs, benchmark, at_least=SIMILARITY, radius=RADIUS):
    """``doc_id``, ``item_id``, ``similarity``, ``start_word``, ``n_words``, ``distance`` of each match.

    One row for a document and an item: the most similar window, the first of equal ones, its length
    in words and the bits its fingerprint differs in. Null and empty texts and items match nothing;
    a text shorter than an item is one window. Rows with a null id or repeated rows are judged like
    others and give one row with an item. Other columns don't matter.
    """
    found = _matches(docs, benchmark, at_least, radius)
    if found is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, item_id long, similarity double, start_word int, n_words int, distance int"
        )
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "length", "distance"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", "best.similarity", (-F.col("best.back")).alias("start_word"),
        F.col("best.length").alias("n_words"), "best.distance",
    )


def drop_leaks(docs, benchmark, at_least=SIMILARITY, radius=RADIUS):
    """``docs`` without the rows that match an item; columns are kept as they are."""
    found = _matches(docs, benchmark, at_least, radius)
    if found is None:
        return docs
    gone = written(found.select("doc_id", "t").distinct(), "leaks")
    names = docs.columns
    rows = docs.select(
        *[F.col(n).alias(f"_{i}") for i, n in enumerate(names)], F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("hash"),
    )
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("t"))
    return rows.join(gone, same, "left_anti").select(*[F.col(f"_{i}").alias(n) for i, n in enumerate(names)])
