"""Connected components of a graph held in a table, by joins that every executor shares."""

from pyspark.sql import functions as F

from trendmill.session import written


def smallest_reachable(edges, node="node", rounds=60):
    """``node`` and ``component``, the smallest node it reaches, for all nodes of ``edges``.

    ``edges`` has long columns ``a`` and ``b``; direction, repeats and loops don't matter. Every round
    links each node's larger neighbours to its smallest neighbour, then its smaller ones (large
    star, small star), until a round changes nothing; a chain of n nodes takes about log n rounds.
    The edges of a round are written to the shared folder, so neither the plan nor a lost
    executor makes earlier rounds run again.
    """
    star = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b").distinct(),
        "edges",
    )
    digest = _digest(star)
    for _ in range(rounds):
        star = written(_small_star(_large_star(star)), "edges")
        now = _digest(star)
        if now == digest:
            break
        digest = now
    else:
        raise RuntimeError(f"components did not settle within {rounds} rounds")
    roots = star.select(F.col("b").alias(node), F.col("b").alias("component"))
    return star.select(F.col("a").alias(node), F.col("b").alias("component")).unionAll(roots).distinct()


def _digest(edges):
    """Count and two sums over all edges, equal for equal sets."""
    hashed = F.xxhash64("a", "b")
    return tuple(edges.agg(
        F.count("*"), F.sum(hashed.bitwiseAND(2**31 - 1)), F.sum(F.shiftrightunsigned(hashed, 33))
    ).first())


def _large_star(edges):
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m")
    )
    return (
        both.where("b > a").join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    )


def _small_star(edges):
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a")
    return (
        linked.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionAll(least.select("a", F.col("m").alias("b")))
        .where("a <> b").distinct()
    )
