import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from trendmill.llm import simhash
from trendmill.llm.components import smallest_reachable


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=2):
    """Smallest place reachable from each, by comparing all pairs."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = np.array(prints, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values) <= radius):
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB \t\n\x1cÉé", max_size=60))
def test_fingerprint_equals_its_definition(text):
    assert simhash.fingerprint(text) % 2**64 == plain_fingerprint(text)


def test_spark_hash_is_the_same_xxh64(spark):
    from pyspark.sql import functions as F

    value = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first()["h"]
    assert value % 2**64 == xxhash.xxh64_intdigest(b"a b c", seed=42)


def test_tiles_find_all_links(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 300, dtype=np.int64)
    chain = [0]
    for i in range(60):
        chain.append(chain[-1] ^ (1 << i))
    near = [int(b) ^ (1 << int(rng.integers(63))) for b in base[:150]]
    prints = sorted({*map(int, base), *near, *chain, -1, 0})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    for tile in (7, 16_384):
        found = {r["fp"]: r["component"] for r in simhash.components(df, tile=tile).collect()}
        want = components([p % 2**64 for p in prints])
        groups = {}
        for p, w in zip(prints, want):
            groups.setdefault(w, set()).add(found[p])
        assert all(len(g) == 1 for g in groups.values()) and len(set(found.values())) == len(groups)


def test_components_of_a_long_chain(spark):
    edges = spark.range(500).selectExpr("id as a", "id + 1 as b").union(
        spark.createDataFrame([(1000, 1001), (1001, 1000), (7, 7)], "a long, b long")
    )
    found = {r["node"]: r["component"] for r in smallest_reachable(edges).collect()}
    assert found == {i: 0 for i in range(501)} | {1000: 1000, 1001: 1000}


def test_query_equals_brute_force(spark, documents, folder):
    from trendmill.llm.queries import op4_simhash_near_duplicates

    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = components(prints)
    want = {(i, format(p, "016x"), rows[r][0]) for (i, _), p, r in zip(rows, prints, roots)}
    assert {tuple(r) for r in op4_simhash_near_duplicates(spark, folder).collect()} == want


def test_odd_rows(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    found = {r["doc_id"]: (r["fp"], r["component_id"]) for r in rows}
    assert found[2] == found[3] == found[None] == (0, 2) or found[2] == found[3] == (0, 2)
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and 2 in ids and 3 not in ids
    assert simhash.near_duplicates(none).count() == simhash.keep_one(none).count() == 0
