import random
import re
from collections import Counter

from trendmill.llm import contamination


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def runs(words, size):
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


def plain(docs, items):
    """The best similarity of every pair that reaches 0.8, over all windows."""
    out = {}
    for doc, text in docs:
        words = words_of(text)
        for item, item_text in items:
            passage = words_of(item_text)
            size = min(5, len(passage))
            if not passage or len(words) < size:
                continue
            want = Counter(runs(passage, size))
            for start in range(max(1, len(words) - len(passage) + 1)):
                have = Counter(runs(words[start : start + len(passage)], size))
                common = sum((have & want).values())
                value = common / (have.total() + want.total() - common)
                if value >= 0.8:
                    out[doc, item] = max(value, out.get((doc, item), 0))
    return out


def test_windows_equal_brute_force(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 20, 40])))) for i in range(12)]
    items += [(90, "one two one two one two one two one two one two"), (91, None), (92, "")]
    docs = []
    for doc in range(60):
        passage = rng.choice(items[:13])[1].split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            passage[rng.randrange(len(passage))] = "changed"
        around = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30))) for _ in range(2)]
        docs.append((doc, f"{around[0]} {' '.join(passage).upper()}, {around[1]}"))
    docs += [(100, None), (101, ""), (102, items[3][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = contamination.find_leaks(df, bench).collect()
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in found} == {
        k: round(v, 9) for k, v in plain(docs, items).items()
    }
    kept = {r["doc_id"] for r in contamination.drop_leaks(df, bench).collect()}
    assert kept == {d for d, _ in docs} - {r["doc_id"] for r in found}


def test_stretches_of_repeated_words(spark):
    """300 runs, 25 of which are one run in the item and another one in the window."""
    items, docs = [], []
    for i in range(8):
        words = [f"w{i}x{j}" for j in range(304)]
        items.append((i, " ".join([*words[:100], *[f"a{i}"] * 29, *words[129:]])))
        docs.append((i, " ".join([*words[:100], *[f"b{i}"] * 29, *words[129:]])))
    want = plain(docs, items)
    assert set(want) == {(i, i) for i in range(8)}
    found = contamination.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in found} == {
        k: round(v, 9) for k, v in want.items()
    }


def test_blocks_find_every_fingerprint_within_the_radius():
    rng = random.Random(9)
    for radius in (0, 3, 23):
        blocks = contamination.blocks(radius)
        assert sum(w for _, _, w in blocks) == 64 and len(blocks) == radius + 1
        for _ in range(200):
            differing = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(differing >> s & (2**w - 1) == 0 for _, s, w in blocks)


def test_several_parts_of_a_large_benchmark(spark, documents, folder, monkeypatch):
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    whole = {tuple(r) for r in contamination.find_leaks(documents, bench).collect()}
    monkeypatch.setattr(contamination, "BROADCAST_ROWS", 700)
    assert {tuple(r) for r in contamination.find_leaks(documents, bench).collect()} == whole


def test_query_equals_brute_force(spark, documents, folder):
    from trendmill.llm.queries import op3_simhash_decontamination

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    # Only pairs with a common run can match.
    common = {}
    for item, text in items:
        for run in runs(words_of(text), 5):
            common.setdefault(run, set()).add(item)
    want = {}
    for doc, text in docs:
        met = set().union(*[common.get(r, set()) for r in runs(words_of(text), 5)], set())
        want |= plain([(doc, text)], [i for i in items if i[0] in met])
    found = op3_simhash_decontamination(spark, folder).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == set(want)


def test_odd_rows(spark, odd, none):
    bench = spark.createDataFrame(
        [(1, "a row without an id"), (2, "word " * 9), (None, "the lazy dog near the river bank")],
        "item_id long, text string",
    )
    found = {(r["doc_id"], r["item_id"]) for r in contamination.find_leaks(odd, bench).collect()}
    assert found == {(None, 1), (5, 2), (1, None)}
    left = contamination.drop_leaks(odd, bench)
    assert left.columns == odd.columns and left.count() == odd.count() - 4
    assert contamination.find_leaks(none, bench).count() == 0
    assert contamination.find_leaks(odd, bench.where("1 = 0")).count() == 0
    assert contamination.drop_leaks(odd, bench.where("1 = 0")).count() == odd.count()
