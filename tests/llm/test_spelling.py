"""Spelling variants against plain loops over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from trendmill.llm import spelling


def brute_force(rows):
    """Rows of the contract: every word compared with every other."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    found = {w: sorted((-words[v], v) for v in words if near(w, v)) for w in words}
    form = {w: f[0][1] for w, f in found.items() if f and -f[0][0] >= 10 * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(found[w]), words.get(form.get(w))))
    return sorted(out)


def _texts(seed, size, long=0):
    """Texts of a few words, many of them misspelt, with frequencies far apart."""
    rng = random.Random(seed)
    stems = ["".join(rng.choices("aeinrstéülo", k=rng.randint(6, 10))) for _ in range(25)]
    stems += ["x" * 60 + "y" * long, "StraßenbÄhn", "na×ve÷word"]
    out = []
    for i in range(size):
        words = []
        for _ in range(rng.randint(0, 60)):
            w = stems[min(int(rng.expovariate(0.25)), len(stems) - 1)]
            if rng.random() < 0.15:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + "e" + w[k:], w[:k] + "s" + w[k + 1 :], w.upper()])
            words.append(w)
        out.append((i, rng.choice([" ", "-", "中", "1"]).join(words)))
    return out


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("cell_words", [spelling.CELL_WORDS, 2])
def test_equals_brute_force(spark, cell_words):
    rows = _texts(1, 150, long=40)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = _rows(spelling.variants(docs, cell_words=cell_words))
    assert found == brute_force(rows)
    assert any(r[1] for r in found)


def test_odd_rows_and_empty_table(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert _rows(spelling.variants(odd)) == brute_force(rows)
    assert spelling.variants(none).count() == 0


def test_one_edit():
    assert spelling.one_edit("variant", "variants") and spelling.one_edit("variant", "variont")
    assert not spelling.one_edit("variant", "variant") and not spelling.one_edit("variant", "varinats")


def test_search_spends_one_surplus_and_one_deficit():
    words = pa.array(["bananaü", "bananas", "banaanu", "panania", "xxxxxxx"])
    trie = spelling.Trie(words, pa.array([5, 4, 3, 2, 1]).to_numpy())
    sought = pa.array(["bananax", "bananas"])
    pairs = {(sought[int(a)].as_py(), trie.words[int(b)].as_py())
             for x, y in trie.near(sought) for a, b in zip(x, y)}
    assert pairs == {("bananax", "bananaü"), ("bananax", "bananas"), ("bananas", "bananaü")}


def test_roots_follow_long_chains(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(19)] + [("a", "w3"), ("b", "a")]
    found = dict(spelling.roots(spark.createDataFrame(links, "word string, form string")).collect())
    assert set(found.values()) == {"w19"} and len(found) == 21
