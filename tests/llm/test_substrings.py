import hashlib
import random
import re

import numpy as np

from trendmill.llm import filters, substrings
from trendmill.llm.shared import bound_batches


def plain(rows):
    """The contract, window by window."""
    splits = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (doc, _), words in zip(rows, splits):
        for i in range(len(words) - 12):
            if doc is not None:
                key = tuple(words[i : i + 13])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for (doc, _), words in zip(rows, splits):
        gone = set()
        for i in range(len(words) - 12):
            if doc is not None and first[tuple(words[i : i + 13])] < doc:
                gone |= set(range(i, i + 13))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def key(row):
    return tuple((v is None, str(v)) for v in row)


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in substrings.remove_repeats(df, texts=False).collect()]
    assert sorted(found, key=key) == sorted(plain(rows), key=key)


def test_equal_windows_stand_by_equal_names():
    rng = random.Random(5)
    for _ in range(300):
        window = " ".join(rng.choice(["a", "b", "c", "word", "é"]) for _ in range(13))
        texts = [
            " ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 9))) + " " + window + " "
            + " ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 9)))
            for _ in range(2)
        ]
        names = []
        for text in texts:
            words = substrings.Words([text])
            at = text.encode().split()
            place = next(
                i for i in range(len(at) - 12) if at[i : i + 13] == window.encode().split()
            )
            names.append((substrings.standing_names(words)[place], substrings.window_names(words)[place]))
        assert names[0] == names[1] and names[0][0] != -1


def test_forms_and_shared_names_depend_on_windows_alone():
    rng = random.Random(9)
    forms, shared = {}, {}
    for _ in range(1500):
        texts = [
            " ".join(
                w for _ in range(rng.randint(0, 12))
                for w in [rng.choice("abcd")] * rng.choice([1, 1, 1, 2, 7, 20])
            )
            for _ in range(3)
        ]
        words = substrings.Words(texts)
        plain_words = [w for t in texts for w in t.split()]
        form, name = substrings.window_names(words), substrings.standing_names(words)
        for i in words.window_starts():
            window = tuple(plain_words[i : i + 13])
            assert forms.setdefault(window, form[i]) == form[i]
            assert shared.setdefault(window, name[i]) == name[i]
    assert len(set(forms.values())) == len(forms) > 5000
    assert len(set(shared.values())) < len(shared)


def test_symbols_name_runs_and_pairs():
    text = "x " + "r " * 9 + "y a b c d e f g h i j k l m n o p q s t u v w z"
    words = substrings.Words([text + " " + text, "r r r"])
    symbols = words.symbols
    assert symbols.starts[0] == 0 and (symbols.starts[1:] == symbols.ends[:-1]).all()
    assert (np.diff(symbols.low) >= 0).all() and (np.diff(symbols.high) >= 0).all()
    assert (symbols.low < symbols.starts).all() and (symbols.high > symbols.ends).all()
    tokens = text.split() * 2 + ["r"] * 3
    named = {}
    for name, start, end in zip(symbols.names, symbols.starts, symbols.ends):
        assert named.setdefault(name, tokens[start:end]) == tokens[start:end]
    # A run lies in one symbol, whatever its length.
    assert not ((symbols.starts > 1) & (symbols.starts < 10)).any()
    assert symbols.text.tolist() == words.text[symbols.starts].tolist()


def test_windows_within_a_run(spark):
    runs = [(1, "r " * 40), (2, "r " * 13), (3, "a " + "r " * 30 + "b"), (4, "r " * 12), (5, "b " + "r " * 14)]
    check(spark, runs)


def test_words_do_not_run_over_texts():
    texts = ["a b c", "", "  d\te ", "\n", "f"]
    words = substrings.Words(texts)
    assert words.counts.tolist() == [3, 0, 2, 0, 1]
    assert words.left.tolist() == [3, 2, 1, 2, 1, 1]
    assert words.joined(np.ones(6, bool)) == [b"a b c", b"", b"d e", b"", b"f"]
    assert words.joined(np.array([1, 0, 1, 0, 1, 0], bool)) == [b"a c", b"", b"e", b"", b""]


def test_small_vocabulary_runs_and_copies(spark):
    rng = random.Random(6)
    rows = []
    for doc in range(120):
        words = [rng.choice("ab") for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.3:
            words += ["run"] * rng.randint(5, 40)
        rows.append((doc, " ".join(words)))
    rows += [(200 + i, rows[i][1]) for i in range(30)] + [(5, rows[5][1]), (7, rows[9][1])]
    rows += [(None, rows[3][1]), (300, "\t".join(rows[3][1].split())), (301, None), (302, "")]
    check(spark, rows)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(filters, "BITS", 32768)
    monkeypatch.setattr(filters.build, "__defaults__", (32768,))
    rng = random.Random(7)
    rows = [(d, " ".join(rng.choice("abc") for _ in range(40))) for d in range(60)]
    check(spark, rows + [(99, rows[0][1])])


def test_odd_rows(spark, odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    found = [tuple(r)[:4] for r in substrings.remove_repeats(odd).collect()]
    assert sorted(found, key=key) == sorted(plain(rows), key=key)
    assert substrings.remove_repeats(none).count() == 0


def test_bitmap_holds_what_was_put_in(spark):
    values = [0, 1, -1, 2**62, -(2**63), 12345, 32768]
    bitmap = filters.build(spark.createDataFrame([(v,) for v in values], "v long"), "v")
    assert filters.may_hold(bitmap, np.array(values, np.int64)).all()
    assert not filters.may_hold(bitmap, np.array([2, 3, 77], np.int64)).any()


def test_batches_are_bounded_in_bytes(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "64m")
        bound_batches(spark, 4_000_000)
        assert spark.conf.get(name) == "4000000"
        spark.conf.set(name, "2m")
        bound_batches(spark, 4_000_000)
        assert spark.conf.get(name) == "2m"
    finally:
        spark.conf.set(name, before)
