import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trendmill.llm import bpe, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["<|endoftext|>", "<|startoftext|>", "a", "!!", " ", "don't", "I'LL", "'s", "<|", "123", "é", "Σ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts(count, seed):
    rng = random.Random(seed)
    codes = [(32, 126), (160, 0x2FF), (0x370, 0x4FF), (0x300, 0x36F), (0x1F600, 0x1F640), (9, 31)]
    for _ in range(count):
        kind = rng.random()
        if kind < 0.4:
            yield "".join(chr(rng.randint(*rng.choice(codes))) for _ in range(rng.randint(0, 30)))
        elif kind < 0.7:
            yield " ".join(
                "".join(rng.choice("etaoinshrdlu'") for _ in range(rng.randint(1, 14)))
                for _ in range(rng.randint(0, 12))
            )
        else:
            yield "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 10)))


def test_encoding_and_decoding_equal_the_library(library):
    some = list(texts(4000, 1))
    encoder = bpe.Encoder(bpe.Merges(PATH))
    mine = bpe.encode_texts(encoder, some)
    theirs = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
    assert mine == theirs
    assert 0 < encoder.corrected < encoder.speculated
    for ids in mine:
        assert bpe.decode_ids(encoder.merges, ids) == library.decode(ids, skip_special_tokens=False)


def test_pair_checks_equal_exact_merging():
    merges, rng = bpe.Merges(PATH), random.Random(2)
    left, right = list(merges.inner.values()), [*merges.inner.values(), *merges.ended.values()]
    for _ in range(20_000):
        a, b = rng.choice(left), rng.choice(right)
        joined = merges.bytes_of[a] + merges.bytes_of[b]
        assert merges.compatible(a, b) == (merges.merge(joined, b in merges.ended_ids) == [a, b])


def test_remembered_words_are_bounded():
    remembered = bpe.Remembered(lambda keys: [k * 2 for k in keys], limit=10)
    for start in range(0, 100, 5):
        keys = set(range(start, start + 5))
        assert {k: remembered.of(keys)[k] for k in keys} == {k: 2 * k for k in keys}
        assert len(remembered.young) <= 10


def test_prefix_counts_equal_the_library(library):
    counter = token_counts.PrefixCounter(bpe.Merges(PATH))
    some = [t for t in texts(600, 3) if t.isascii()] + ["École <|endoftext|>'s"]
    parts, known = counter.split(some)
    for text, words in zip(some, parts):
        pieces = counter.merges.split_special.split(text)
        whole = "".join(
            p if p in counter.merges.special else token_counts.normalised_text(p) for p in pieces
        )
        want = [
            len(e.ids)
            for e in library.encode_batch([whole[: i + 1] for i in range(len(whole))], add_special_tokens=False)
        ]
        assert counter.prefixes(words, known).tolist() == want
        for limit in (0, 1, 4):
            fit = max([i + 1 for i, n in enumerate(want) if n <= limit], default=0)
            assert counter.totals(words, known, limit) == (want[-1] if want else 0, fit)


def test_stored_prefixes_answer_budgets(spark, documents):
    stored = token_counts.prefix_counts(documents, PATH)
    answers = stored.select(
        "doc_id", F.col("prefix_tokens")[F.size("prefix_tokens") - 1].cast("long").alias("n_tokens"),
        token_counts.longest_prefix(F.col("prefix_tokens"), 100).alias("fit_chars"),
    )
    counted = token_counts.count_tokens(documents, PATH, limit=100).select("doc_id", "n_tokens", "fit_chars")
    assert answers.exceptAll(counted).count() == counted.exceptAll(answers).count() == 0


def test_queries_equal_the_library(spark, documents, folder, library):
    from trendmill.llm.queries import op8_speculative_bpe, op9_prefix_token_counts

    encoded = {r["doc_id"]: r for r in op8_speculative_bpe(spark, folder).collect()}
    counted = {r["doc_id"]: r for r in op9_prefix_token_counts(spark, folder).collect()}
    for row in documents.collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        mine = encoded[row["doc_id"]]
        assert mine["n_tokens"] == counted[row["doc_id"]]["n_tokens"] == len(ids)
        assert mine["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert mine["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
        assert counted[row["doc_id"]]["n_bytes"] == len((row["text"] or "").encode())


def test_odd_rows(odd, none, library):
    rows = bpe.encode(odd, PATH).collect()
    texts_of = {r["doc_id"]: r["text"] or "" for r in odd.collect()}
    assert len(rows) == odd.count()
    for row in rows:
        if row["doc_id"] is not None:
            assert row["ids"] == library.encode(texts_of[row["doc_id"]], add_special_tokens=False).ids
    back = bpe.decode(bpe.encode(odd.select("doc_id", "text"), PATH), PATH)
    assert {r["text"] for r in back.where("doc_id in (2, 3)").collect()} == {""}
    counted = token_counts.count_tokens(odd, PATH).collect()
    assert sorted(r["n_tokens"] for r in counted) == sorted(len(r["ids"]) for r in rows)
    assert bpe.encode(none, PATH).count() == token_counts.count_tokens(none, PATH).count() == 0


def test_remembered_words_are_bounded_in_bytes():
    kept = bpe.Remembered(lambda keys: [k * 10 for k in keys], most=2_000_000)
    for turn in range(200):
        words = {f"{turn}-{i}-" + "x" * 500 for i in range(50)}
        known = kept.of(words)
        assert all(known[w] == w * 10 for w in words)
        assert sum(len(w) * 11 for some in (kept.young, kept.old) for w in some) < 4_000_000
    encoder = bpe.Encoder(bpe.encoder_of(PATH).merges)
    texts = ["".join(chr(97 + (i * j) % 26) for j in range(60)) for i in range(50)]
    before = bpe.PAIRS
    try:
        bpe.PAIRS = 40
        assert [encoder.encode_pieces([t])[0] for t in texts] == [
            tuple(encoder.merges.merge(t.encode())) for t in texts
        ]
    finally:
        bpe.PAIRS = before


def test_texts_in_arrays_equal_the_library(library):
    from trendmill.llm.array_bpe import SpeculatedTable

    table, some = SpeculatedTable(PATH), list(texts(3000, 17))
    flat, edges = table.flat_of(some)
    for text, a, b in zip(some, edges[:-1], edges[1:]):
        assert flat[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_arrays_of_units_give_the_exact_tokens():
    from trendmill.llm.array_bpe import ArrayMerges, SpeculatedTable

    encoder = bpe.Encoder(bpe.encoder_of(PATH).merges)
    exact = ArrayMerges(encoder.merges).encode
    pieces = ["nonsensicalish", "a", "", "ghtrle", "internationalisation", "é" * 9, "x" * 200, "the"]
    flat, sizes = encoder.encode_flat(pieces, exact)
    assert 0 < encoder.corrected < encoder.speculated == len(pieces)
    assert flat.tolist() == [i for p in pieces if p for i in encoder.merges.merge(p.encode())]
    assert sizes.tolist() == [len(encoder.merges.merge(p.encode())) if p else 0 for p in pieces]

    table = SpeculatedTable(PATH)
    texts = ["", "  ", "Don't stop", "A\u0301 b<|endoftext|>c", "stop\x1cIT", "x" * 3000, "stop"]
    reference = bpe.encode_texts(encoder, texts)
    for _ in range(2):
        flat, edges = table.flat_of(texts)
        assert [flat[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])] == reference
    assert table.flat_of([])[1].tolist() == [0]
    # A table begins anew when it is full.
    table.units.units = 1
    assert table.flat_of(texts)[0].tolist() == [i for ids in reference for i in ids]
