"""Token files against the tokenizers library, and exact round trips of the grammar."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as hnp
from tokenizers import Tokenizer

from trendmill.llm import grammar, token_files
from trendmill.llm.queries import op12_repair_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    out = Tokenizer.from_file(PATH)
    out.no_padding()
    out.no_truncation()
    return out


def _expected(rows, library):
    """Rows of the contract by the library, one document after the other."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def _rows(df):
    return sorted([tuple(r) for r in df.collect()], key=lambda r: r[1])


def test_query_equals_library(spark, folder, documents, library):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    found = op12_repair_token_files(spark, folder)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert _rows(found) == _expected(rows, library)


STRANGE = [
    "", " ", "don't WON'T we'LL x's 's !!'s ''s a'b", "<|endoftext|>", "a<|startoftext|>B <|endoftext|", "<||> <|",
    "J̌ H̱ É é İ ẞ ΑΣ ΣΑΣ", "tab\tnew\nline\r\x0b\x0cx", "a\x1cb\x1d c\x85d e　f", "123abc!?x-Y_z..",
    "日本語 テスト", "\x00 nul\x00x", "😀é́", "Ünïcödé…", "'", "'s", "x'S'T", "K Å",
]


def test_strange_texts_in_small_shards(spark, library, tmp_path):
    rows = [(i // 3, t) for i, t in enumerate(STRANGE * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path = str(tmp_path / "files")
    token_files.write_token_files(docs, path, PATH, end_id=2, part_tokens=100, shard_tokens=40)
    found = token_files.read_token_files(spark, path, ids=True).collect()
    expected = sorted([(d, library.encode(t, add_special_tokens=False).ids + [2]) for d, t in rows])
    assert sorted([(r.doc_id, r.ids) for r in found]) == expected
    by_start = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in by_start] == sorted(d for d, _ in rows)
    flat = [i for r in by_start for i in r.ids]
    assert [r.start for r in by_start] == np.cumsum([0, *[r.n_tokens for r in by_start]])[:-1].tolist()
    span = token_files.read_range(spark, path, 37, 153).orderBy("at").collect()
    assert [r["at"] for r in span] == list(range(37, 153))
    assert [r["id"] for r in span] == flat[37:153]


def test_odd_rows_and_empty_table(spark, odd, none, library, tmp_path):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    token_files.write_token_files(odd, str(tmp_path / "odd"), PATH, end_id=2)
    found = _rows(token_files.read_token_files(spark, str(tmp_path / "odd")))
    assert [r[0] for r in found] == [r[0] for r in _expected(rows, library)]
    counts = [sorted((d, n, c) for d, _, n, c in some if d is not None) for some in (found, _expected(rows, library))]
    assert counts[0] == counts[1]
    token_files.write_token_files(none, str(tmp_path / "none"), PATH, end_id=2)
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0


@settings(max_examples=60, deadline=None)
@given(hnp.arrays(np.int64, st.integers(0, 3000), elements=st.integers(0, 6)), st.data())
def test_grammar_round_trip(ids, data):
    shard = grammar.Shard(grammar.compress(ids, least_uses=2))
    assert (shard.all() == ids).all()
    start = data.draw(st.integers(0, len(ids)))
    stop = data.draw(st.integers(start, len(ids)))
    assert shard.span(start, stop).tolist() == ids[start:stop].tolist()


def test_grammar_of_long_and_wide_input():
    rng = np.random.default_rng(3)
    words = [rng.integers(0, 40_000, rng.integers(2, 9)) for _ in range(300)]
    ids = np.concatenate([words[i] for i in rng.zipf(1.3, 60_000) % 300])
    data = grammar.compress(ids)
    shard = grammar.Shard(data)
    assert (shard.all() == ids).all() and len(shard.seq) < len(ids) / 3
    assert (shard.sizes[shard.n_used:] >= 2).all()
    assert shard.span(70_001, 70_009).tolist() == ids[70_001:70_009].tolist()
    wide = np.concatenate([np.arange(60_000), np.tile([7, 8, 9], 500), [2**31]])
    assert (grammar.Shard(grammar.compress(wide)).all() == wide).all()


def test_pairs_of_a_long_shard_are_counted_at_all_places():
    """A pair that never stands at a fourth place gets its rule, in a long input as in a short one."""
    for blocks in (1_000, 50_000):
        ids = np.empty((blocks, 4), np.int64)
        ids[:, 0], ids[:, 3] = 10 + np.arange(2 * blocks).reshape(2, blocks)
        ids[:, 1:3] = 1, 2
        shard = grammar.Shard(grammar.compress(ids.ravel()))
        assert len(shard.seq) == 3 * blocks
        assert (shard.all() == ids.ravel()).all()
