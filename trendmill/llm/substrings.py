"""Passages that repeat across documents, found by symbols that recompression gives equal substrings.

Words are named by a hash of their bytes. Recompression then replaces, from the left to the right of all
texts alike,

* runs of one word by a symbol for the word and its number,
* twice, pairs of a left and a right symbol (by one bit of their names) by a new symbol,

each named by a hash of what it replaces. Names depend on content alone, so all executors give one
name to equal content without a dictionary. A symbol also knows which words decide it: its own, those
that end its runs, and those of a neighbour that it could have been paired with. A window of 13 words
holds a symbol if all words that decide it lie in the window; equal windows hold equal symbols, and
they are neighbours. The window's form is the words before its symbols, the symbols, and the words
after them. A window inside a long run may hold none; then its words are its symbols.

1. Spark groups, of each window, one name of three neighbouring symbols, the smallest (of fewer
   symbols or of one word, if it holds no more), and keeps names met in more than one document.
2. Windows with such a name are named by their forms. Spark groups the forms and keeps the smallest
   document of each.
3. Windows that start in a smaller document too cover words, which go.

Exact copies are settled by a hash of their texts first. Forms differ if windows do, but names are hashes
and words are never compared: owners are grouped by 128 bits, covered words of a text are found by the
64-bit name of the form. Two bitmaps of fixed size (:mod:`trendmill.llm.filters`) spare names and
copies that can't matter; what they let through by chance is decided exactly.
"""

from functools import cached_property, lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from trendmill.llm import filters
from trendmill.llm.shared import bound_batches, id_and_text, map_column, map_texts, on_workers
from trendmill.session import written

#: Words of a window, and neighbouring symbols that are named together.
WINDOW, TOGETHER = 13, 3
#: Bytes of texts that a worker takes apart at a time.
SLAB = 250_000
#: Bytes of rows sent to a worker at a time.
BATCH = 4_000_000
#: Bits of the bitmaps of rows, 4 MB each.
ROW_BITS = 2**25
_BASES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_MOST = np.uint64(2**64 - 1)
#: Bits of a window's shared name that are grouped; a chance meeting only lets more windows be named whole.
_NAME_BITS = np.int64(2**40 - 1)


def _mixed(x):
    """Spreads every bit of 64-bit names over all others."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A random 64-bit number for each byte; the name of a word is their polynomial.
_BYTES = np.random.default_rng(5).integers(0, 2**64, 256, np.uint64)
_INVERSE = np.uint64(pow(int(_BASES[0]), -1, 2**64))


def _made_powers(base, count):
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, out=out)


#: The powers of a slab, made once a worker for each base.
_slab_powers = lru_cache(maxsize=2)(_made_powers)


def _powers(base, count):
    """The first ``count`` powers; those of a text longer than a slab are not kept."""
    most = 2 * SLAB
    return _slab_powers(base, most)[:count] if count <= most else _made_powers(base, count)


class Words:
    """The words of many texts in one row, split at ASCII white space and named by their bytes.

    ``names``, ``starts`` and ``ends`` (in ``data``, the texts with a blank after each) and ``text`` belong to
    words; ``left`` tells how many words of the text there are from each word on.
    """

    def __init__(self, texts):
        encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = np.frombuffer(b" ".join([*encoded, b""]), np.uint8).copy()
        self.space = _SPACE[self.data]
        edges = np.flatnonzero(np.diff(np.concatenate([[True], self.space, [True]]).view(np.int8)))
        self.starts, self.ends = edges[::2], edges[1::2]
        begins = np.concatenate([[0], np.cumsum([len(e) + 1 for e in encoded])])
        self.text = np.searchsorted(begins, self.starts, "right") - 1
        self.counts = np.bincount(self.text, minlength=len(texts)).astype(np.int64)
        self.left = np.cumsum(self.counts)[self.text] - np.arange(len(self.starts))

        size = len(self.data) + 1
        total = np.zeros(size, np.uint64)
        np.take(_BYTES, self.data, out=total[1:])
        total[1:] *= _powers(int(_BASES[0]), size)[:-1]
        np.cumsum(total, out=total)
        shift = _powers(int(_INVERSE), size)[self.starts]
        self.names = _mixed((total[self.ends] - total[self.starts]) * shift)

    @cached_property
    def symbols(self):
        return Symbols(self.names, self.text)

    def window_starts(self):
        return np.flatnonzero(self.left >= WINDOW)

    def joined(self, kept):
        """The kept words of each text, joined by one blank, as bytes."""
        edge = np.zeros(len(self.data) + 1, np.int8)
        edge[self.starts[kept]] += 1
        edge[self.ends[kept]] -= 1
        inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
        # A blank follows each word; that of a text's last word is cut off.
        inside[self.ends[kept]] = True
        data = self.data.copy()
        data[self.ends[kept]] = 0x20
        out = data[inside].tobytes()
        sizes = np.bincount(
            self.text[kept], self.ends[kept] - self.starts[kept] + 1, len(self.counts)
        ).astype(np.int64)
        ends = np.cumsum(sizes)
        return [out[e - n : max(e - n, e - 1)] for e, n in zip(ends.tolist(), sizes.tolist())]


def _prefixes(names):
    """Sums of the polynomial of all names up to each place."""
    total = np.zeros(len(names) + 1, np.uint64)
    np.cumsum(names * _powers(int(_BASES[0]), len(names)), out=total[1:])
    return total


def _sequence(total, first, end):
    """Names of the sequences from ``first`` to before ``end``, by the sums of :func:`_prefixes`."""
    value = (total[end] - total[first]) * _powers(int(_INVERSE), len(total))[first]
    return _mixed(value + (end - first).astype(np.uint64))


def _below(places, count):
    """How many of the ``places`` (-1 and up) lie below each of ``count`` places from 0 on."""
    return np.cumsum(np.bincount(places + 1, minlength=count + 1))[:count]


class Symbols:
    """What a round of runs and two rounds of pairs leave of the words of many texts.

    ``starts`` and ``ends`` are the words of each symbol; those from ``low`` to before ``high`` decide it. All
    four ascend. No symbol spans two texts.
    """

    def __init__(self, names, text):
        first = np.ones(len(names), bool)
        first[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
        self.starts = np.flatnonzero(first)
        self.ends = np.append(self.starts, len(names))[1:]
        self.text = text[self.starts]
        self.low, self.high = self.starts - 1, self.ends + 1
        # A side depends on a word alone, that of the first run, so the words beside a run tell what becomes of it.
        self.word, length = names[self.starts], (self.ends - self.starts).astype(np.uint64)
        self.names = np.where(length == 1, self.word, _mixed(self.word * _BASES[1] + length))
        left = self._left(1)
        # The last word of a symbol's first run tells its side, if it is known where the symbol starts.
        side = np.where(left, self.ends, self.starts) - 1
        at, kept = self._pair(left)
        side[at] = self.ends[at] - 1
        self.ends[at], self.high[at] = self.ends[at + 1], self.high[at + 1]
        self._keep(kept)

        left = self._left(2)
        # The next word tells why a left symbol stays alone, the side of the symbol before why a right one does.
        before = np.append(-1, side[kept])[:-1]
        self.low = np.where(left, self.low, np.minimum(self.low, before))
        at, kept = self._pair(left)
        self.ends[at], self.high[at] = self.ends[at + 1], self.high[at + 1]
        self._keep(kept)

    def _left(self, turn):
        return _mixed(self.word + np.uint64(turn)) & np.uint64(1) == 0

    def _pair(self, left):
        """Names neighbours of a left and a right side anew; their places, and which symbols go on."""
        at = np.flatnonzero(left[:-1] & ~left[1:] & (self.text[1:] == self.text[:-1]))
        self.names[at] = _mixed(self.names[at] * _BASES[0] + self.names[at + 1] * _BASES[1])
        kept = np.ones(len(left), bool)
        kept[at + 1] = False
        return at, kept

    def _keep(self, kept):
        for name in ("names", "word", "starts", "ends", "low", "high", "text"):
            setattr(self, name, getattr(self, name)[kept])

    def held(self, count):
        """Of the windows at the first ``count`` words, the first symbol held and the one after the last."""
        first = _below(self.low, count)
        end = _below(self.high - 1, count + WINDOW)[WINDOW:]
        return first, np.maximum(first, end)


def _spans(names, size, base):
    """Polynomial names of all runs of ``size`` words; those that span two texts mean nothing."""
    count = max(0, len(names) - size + 1)
    total = names[:count].copy()
    for i in range(1, size):
        total *= base
        total += names[i : i + count]
    return _mixed(total)


def _smallest(values, first, end):
    """The smallest value from ``first`` to before ``end`` (one value or more, at most 15)."""
    tables = np.full((4, len(values)), _MOST)
    tables[0] = values
    for turn in range(1, 4):
        step = 1 << (turn - 1)
        if len(values) > step:
            np.minimum(tables[turn - 1, :-step], tables[turn - 1, step:], out=tables[turn, :-step])
    turn = np.array([0, 0, 1, 1, 2, 2, 2, 2, 3, 3, 3, 3, 3, 3, 3, 3])[end - first]
    return np.minimum(tables[turn, first], tables[turn, end - (1 << turn)])


def standing_names(words):
    """By the place of its first word, the shared name that stands for each window."""
    count = max(0, len(words.names) - WINDOW + 1)
    first, end = words.symbols.held(count)
    out = np.empty(count, np.uint64)
    many, few = end - first >= TOGETHER, (end > first) & (end - first < TOGETHER)
    none = np.flatnonzero(end == first)
    out[many] = _smallest(
        _spans(words.symbols.names, TOGETHER, _BASES[0]), first[many], end[many] - (TOGETHER - 1)
    )
    out[few] = _sequence(_prefixes(words.symbols.names), first[few], end[few])
    out[none] = _smallest(words.names, none, none + WINDOW)
    return np.minimum(out, _MOST - np.uint64(1), out=out).view(np.int64)


def window_names(words):
    """By the place of its first word, the name of each window's form.

    With its standing name it has 128 bits.
    """
    count = max(0, len(words.names) - WINDOW + 1)
    first, end = words.symbols.held(count)
    start = np.arange(count)
    some = np.flatnonzero(end > first)
    before, after = start + WINDOW, start + WINDOW
    before[some] = words.symbols.starts[first[some]]
    after[some] = words.symbols.ends[end[some] - 1]
    single = _prefixes(words.names)
    out = _sequence(single, start, before) * _BASES[1]
    out += _sequence(_prefixes(words.symbols.names), first, end)
    out = _mixed(out) * _BASES[1] + _sequence(single, after, start + WINDOW)
    return _mixed(out).view(np.int64)


def _lists(values, text, count):
    """An Arrow array of the values of each of ``count`` texts; ``text`` is ascending."""
    offsets = np.searchsorted(text, np.arange(count + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _changes(values, text):
    """Which entries differ from the one before in the same text."""
    if not len(values):
        return np.zeros(0, bool)
    return np.concatenate([[True], (values[1:] != values[:-1]) | (text[1:] != text[:-1])])


def _shared_names(texts):
    words = Words(texts)
    at = words.window_starts()
    # Neighbouring windows mostly stand by one name; the filter's bits are all that is asked later.
    names, text = standing_names(words)[at] & _NAME_BITS, words.text[at]
    new = _changes(names, text)
    return {"names": _lists(names[new], text[new], len(texts))}


def _windows(texts, bitmap):
    """Standing and whole names of the windows whose standing name may be shared."""
    words = Words(texts)
    at = words.window_starts()
    stand = standing_names(words)[at]
    maybe = filters.may_hold(bitmap, stand)
    at, stand = at[maybe], stand[maybe]
    whole, text = window_names(words)[at], words.text[at]
    new = _changes(whole, text)
    return {
        "stand": _lists(stand[new], text[new], len(texts)),
        "whole": _lists(whole[new], text[new], len(texts)),
    }


def _covered(words, repeated):
    """Which words lie in a window whose name is among the ``repeated`` ones of its text."""
    def keyed(names, text):
        return _mixed(names.view(np.uint64) + text.astype(np.uint64) * _BASES[0])

    at = words.window_starts()
    sought = [np.array(r if r is not None else [], np.int64) for r in repeated]
    owner = np.repeat(np.arange(len(sought)), [len(r) for r in sought])
    known = keyed(np.concatenate([*sought, np.empty(0, np.int64)]), owner)
    starts = at[np.isin(keyed(window_names(words)[at], words.text[at]), known)]
    depth = np.zeros(len(words.names) + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + WINDOW, -1)
    return np.cumsum(depth[:-1]) > 0


def _keyed(docs):
    """``doc_id``, ``text`` and two hashes of the text."""
    return id_and_text(docs).withColumns({
        "t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text"),
    })


def _copies(rows):
    """``doc_id``, ``t1`` of rows whose whole text also stands in a smaller document."""
    narrow = rows.where("doc_id is not null").select("doc_id", "t1", "t2")
    firsts = written(
        narrow.groupBy("t1", "t2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last").drop("last"),
        "copied-texts",
    )
    later = narrow.join(firsts, ["t1", "t2"]).where("doc_id > first")
    return written(later.select("doc_id", "t1").distinct(), "copies")


def _is_row(doc_id, t1):
    """One hash of a row's id and text."""
    return F.xxhash64(doc_id, t1)


def _held(name, bitmap, wanted):
    """Picks rows whose ``name`` may be (or, if not ``wanted``, certainly isn't) in a broadcast bitmap."""
    def pick(batch):
        values = batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
        return np.flatnonzero(filters.may_hold(bitmap.value, values) == wanted)

    return pick


def _where(df, pick):
    def run(batches):
        for batch in batches:
            at = pick(batch)
            if len(at):
                yield batch.take(pa.array(at))

    return df.mapInArrow(run, df.schema)


def _repeats(rows, copies):
    """``doc_id``, ``whole``: names of windows of rows that start in a smaller document too."""
    spark = on_workers(rows.sparkSession)
    usable = rows.where("doc_id is not null")
    names = map_texts(
        usable.select("doc_id", "text"), lambda: _shared_names, "names array<long>", most=SLAB
    ).select("doc_id", F.explode("names").alias("name"))
    shared = (
        names.groupBy("name").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
        .where("a < b")
    )
    shared_bits = spark.sparkContext.broadcast(filters.build(shared, "name"))
    copy_bits = spark.sparkContext.broadcast(
        filters.build(copies.select(_is_row("doc_id", "t1").alias("row")), "row", ROW_BITS)
    )

    def named_whole(df, pick=None):
        return map_texts(
            df.select("doc_id", "row", "text"), lambda: lambda t: _windows(t, shared_bits.value),
            "stand array<long>, whole array<long>", most=SLAB, pick=pick,
        )

    # Rows that are no copies for certain go on where they are; only the others are joined.
    hashed = usable.select("doc_id", "t1", _is_row("doc_id", "t1").alias("row"), "text")
    unsure = _where(hashed, _held("row", copy_bits, True)).join(
        copies, ["doc_id", "t1"], "left_anti"
    )
    windows = (
        named_whole(hashed, _held("row", copy_bits, False)).unionAll(named_whole(unsure))
        .select("doc_id", F.explode(F.arrays_zip("stand", "whole")).alias("w"))
        .select("doc_id", "w.*")
    )
    owners = written(
        windows.groupBy("stand", "whole")
        .agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
        .where("owner < last").drop("last"),
        "repeated-windows",
    )
    return windows.join(owners, ["stand", "whole"]).where("doc_id > owner").select("doc_id", "whole")


def remove_repeats(docs, texts=True):
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and, if asked for, ``kept_text`` of every row.

    A word goes if one of the windows of 13 words around it also starts in a row with a smaller id.
    Windows are those of the input, whatever goes elsewhere. What stays is joined by one blank;
    ``kept_sha256`` is the digest of its UTF-8 bytes. Null and empty texts have no words. Rows with a
    null id neither lose words nor make others lose any. Rows repeated with their id lose the same
    words each.
    """
    spark = on_workers(docs.sparkSession)
    bound_batches(spark, BATCH)
    rows = _keyed(docs)
    copies = _copies(rows)
    found = _repeats(rows, copies).groupBy("doc_id").agg(F.collect_set("whole").alias("wholes"))
    copied = copies.groupBy("doc_id").agg(F.collect_set("t1").alias("copied"))
    marks = written(
        found.join(copied, "doc_id", "full_outer").withColumn("row", F.xxhash64("doc_id")), "repeats"
    )
    # Rows without a repeat for certain are finished where they are; only the others are joined.
    marked = spark.sparkContext.broadcast(filters.build(marks.select("row"), "row", ROW_BITS))
    hashed = rows.select("doc_id", "t1", F.xxhash64("doc_id").alias("row"), "text")
    joined = _where(hashed, _held("row", marked, True)).join(marks.drop("row"), "doc_id", "left").select(
        "doc_id", "row", "text", "wholes",
        F.coalesce(F.array_contains("copied", F.col("t1")), F.lit(False)).alias("copy"),
    )
    plain = hashed.select(
        "doc_id", "row", "text", F.lit(None).cast("array<bigint>").alias("wholes"),
        F.lit(False).alias("copy"),
    )

    def finish(frame):
        words = Words([r["text"] for r in frame])
        copy = np.array([r["copy"] for r in frame], bool) & (words.counts >= WINDOW)
        kept = ~(_covered(words, [r["wholes"] for r in frame]) | copy[words.text])
        joined = words.joined(kept)
        out = {
            "n_words": words.counts,
            "n_removed": words.counts - np.bincount(words.text[kept], minlength=len(frame)),
            "kept_sha256": [sha256(t).hexdigest() for t in joined],
        }
        if texts:
            out["kept_text"] = [t.decode("utf-8", "replace") for t in joined]
        return out

    schema = "n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if texts else "")

    def finished(df, pick=None):
        rows = df.select("doc_id", "row", F.struct("text", "wholes", "copy").alias("rows"))
        return map_column(rows, "rows", lambda: finish, schema, most=SLAB, pick=pick).drop("row")

    return finished(plain, _held("row", marked, False)).unionAll(finished(joined))
