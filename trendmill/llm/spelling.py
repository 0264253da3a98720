"""Spelling variants: words one edit apart, found by a trie over letter-group counts.

Letters form disjoint groups; a word's vector says how many letters it has of each. Words are arranged
in a trie by these counts, one group a level. One inserted, deleted or replaced letter changes the
vector by at most one surplus and one deficit, so a depth-first search follows a word's own counts
and may spend each of the two once. The words of a leaf it reaches are verified letter by letter.

Spark counts the words and deals them to cells, the nodes of the trie some levels down; a word is sought
in every cell it can reach with its budget. A cell with too many words is left for one more levels
down; at the last level words are dealt to parts, each of which is searched. So no task holds
more than a bounded number of words, and no link is lost. Inside a task the search runs over arrays:
a frame of the stack is a run of (word, node, budget) rows of one level.
"""

from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from trendmill.llm.shared import on_workers
from trendmill.llm.word_table import ragged
from trendmill.session import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "[A-Za-zÀ-ÿ]"
LEAST_LETTERS, LEAST_COUNT, SLIP, RATIO = 7, 2, 31, 10
#: Levels of the trie; all other letters are a last group. The first ones deal words to cells.
GROUPS = ("ei", "an", "rt", "s", "o", "h", "l", "u", "c", "d", "m", "g", "b", "fp", "kvwz", "jqxy")
LEVELS = len(GROUPS) + 1
#: Levels at which cells are formed, and words that a cell may have above the last of them.
DEPTHS, CELL_WORDS = (3, 6, 9, 12, LEVELS), 200_000
#: Letters compared in arrays; pairs with a longer word are compared one by one.
WIDE = 40
#: Rows of a frame of the search, pairs verified at a time, words sought at a time.
FRAME, PAIRS, SOUGHT = 200_000, 200_000, 50_000

_GROUP = np.full(256, LEVELS - 1, np.int64)
for _i, _letters in enumerate(GROUPS):
    _GROUP[[ord(c) for c in _letters]] = _i


def counted_words(docs, least_letters=LEAST_LETTERS, least_count=LEAST_COUNT):
    """``word``, ``n``: words of all texts after slips, with how often they occur.

    A run of letters, A to Z lowered, loses one letter if its checksum with the document's id says so. A null
    id stands for no digits. Null and empty texts have no words.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    runs = F.regexp_extract_all(text, F.lit(f"({LETTERS}{{{least_letters},}})"), F.lit(1))
    run = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run")
    ).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    checked = run.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    size = F.char_length("run")
    place = (F.col("h") % size).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, size))
    word = F.when(F.col("h") % SLIP == 0, shorter).otherwise(F.col("run"))
    return (
        checked.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
        .where((F.char_length("word") >= least_letters) & (F.col("n") >= least_count))
    )


def _letters(words):
    """Sizes and letters (as Latin-1) of an Arrow column of words."""
    sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    data = "".join(words.to_pylist()).encode("latin-1")
    return sizes, np.frombuffer(data, np.uint8)


def vectors(words):
    """A row of group counts for each word of an Arrow column."""
    sizes, data = _letters(words)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.bincount(owner * LEVELS + _GROUP[data], minlength=len(sizes) * LEVELS).reshape(-1, LEVELS)


def _moves(depth):
    """All changes of the first ``depth`` counts within the budget, as rows."""
    one = np.eye(depth, dtype=np.int64)
    up_down = [a - b for i, a in enumerate(one) for j, b in enumerate(one) if i != j]
    return np.array([np.zeros(depth, np.int64), *one, *-one, *up_down]).reshape(-1, depth)


def _keys(counts):
    """A binary key for each row of counts."""
    data = np.ascontiguousarray(np.minimum(counts, 65_535), ">u2")
    width = data.shape[1] * 2
    edges = pa.py_buffer(np.arange(0, (len(data) + 1) * width, width, dtype=np.int32))
    return pa.Array.from_buffers(pa.binary(), len(data), [None, edges, pa.py_buffer(data)])


_KEYED = pa.schema([("word", pa.string()), ("n", pa.int64()), ("cell", pa.binary())])


def _cells_of(words, depth, reach=False):
    """``words`` with their cell at a depth or, with ``reach``, a row for each cell they can reach."""
    moves = _moves(depth) if reach else np.zeros((1, depth), np.int64)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 10_000):
                some = batch.slice(start, 10_000)
                counts = vectors(some.column(0))[:, :depth]
                near = (counts[:, None, :] + moves).reshape(-1, depth)
                fine = np.flatnonzero((near >= 0).all(axis=1))
                rows = pa.array(fine // len(moves))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(rows), some.column(1).take(rows), _keys(near[fine])], schema=_KEYED
                )

    return words.select("word", "n").mapInArrow(run, "word string, n long, cell binary")


class Trie:
    """Words of an Arrow column with their counts, sorted by vector; a node is a run of rows."""

    def __init__(self, words, counts):
        found = vectors(words)
        order = np.lexsort(found.T[::-1])
        words = words.take(pa.array(order))
        self.words, self.n = words, counts[order]
        self.rank = np.empty(len(order), np.int64)
        # Code-point order is that of the bytes in UTF-8.
        self.rank[pc.sort_indices(words.cast(pa.binary())).to_numpy()] = np.arange(len(order))
        found = found[order]
        self.levels, node = [], np.zeros(len(order), np.int64)
        for level in range(LEVELS):
            keys = node << 32 | found[:, level]
            first = np.diff(keys, prepend=-1) != 0
            self.levels.append(keys[first])
            node = np.cumsum(first) - 1
        self.leaf = np.append(np.flatnonzero(np.diff(node, prepend=-1)), len(order))
        self.left, self.right, self.sizes = aligned(words)

    def leaves(self, sought):
        """Yields ``(rows of sought, leaves)`` that the search reaches within the budget."""
        count = len(sought)
        stack = [(0, np.arange(count), np.zeros(count, np.int64), np.ones(count, bool), np.ones(count, bool))]
        while stack:
            level, row, node, surplus, deficit = stack.pop()
            if level == LEVELS:
                yield row, node
                continue
            if len(row) > FRAME:
                half = len(row) // 2
                stack += [(level, *[x[s] for x in (row, node, surplus, deficit)])
                          for s in (slice(half), slice(half, None))]
                continue
            keys = self.levels[level]
            own = sought[row, level]
            parts = []
            for step, may in ((0, None), (1, surplus), (-1, deficit)):
                at = slice(None) if may is None else np.flatnonzero(may)
                key = node[at] << 32 | np.maximum(own[at] + step, 0)
                place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = (keys[place] == key) & (own[at] + step >= 0)
                parts.append((
                    row[at][hit], place[hit], surplus[at][hit] & (step != 1), deficit[at][hit] & (step != -1)
                ))
            merged = [np.concatenate(x) for x in zip(*parts)]
            if len(merged[0]):
                stack.append((level + 1, *merged))

    def near(self, words):
        """Rows of ``words`` and of this trie that are exactly one edit apart, in chunks."""
        left, right, sizes = aligned(words)
        for row, leaf in self.leaves(vectors(words)):
            places, held = ragged(self.leaf, leaf)
            row = np.repeat(row, held)
            for start in range(0, len(row), PAIRS):
                a, b = row[start : start + PAIRS], places[start : start + PAIRS]
                most = np.maximum(sizes[a], self.sizes[b])
                head = _same(left[a], self.left[b])
                tail = _same(right[a], self.right[b])
                fits = (head + tail >= most - 1) & (head < most)
                for i in np.flatnonzero(most > WIDE).tolist():
                    fits[i] = one_edit(words[int(a[i])].as_py(), self.words[int(b[i])].as_py())
                yield a[fits], b[fits]


def aligned(words):
    """Letters of words in rows, from the left and from the right, and sizes; zero where there is none."""
    sizes, data = _letters(words)
    ends = np.cumsum(sizes)
    left = np.zeros((len(sizes), WIDE), np.uint8)
    right = np.zeros((len(sizes), WIDE), np.uint8)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(data)) - (ends - sizes)[owner]
    back = sizes[owner] - 1 - place
    some = place < WIDE
    left[owner[some], place[some]] = data[some]
    some = back < WIDE
    right[owner[some], back[some]] = data[some]
    return left, right, sizes


def _same(a, b):
    """How many first letters of two matrices' rows agree."""
    other = a != b
    return np.where(other.any(axis=1), other.argmax(axis=1), a.shape[1])


def one_edit(a, b):
    """Whether two words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


_FOUND = pa.schema([
    ("word", pa.string()), ("n_near", pa.int64()), ("least", pa.int64()), ("near", pa.string())
])


def _search(batches):
    """What the words sought in each cell find there; a cell's own words come first."""
    columns = ("depth", "cell", "part", "sought", "word", "n")

    def runs():
        for batch in batches:
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(4)]))
            start = 0
            for key, some in groupby(keys):
                size = len(list(some))
                yield key, batch.slice(start, size).select(columns[4:])
                start += size

    def answer(trie, words):
        found = [(a, b) for a, b in trie.near(words) if len(a)]
        if not found:
            return
        a, b = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((trie.rank[b], -trie.n[b], a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.diff(a, prepend=-1))
        best = b[first]
        yield pa.RecordBatch.from_arrays(
            [words.take(pa.array(a[first])), pa.array(np.diff(np.append(first, len(a)))),
             pa.array(-trie.n[best]), trie.words.take(pa.array(best))], schema=_FOUND,
        )

    for _, group in groupby(runs(), lambda r: r[0][:3]):
        stored, trie = [], None
        waiting, held = [], 0
        for key, batch in group:
            if not key[3]:
                stored.append(batch)
                continue
            if trie is None:
                if not stored:
                    break
                table = pa.Table.from_batches(stored).combine_chunks()
                trie = Trie(table.column(0).combine_chunks(), table.column(1).to_numpy())
            waiting.append(batch.column(0))
            held += len(batch)
            if held >= SOUGHT:
                yield from answer(trie, pa.concat_arrays(waiting))
                waiting, held = [], 0
        if waiting:
            yield from answer(trie, pa.concat_arrays(waiting))


def near_words(words, cell_words=CELL_WORDS):
    """``word``, ``n_near``, ``near`` and ``near_n`` of the words of ``words`` that have a near word.

    ``words`` has distinct words with counts ``n``. ``near`` is the near word of the largest count, of
    several the smallest in code-point order.
    """
    on_workers(words.sparkSession)
    store, rows = words, None
    for depth in DEPTHS:
        last = depth == DEPTHS[-1]
        kept = _cells_of(store, depth)
        sizes = written(kept.groupBy("cell").agg(F.count("*").alias("size")), "cells")
        small = sizes if last else sizes.where(F.col("size") <= cell_words)
        small = small.select("cell", F.ceil(F.col("size") / cell_words).cast("int").alias("parts"))
        parts = F.col("parts")
        own = kept.join(small, "cell").select(
            F.lit(depth).alias("depth"), "cell", F.pmod(F.xxhash64("word"), parts).cast("int").alias("part"),
            F.lit(False).alias("sought"), "word", "n",
        )
        sought = _cells_of(words, depth, reach=True).join(small, "cell").select(
            F.lit(depth).alias("depth"), "cell", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"),
            F.lit(True).alias("sought"), "word", "n",
        )
        rows = own.unionAll(sought) if rows is None else rows.unionAll(own).unionAll(sought)
        large = sizes.where(F.col("size") > cell_words)
        if last or large.isEmpty():
            break
        store = written(kept.join(large, "cell", "left_semi").select("word", "n"), "words-of-large-cells")
    keys = ["depth", "cell", "part"]
    found = rows.repartition(*keys).sortWithinPartitions(*keys, "sought").mapInArrow(
        _search, "word string, n_near long, least long, near string"
    )
    best = F.min(F.struct("least", "near"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.near").alias("near"), (-F.col("best.least")).alias("near_n")
    )


def roots(forms):
    """``word``, ``root`` for rows of ``word`` and ``form``: the last word reached by following forms.

    Every round doubles the steps taken, so a chain of n forms takes about log n rounds.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(now.join(then, "root", "left"), "roots")
        now = moved.select("word", F.coalesce("next", "root").alias("root"))
        if moved.where("next is not null").isEmpty():
            return now


def variants(docs, ratio=RATIO, cell_words=CELL_WORDS, **limits):
    """The words of all texts with the spelling each is probably a variant of.

    Columns: ``word``, ``n`` (occurrences), ``n_near`` (words exactly one edit away), ``form`` (of these the
    one with the largest count, if that is at least ``ratio`` times ``n``; ties: the smallest), ``form_n``
    and ``root`` (the last word reached by following forms, the word itself without a form). Words
    are those of :func:`counted_words`. Repeated rows count each. An empty table, or texts
    without such words, give no rows. Further columns are left out, whatever their names.
    """
    words = written(counted_words(docs, **limits), "words")
    linked = words.join(near_words(words, cell_words), "word", "left")
    has = F.col("near_n") >= F.col("n") * ratio
    formed = written(linked.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("near")).alias("form"), F.when(has, F.col("near_n")).alias("form_n"),
    ), "forms")
    found = roots(formed.where("form is not null"))
    return formed.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
