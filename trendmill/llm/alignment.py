"""Alignment of two tokenizers over a corpus, with corpus-wide counts of the id pairs they link.

Both tokenizers cut the same bytes. A link is a token of side A and one of side B that share bytes;
places where both sides end cut a text into groups. How often an id pair is linked is counted over the
whole corpus by external spilling:

1. Tasks align slabs of texts. Their pair-document records, sorted by pair and document, are split by
   the high bits of the B id (a radix) and stored as zstd runs in the shared folder.
2. Runs of a bucket are merged through a heap of their open frames. A merge first joins
   what a task holds, then, in rounds of bounded fan-in, what other tasks made.
3. The order is side-major, all pairs of a B id stand together, so one pass gives counts and each B id's
   largest count.
4. The runs stream by once more beside their bucket's counts; what a run adds to its documents goes
   back to the slab they came from. A bucket is dealt over as many parts as its records need, so a
   frequent B id is no hot task.

A unit of text (:mod:`trendmill.llm.word_table`) is aligned once a worker: no token of the two
vocabularies reaches over the cut in front of a blank.
"""

import base64
import heapq
import struct
import uuid
from functools import lru_cache
from hashlib import sha256
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import functions as F

from trendmill.llm.shared import id_and_text, on_workers
from trendmill.llm.word_table import WordTable, before_blanks, ragged, text_slabs, units
from trendmill.session import written

#: Bytes of text that are aligned, sorted and spilled at a time.
SLAB = 8_000_000
#: High bits of the mixed B id that name a bucket.
RADIX = 6
#: Records of a bucket that one task streams through; a larger bucket is dealt over several.
PART_RECORDS = 8_000_000
#: Runs that one task merges, and pairs in a frame of a run.
FAN_IN, FRAME = 256, 32_768
#: Odd, so that it mixes 16-bit ids without joining any two.
_MIX = 40503
_LEVEL = 3


def pack(values):
    """Bytes of whole numbers from 0: the narrowest type, byte planes, zstd."""
    values = np.asarray(values)
    top = int(values.max()) if len(values) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return struct.pack("<BI", width, len(values)) + zstandard.compress(planes.tobytes(), _LEVEL)


def unpack(data):
    """The numbers of :func:`pack` as int64."""
    width, count = struct.unpack_from("<BI", data)
    planes = np.frombuffer(zstandard.decompress(data[5:]), np.uint8).reshape(width, count)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)


def _frame(pairs, counts):
    """A frame of a run: ascending pairs as differences, and their counts."""
    a, b = pack(np.diff(pairs, prepend=0)), pack(counts)
    return struct.pack("<II", len(a), len(b)) + a + b


def to_run(pairs, counts):
    return b"".join(
        _frame(pairs[i : i + FRAME], counts[i : i + FRAME]) for i in range(0, len(pairs), FRAME)
    )


def frames(run):
    """Frames of a run, opened one after the other."""
    at = 0
    while at < len(run):
        a, b = struct.unpack_from("<II", run, at)
        at += 8
        yield np.cumsum(unpack(run[at : at + a])), unpack(run[at + a : at + a + b])
        at += a + b


def merged(runs):
    """Ascending chunks of pairs with their counts added up over all runs.

    The heap holds the last pair of each run's open frame. Up to the smallest of these all that
    any run has is open, so it can be added up; then that run's next frame is opened.
    """
    readers, heads, heap = [frames(r) for r in runs], {}, []

    def open_next(i):
        frame = next(readers[i], None)
        if frame is None:
            heads.pop(i, None)
        else:
            heads[i] = frame
            heapq.heappush(heap, (int(frame[0][-1]), i))

    for i in range(len(readers)):
        open_next(i)
    while heap:
        bound = heap[0][0]
        pairs, counts = [], []
        for i, (p, c) in heads.items():
            cut = int(np.searchsorted(p, bound, "right"))
            if cut:
                pairs.append(p[:cut])
                counts.append(c[:cut])
                heads[i] = (p[cut:], c[cut:])
        while heap and heap[0][0] == bound:
            open_next(heapq.heappop(heap)[1])
        yield _added(np.concatenate(pairs), np.concatenate(counts))


def _added(pairs, counts):
    order = np.argsort(pairs, kind="stable")
    pairs, counts = pairs[order], counts[order]
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    return pairs[first], np.add.reduceat(counts, first)


def _mixed(ids):
    return ids * _MIX & 0xFFFF


class Aligner:
    """Aligns units that begin with a blank; side A from ranks, side B from a piece model."""

    def __init__(self, ranks_path, model_path):
        with open(ranks_path, encoding="ascii") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, file)}
        self.side_a = tiktoken.Encoding(
            "side-a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.side_b = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size_b = self.side_b.get_piece_size()
        size_a = max(ranks.values()) + 1
        if max(size_a, size_b) > 1 << 16:
            raise ValueError("ids of both sides must fit 16 bits")
        self.bytes_a = [b""] * size_a
        for data, i in ranks.items():
            self.bytes_a[i] = data
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.side_b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(map(self.side_b.id_to_piece, range(size_b)))
        ]
        self.sizes_a = np.array(list(map(len, self.bytes_a)))
        self.sizes_b = np.array(list(map(len, self.bytes_b)))
        most = max(size_a, size_b)
        digits = np.array([str(i) for i in range(most)], "S5").view(np.uint8).reshape(most, 5)
        #: Bytes of each id followed by a comma, a bar or a semicolon; zero where there is none.
        self.written = np.zeros((3, most, 6), np.uint8)
        for k, mark in enumerate(b",|;"):
            self.written[k, :, :5] = digits
            self.written[k, np.arange(most), (digits > 0).sum(1)] = mark
        self.written = self.written.reshape(3 * most, 6)
        self.most = most

    def __call__(self, texts):
        """Links, counts and written groups of units, for a :class:`WordTable`."""
        a = [self.side_a.encode_ordinary(u) for u in texts]
        b = self.side_b.encode([u[1:] for u in texts], num_threads=1)
        same = np.empty(len(texts), bool)
        for i, u in enumerate(texts):
            data = u.encode()
            same[i] = (
                b"".join([self.bytes_a[t] for t in a[i]]) == data
                and b"".join([self.bytes_b[t] for t in b[i]]) == data
            )
            if not same[i]:
                a[i], b[i] = (), ()
        n_a = np.fromiter(map(len, a), np.int64, len(a))
        n_b = np.fromiter(map(len, b), np.int64, len(b))
        a = np.fromiter(chain.from_iterable(a), np.int64, n_a.sum())
        b = np.fromiter(chain.from_iterable(b), np.int64, n_b.sum())
        # All units lie one after the other, so both sides end where a unit ends.
        end_a, end_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        total = int(end_a[-1]) if len(end_a) else 0
        marks = np.zeros(total + 1, np.uint8)
        marks[end_a] = 1
        marks[end_b] |= 2
        ends = np.flatnonzero(marks)
        mark = marks[ends]
        in_a, in_b = mark & 1, mark >> 1
        at_a = np.cumsum(in_a, dtype=np.int64) - in_a
        at_b = np.cumsum(in_b, dtype=np.int64) - in_b
        links = _mixed(b[at_b]) << 16 | a[at_a]
        common = np.flatnonzero(mark == 3)
        upto_a, upto_b = at_a[common] + 1, at_b[common] + 1
        # How many links and groups lie in each unit, from where its last token ends.
        last = np.concatenate([np.zeros(1, np.int64), np.cumsum(n_a)])
        edge = np.concatenate([np.zeros(1, np.int64), end_a])[last]
        n_links = np.diff(np.searchsorted(ends, edge, "right"))
        n_groups = np.diff(np.searchsorted(ends[common], edge, "right"))
        return {
            "sizes": n_links, "flat": links.astype(np.uint32), "n_a": n_a, "n_b": n_b,
            "n_groups": n_groups, "same": same,
            "objects": self._written(a, b, upto_a, upto_b, n_a + n_b),
        }

    def _written(self, a, b, upto_a, upto_b, sizes):
        """Groups of each unit as text, a semicolon after each."""
        from_a = np.concatenate([[0], upto_a])[:-1].astype(np.int64)
        from_b = np.concatenate([[0], upto_b])[:-1].astype(np.int64)
        code = np.empty(len(a) + len(b), np.int64)
        group_a = np.repeat(np.arange(len(upto_a)), upto_a - from_a)
        group_b = np.repeat(np.arange(len(upto_b)), upto_b - from_b)
        end_a, end_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        end_a[upto_a - 1], end_b[upto_b - 1] = 1, 2
        code[np.arange(len(a)) + from_b[group_a]] = a + end_a * self.most
        code[np.arange(len(b)) + upto_a[group_b]] = b + end_b * self.most
        rows = self.written[code]
        full = rows != 0
        data = rows[full].tobytes()
        ends = np.cumsum(full.sum(1))
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        return [data[s:e] for s, e in zip(edges, edges[1:])]


@lru_cache(maxsize=2)
def _table(ranks_path, model_path):
    """The remembered units of two vocabularies, one table for the life of a worker."""
    return WordTable(Aligner(ranks_path, model_path))


_RUNS = (
    "slab string, bucket int, records long, run binary, sizes binary, docs binary, times binary, "
    "doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "digest array<string>"
)


def _spilled(texts, table):
    """Documents' figures and sorted records of a slab of texts without nulls."""
    prefixed = pc.binary_join_element_wise(pa.scalar("", texts.type), texts, pa.scalar(" ", texts.type))
    found, counts = units(prefixed, before_blanks, last=False)
    rows = table.rows_of(found)
    owner = np.repeat(np.arange(len(texts)), counts)
    column = table.columns
    whole = np.bincount(owner[~column["same"][rows]], minlength=len(texts)) == 0
    rows, owner = rows[whole[owner]], owner[whole[owner]]
    counts = np.where(whole, counts, 0)
    objects = table.objects
    edges = np.concatenate([[0], np.cumsum(counts)]).tolist()
    listed = rows.tolist()
    digests = []
    for s, e in zip(edges, edges[1:]):
        groups = b"".join([objects[i] for i in listed[s:e]])
        digests.append(sha256(groups[:-1]).hexdigest() if groups else "")
    places, sizes = ragged(table.offsets, rows)

    def per_text(values):
        return np.bincount(owner, values[rows], len(texts)).astype(np.int64)

    figures = {n: per_text(column[n]) for n in ("n_a", "n_b", "n_groups")}
    figures["n_links"] = per_text(np.diff(table.offsets))
    keys = table.flat[places].astype(np.uint64) << np.uint64(32) | np.repeat(owner, sizes).astype(np.uint64)
    keys.sort()
    return figures, digests, keys


def _runs(keys):
    """Runs of each bucket: pairs with counts; records a pair, documents and times of the records."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    times = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    pairs = (keys >> np.uint64(32)).astype(np.int64)
    docs = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edges = np.searchsorted(pairs, np.arange((1 << RADIX) + 1) << (32 - RADIX))
    for bucket, (s, e) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        if s == e:
            continue
        p, d = pairs[s:e], docs[s:e]
        start = np.flatnonzero(np.diff(p, prepend=-1))
        gap = np.diff(d, prepend=0)
        gap[start] = d[start]
        yield {
            "bucket": bucket, "records": e - s, "run": to_run(p[start], np.add.reduceat(times[s:e], start)),
            "sizes": pack(np.diff(np.append(start, e - s))), "docs": pack(gap), "times": pack(times[s:e] - 1),
        }


def spill(docs, ranks_path, model_path, slab=SLAB):
    """The table of runs, and of each slab's documents (``bucket`` -1), written to the shared folder.

    A slab's name is drawn when it is spilled. Only the rows of a task that ended well are
    part of the written table, so runs and documents of a name always belong together.
    """
    on_workers(docs.sparkSession)
    rows = id_and_text(docs)

    def run(batches):
        table = _table(ranks_path, model_path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for start, end in text_slabs(texts, slab):
                figures, digests, keys = _spilled(texts.slice(start, end - start), table)
                name = uuid.uuid4().hex
                made = [{"slab": name} | r for r in _runs(keys)]
                del keys
                made.append(
                    {"slab": name, "bucket": -1, "records": 0, "digest": digests,
                     "doc_id": ids.slice(start, end - start).to_pylist()}
                    | {k: v.tolist() for k, v in figures.items()}
                )
                yield pa.RecordBatch.from_pylist(made, _SPILLED)
                pa.default_memory_pool().release_unused()

    return written(rows.mapInArrow(run, _RUNS), "alignment-runs")


_LISTS = [("doc_id", pa.int64()), *[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")],
          ("digest", pa.string())]
_SPILLED = pa.schema(
    [("slab", pa.string()), ("bucket", pa.int32()), ("records", pa.int64())]
    + [(n, pa.binary()) for n in ("run", "sizes", "docs", "times")]
    + [(n, pa.list_(t)) for n, t in _LISTS]
)
_COUNTED = pa.schema([("bucket", pa.int32()), ("run", pa.binary())])


def _merge_held(batches, most=32_000_000):
    """Merges the runs of each bucket that a task holds, whenever these have ``most`` bytes."""
    held, size = {}, 0

    def flush():
        for bucket, runs in sorted(held.items()):
            yield pa.RecordBatch.from_pylist(
                [{"bucket": bucket, "run": b"".join(to_run(p, c) for p, c in merged(runs))}], _COUNTED
            )
        held.clear()

    for batch in batches:
        buckets = batch.column(0).to_pylist()
        for bucket, run in zip(buckets, batch.column(1)):
            run = run.as_py()
            held.setdefault(bucket, []).append(run)
            size += len(run)
            if size > most:
                yield from flush()
                size = 0
    yield from flush()


def count_pairs(runs, fan_in=FAN_IN):
    """``bucket``, ``run``: one counted run for each bucket, of the runs of all slabs.

    Rounds go on until a bucket has at most ``fan_in`` runs; then one task a bucket merges these.
    """
    counted = written(
        runs.where("bucket >= 0").select("bucket", "run").mapInArrow(_merge_held, "bucket int, run binary"),
        "counted-runs",
    )
    while True:
        most = counted.groupBy("bucket").count().agg(F.max("count")).first()[0] or 0
        if most <= fan_in:
            return counted
        dealt = counted.withColumn(
            "part", F.pmod(F.xxhash64(F.md5("run")), F.lit(-(-most // fan_in)))
        ).repartition("bucket", "part").sortWithinPartitions("bucket", "part").drop("part")
        counted = written(dealt.mapInArrow(_merge_held, "bucket int, run binary"), "counted-runs")


_TOTALS = pa.schema([("bucket", pa.int32()), ("run", pa.binary()), ("best", pa.binary())])


def _by_bucket(batches, columns):
    """Rows of consecutive equal buckets as ``(bucket, iterator of the columns' values)``."""
    def rows():
        for batch in batches:
            for i in range(batch.num_rows):
                yield tuple(batch.column(c)[i].as_py() for c in columns)

    return groupby(rows(), lambda r: r[0])


def _totals(batches):
    """A bucket's pairs, counts and which of them are their B id's largest count."""
    for bucket, rows in _by_bucket(batches, ("bucket", "run")):
        chunks = list(merged([r[1] for r in rows]))
        pairs, counts = (np.concatenate(x) for x in zip(*chunks))
        # Side-major: the pairs of a B id are neighbours.
        start = np.flatnonzero(np.diff(pairs >> 16, prepend=-1))
        most = np.maximum.reduceat(counts, start)
        best = counts == np.repeat(most, np.diff(np.append(start, len(pairs))))
        yield pa.RecordBatch.from_pylist(
            [{"bucket": bucket, "run": to_run(pairs, counts), "best": pack(best.astype(np.uint8))}], _TOTALS
        )


_ADDED = pa.schema([("slab", pa.string()), ("docs", pa.binary()), ("best", pa.binary()), ("total", pa.binary())])
#: Sums are added in two halves of the counts, each exact in a double.
_HALF = 24


def _contributions(batches):
    """What each run adds to the documents of its slab; a bucket's counts come before its runs."""
    columns = ("bucket", "slab", "run", "sizes", "docs", "times", "best")
    for _, rows in _by_bucket(batches, columns):
        pairs = None
        for _, slab, run, sizes, docs, times, best in rows:
            if slab is None:
                pairs, counts = (np.concatenate(x) for x in zip(*frames(run)))
                best_of = unpack(best)
                continue
            own = np.concatenate([p for p, _ in frames(run)])
            at = np.searchsorted(pairs, own)
            sizes = unpack(sizes)
            gaps, start = unpack(docs), np.cumsum(sizes) - sizes
            total = np.cumsum(gaps)
            doc = total - np.repeat(total[start] - gaps[start], sizes)
            n = unpack(times) + 1
            count = np.repeat(counts[at], sizes)
            low = np.bincount(doc, n * (count & (1 << _HALF) - 1)).astype(np.int64)
            high = np.bincount(doc, n * (count >> _HALF)).astype(np.int64)
            n_best = np.bincount(doc, n * np.repeat(best_of[at], sizes)).astype(np.int64)
            some = np.flatnonzero(low + high)
            yield pa.RecordBatch.from_pylist([{
                "slab": slab, "docs": pack(some), "best": pack(n_best[some]),
                "total": pack((low + (high << _HALF))[some]),
            }], _ADDED)


_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)


def _returned(batches):
    """Rows of documents with what all buckets add to them; a slab's documents come first."""
    columns = ("slab", *[n for n, _ in _LISTS], "docs", "best", "total")
    for _, rows in _by_bucket(batches, columns):
        rows = iter(rows)
        _, doc_id, n_a, n_b, n_groups, n_links, digest, *_ = next(rows)
        n_best, total = np.zeros(len(doc_id), np.int64), np.zeros(len(doc_id), np.int64)
        for row in rows:
            docs = unpack(row[-3])
            n_best[docs] += unpack(row[-2])
            total[docs] += unpack(row[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc_id, pa.int64()), *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)],
             pa.array(n_best), pa.array(total), pa.array(digest, pa.string())],
            ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
        )


def align(docs, ranks_path, model_path, slab=SLAB, part_records=PART_RECORDS, fan_in=FAN_IN):
    """How the tokens of two vocabularies meet in every row of ``docs``.

    Columns: ``doc_id``, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best`` (links whose pair is
    linked as often as any pair with the same B id), ``count_sum`` (counts of all links added up) and
    ``groups_sha256`` (of the groups as ``a1,a2|b1;a3|b2,b3``).

    Null and empty texts, and texts whose bytes either side doesn't give back, have no tokens: zeros
    and an empty digest. Rows with null or repeated ids each give a row and count each. Further columns
    are left out, whatever their names. An empty table gives no rows. All counts are whole.
    """
    runs = spill(docs, ranks_path, model_path, slab)
    counted = count_pairs(runs, fan_in)
    totals = written(
        counted.repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(_totals, "bucket int, run binary, best binary"),
        "pair-totals",
    )
    dealt = runs.where("bucket >= 0").groupBy("bucket").agg(
        F.ceil(F.sum("records") / part_records).cast("int").alias("parts")
    )
    part = F.pmod(F.xxhash64("slab"), F.col("parts")).cast("int").alias("part")
    streamed = (
        runs.where("bucket >= 0").join(dealt, "bucket")
        .select("bucket", part, "slab", "run", "sizes", "docs", "times", F.lit(None).cast("binary").alias("best"))
    )
    nothing = F.lit(None).cast("binary")
    heads = totals.join(dealt, "bucket").select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(None).cast("string").alias("slab"), "run", nothing.alias("sizes"), nothing.alias("docs"),
        nothing.alias("times"), "best",
    )
    added = (
        streamed.unionByName(heads).repartition("bucket", "part")
        .sortWithinPartitions("bucket", "part", F.col("slab").asc_nulls_first()).drop("part")
        .mapInArrow(_contributions, "slab string, docs binary, best binary, total binary")
    )
    lists = [n for n, _ in _LISTS]
    owners = runs.where("bucket < 0").select("slab", *lists)
    back = owners.unionByName(added, allowMissingColumns=True).repartition("slab").sortWithinPartitions(
        "slab", F.col("docs").isNotNull()
    )
    return back.mapInArrow(_returned, _RESULT)
