"""Token ids of a corpus in files of Re-Pair shards, in ascending order of documents.

A file is Parquet; each row is a shard: its number in the whole order (``part``, ``block``), the ids and
token counts of its documents, and ``grammar``, the bytes of :mod:`trendmill.llm.grammar`. Spark writes
the files, so a lost task leaves nothing behind; any file system of the session will do.

Texts are encoded where they are read. What is shuffled are ids of two bytes (four, if the vocabulary
needs them), range-partitioned by ``doc_id``; rows of equal ids follow their checksum and their number
in the written table, so a hot id is split over partitions as well.
"""

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from trendmill.llm.array_bpe import table_of
from trendmill.llm.grammar import Shard, compress
from trendmill.llm.shared import id_and_text, on_workers
from trendmill.llm.word_table import pieces, ragged, text_slabs
from trendmill.session import written

#: Bytes of text encoded at a time, tokens of a partition (about), tokens after which a shard ends.
SLAB, PART_TOKENS, SHARD_TOKENS = 8_000_000, 8_000_000, 2_000_000

_ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32()), ("ids", pa.binary())])
_SHARDS = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
    ("sizes", pa.list_(pa.int64())), ("grammar", pa.binary()),
])
_SHARDS_DDL = "part int, block int, doc_ids array<long>, sizes array<long>, grammar binary"


def encode(docs, path, end_id=None, slab=SLAB):
    """``doc_id``, ``n_tokens``, ``width`` and ``ids`` (little-endian numbers of ``width`` bytes) of every row.

    Null and empty texts have no ids but ``end_id``, which closes every row if given.
    """
    on_workers(docs.sparkSession)

    def run(batches):
        table = table_of(path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for start, end in text_slabs(texts, slab):
                found, counts = pieces(texts.slice(start, end - start))
                rows = table.rows_of(found)
                places, sizes = ragged(table.offsets, rows)
                flat = table.flat[places] if len(places) else np.zeros(0, np.uint16)
                ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
                if end_id is not None:
                    kind = np.promote_types(flat.dtype, np.min_scalar_type(end_id))
                    flat = np.insert(flat.astype(kind), ends[1:], end_id)
                    ends = ends + np.arange(len(ends))
                width = flat.dtype.itemsize
                edges = pa.py_buffer((ends * width).astype(np.int32))
                data = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, edges, pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, end - start), pa.array(np.diff(ends)),
                     pa.array(np.full(len(ends) - 1, width, np.int32)), data], schema=_ENCODED,
                )
                pa.default_memory_pool().release_unused()

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_tokens long, width int, ids binary")


def _shards(batches, most):
    """Shards of the rows of a partition, which come in the order of documents."""
    part, block = TaskContext.get().partitionId(), 0
    held, held_ids, held_sizes, total = [], [], [], 0

    def close():
        doc_ids = list(chain.from_iterable(held_ids))
        sizes = np.concatenate(held_sizes)
        row = {"part": part, "block": block, "doc_ids": doc_ids, "sizes": sizes.tolist(),
               "grammar": compress(np.concatenate(held))}
        return pa.RecordBatch.from_pylist([row], _SHARDS)

    for batch in batches:
        sizes = batch.column(1).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            before = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + most - total, "right")))
            some = batch.slice(at, upto - at)
            for width, data in zip(some.column(2).to_pylist(), some.column(3).to_pylist()):
                held.append(np.frombuffer(data, f"<u{width}"))
            held_ids.append(some.column(0).to_pylist())
            held_sizes.append(sizes[at:upto])
            total += int(ends[upto - 1] - before)
            at = upto
            if total >= most or at < len(sizes):
                yield close()
                held, held_ids, held_sizes, total, block = [], [], [], 0, block + 1
    if held:
        yield close()


def write_token_files(docs, path, vocabulary, end_id=None, part_tokens=PART_TOKENS, shard_tokens=SHARD_TOKENS):
    """Writes the ids of all rows of ``docs`` to files below ``path``, in ascending order of ``doc_id``.

    Null ids come first; rows with equal ids follow one another. Null and empty texts have ``end_id``
    alone, or nothing. Further columns are left out, whatever their names. An empty table gives
    files without shards.
    """
    encoded = encode(docs, vocabulary, end_id)
    encoded = written(
        encoded.withColumns({"crc": F.crc32("ids"), "row": F.monotonically_increasing_id()}), "encoded"
    )
    total = encoded.agg(F.sum("n_tokens")).first()[0] or 0
    order = ["doc_id", "crc", "row"]
    ordered = (
        encoded.repartitionByRange(max(1, -(-total // part_tokens)), *order).sortWithinPartitions(*order)
        .select("doc_id", "n_tokens", "width", "ids")
    )
    ordered.mapInArrow(lambda batches: _shards(batches, shard_tokens), _SHARDS_DDL).write.option(
        "compression", "zstd"
    ).parquet(path)


def shard_starts(files):
    """``part``, ``block``, ``first``: ids of all shards before each, from a row a shard and one a part."""
    tokens = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("tokens")
    blocks = files.select("part", "block", tokens)
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("tokens").alias("tokens")).select(
        "part", F.coalesce(F.sum("tokens").over(before.orderBy("part")), F.lit(0)).alias("base")
    )
    inside = F.coalesce(F.sum("tokens").over(before.partitionBy("part").orderBy("block")), F.lit(0))
    return blocks.select("part", "block", inside.alias("inside")).join(parts, "part").select(
        "part", "block", (F.col("base") + F.col("inside")).alias("first")
    )


def read_token_files(spark, path, ids=False):
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids_crc32`` from files below ``path``.

    The checksum is that of the ids as little-endian numbers of four bytes; with ``ids`` the ids
    are returned as well. Every shard is expanded from its grammar.
    """
    on_workers(spark)
    files = spark.read.schema(_SHARDS_DDL).parquet(path)
    schema = "part int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    schema += ", ids array<long>" if ids else ""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(i)[k] for i, n in enumerate(_SHARDS.names)}
                sizes = np.array(row["sizes"].as_py(), np.int64)
                flat = np.ascontiguousarray(Shard(row["grammar"].as_py()).all(), "<u4")
                edges = np.concatenate([[0], np.cumsum(sizes)])
                data = memoryview(flat)
                sums = [zlib.crc32(data[s:e]) for s, e in zip(edges[:-1].tolist(), edges[1:].tolist())]
                columns = [
                    pa.array(np.full(len(sizes), row["part"].as_py(), np.int32)),
                    pa.array(np.full(len(sizes), row["block"].as_py(), np.int32)),
                    row["doc_ids"].values, pa.array(edges[:-1]), pa.array(sizes), pa.array(sums, pa.int64()),
                ]
                names = ["part", "block", "doc_id", "inside", "n_tokens", "ids_crc32"]
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    found = files.mapInArrow(run, schema).join(shard_starts(files), ["part", "block"])
    return found.select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32",
        *(["ids"] if ids else []),
    )


def read_range(spark, path, start, stop):
    """``at``, ``id``: the ids at places ``start`` to before ``stop`` of the whole order.

    Only the shards that hold them are read, and of these only the symbols that stand for them.
    """
    on_workers(spark)
    files = spark.read.schema(_SHARDS_DDL).parquet(path)
    n = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    near = files.join(shard_starts(files), ["part", "block"]).where(
        (F.col("first") < stop) & (F.col("first") + n > start)
    ).select("first", "grammar")

    def run(batches):
        for batch in batches:
            for first, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                low = max(0, start - first)
                found = Shard(data).span(low, stop - first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first + low + np.arange(len(found))), pa.array(found.astype(np.int64))], ["at", "id"]
                )

    return near.mapInArrow(run, "at long, id long")
