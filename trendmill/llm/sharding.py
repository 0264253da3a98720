"""Shards in the order of a Hilbert curve over several metadata columns.

Every metadata column is quantised to ``2 ** bits`` steps, so a row falls into one cell of a cube. A
Hilbert curve visits the cells such that neighbours on the curve are neighbours in the cube, and a run
of the curve covers short ranges of every column. Rows are numbered along the curve and cut into
runs of equal row counts (law ``rows``). Within a cell the order is that of the texts' checksums and of
``doc_id``, however many rows the cell has: all rows are range-partitioned in one total order, and a
row's number is its place in its partition plus the rows of the partitions before it. A reader that
filters on any of the columns then skips most shards and files by their min/max figures.

Only DataFrame functions are used. The curve has ``2 ** (bits * columns)`` cells, 32,768 as a rule,
whatever the size of the table, which bounds the table that is broadcast; the other one has a row a
partition.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Window
from pyspark.sql import functions as F

from trendmill.session import written

SHARDS = 24
BITS = 5
#: Rows that one task lays out on average, at most.
ROWS_PER_GROUP = 100_000
# monotonically_increasing_id keeps the partition number above this bit.
_ROW_BITS = 33


@dataclass(frozen=True)
class Dimension:
    """A metadata column: ``range`` is cut at its quantiles, ``category`` goes by its hash."""

    column: str
    kind: str = "range"


DIMENSIONS = (Dimension("size"), Dimension("source", "category"), Dimension("doc_id"))


def _cuts(df, dims, bits):
    """Quantiles of the ``range`` columns, one small row."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    ranges = [d.column for d in dims if d.kind == "range"]
    if not ranges:
        return {}
    row = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), shares).alias(c) for c in ranges]
    ).first()
    return {c: sorted(set(row[c] or [])) for c in ranges}


def _step(dim, cuts, bits):
    if dim.kind == "category":
        return F.pmod(F.xxhash64(F.col(dim.column).cast("string")), F.lit(2**bits)).cast("int")
    value = F.col(dim.column).cast("double")
    step = F.lit(0)
    for cut in cuts[dim.column]:
        step = step + F.coalesce((value > F.lit(cut)).cast("int"), F.lit(0))
    return step


def hilbert_curve(spark, n, bits):
    """``cell`` and its place ``along`` the curve, for all ``2 ** (n * bits)`` cells.

    The coordinates of a cell are the ``bits``-bit digits of its number, first column highest. They
    are turned into the curve's index by undoing the excess rotations from the highest bit down,
    then taking the Gray code.
    """
    axes = F.array(*[
        F.shiftright("cell", bits * (n - 1 - i)).bitwiseAND(2**bits - 1) for i in range(n)
    ])
    steps = F.array(*[
        F.struct(F.lit(2**b).cast("long").alias("bit"), F.lit(i).alias("axis"))
        for b in range(bits - 1, 0, -1) for i in range(n)
    ])

    def rotate(x, step):
        bit, axis = step["bit"], step["axis"]
        below = bit - 1
        swap = x[0].bitwiseXOR(F.get(x, axis)).bitwiseAND(below)
        return F.when(
            F.get(x, axis).bitwiseAND(bit) != 0,
            F.transform(x, lambda v, i: F.when(i == 0, v.bitwiseXOR(below)).otherwise(v)),
        ).otherwise(
            F.transform(
                x,
                lambda v, i: F.when((i == 0) != (i == axis), v.bitwiseXOR(swap)).otherwise(v),
            )
        )

    gray, turn = [F.col("x")[0]], F.lit(0).cast("long")
    for i in range(1, n):
        gray.append(gray[-1].bitwiseXOR(F.col("x")[i]))
    for b in range(bits - 1, 0, -1):
        turn = turn.bitwiseXOR(
            F.when(F.col("last").bitwiseAND(2**b) != 0, F.lit(2**b - 1)).otherwise(0).cast("long")
        )
    along = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            along = along * 2 + F.shiftright(F.col("gray")[i].bitwiseXOR(F.col("turn")), b).bitwiseAND(1)
    return (
        spark.range(2 ** (n * bits)).withColumnRenamed("id", "cell")
        .withColumn("x", F.aggregate(steps, axes, rotate))
        .withColumn("gray", F.array(*gray))
        .withColumn("last", F.col("gray")[n - 1])
        .withColumn("turn", turn)
        .select("cell", along.alias("along"))
    )


def hilbert_shards(docs, shards=SHARDS, dims=DIMENSIONS, bits=BITS, carry=(), group=ROWS_PER_GROUP):
    """Every row of ``docs`` with its ``shard`` (from 0) and ``slot`` in the shard (from 0).

    Columns: ``doc_id``, ``size`` (UTF-8 bytes of the text plus 8), ``text_crc32``, ``along`` (place of
    its cell on the curve), ``shard``, ``slot``, and the columns named in ``carry``. Shards differ by at
    most one row; with fewer rows than shards the rest stay empty. Within a cell rows follow
    ``text_crc32`` and ``doc_id``, so equal texts with equal metadata are neighbours.

    Null text: size 8, crc of the empty text. Null metadata: step 0 of a range, a category of its
    own. Repeated rows get a slot each. Empty table: no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *[F.col(d.column) for d in dims if d.column not in ("doc_id", "size")],
        *[F.col(c).alias(f"_carry_{c}") for c in carry],
    )
    # Written once: numbers rows for good and keeps the later steps away from the texts.
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "shard-rows")
    cuts = _cuts(rows, dims, bits)
    cell = F.lit(0).cast("long")
    for dim in dims:
        cell = cell * 2**bits + _step(dim, cuts, bits)
    curve = hilbert_curve(spark, len(dims), bits)
    rows = rows.withColumn("cell", cell).join(F.broadcast(curve), "cell").drop("cell")

    # Laid out in the order of the shards over all tasks, and written as both uses must see one layout.
    order = ["along", "text_crc32", "doc_id", "_row"]
    tasks = math.ceil(rows.count() / group)
    few = tasks <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid_out = written(
        rows.repartitionByRange(*([] if few else [tasks]), *order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", _ROW_BITS)),
        "shard-layout",
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        laid_out.groupBy("_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first"))
        .withColumn("total", F.sum("_rows").over(Window.partitionBy()))
        .select("_part", "_before", "total")
    )
    numbered = laid_out.join(F.broadcast(parts), "_part").withColumn(
        "_rank", F.col("_place") + F.col("_before")
    )
    shard = F.expr(f"_rank * {shards} div total")
    return (
        numbered.withColumn("_shard", shard)
        .withColumn("slot", F.expr(f"_rank - (_shard * total + {shards - 1}) div {shards}"))
        .select(
            "doc_id", "size", "text_crc32", "along",
            F.col("_shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
            *[F.col(f"_carry_{c}").alias(c) for c in carry],
        )
    )


def write_shards(docs, path, rows_per_file=1_000_000, **options):
    """Writes ``docs`` below ``path``, a folder for each shard and files that are runs of the curve."""
    carry = [c for c in docs.columns if c not in ("doc_id", "size", "text_crc32", "along", "shard", "slot")]
    placed = hilbert_shards(docs, carry=carry, **options)
    run = F.expr(f"slot div {rows_per_file}")
    (
        placed.withColumn("_run", run)
        .repartition("shard", "_run")
        .sortWithinPartitions("shard", "slot")
        .drop("_run")
        .write.partitionBy("shard").parquet(path)
    )
