"""Helpers that several operators use."""

from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Folder that holds the package ``trendmill``.
_ROOT = str(Path(__file__).resolve().parents[2])

#: Characters of text that a worker turns into Python objects at a time.
SLAB_CHARS = 4_000_000


def on_workers(spark):
    """Lets Python workers import this package from the folder the driver uses."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([_ROOT, *paths])
    return spark


def bound_batches(spark, most):
    """Has the session send at most ``most`` bytes of rows at a time to Python workers, or fewer if it does so.

    The setting is read when a query runs, so it stays; results don't depend on it.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    sizes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils
    if not 0 < sizes.byteStringAsBytes(spark.conf.get(name)) <= most:
        spark.conf.set(name, str(most))


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_and_text(docs):
    """``doc_id`` (long) and ``text`` (string, null as empty) of a table with any other columns."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def _weights(values):
    """Bytes of each value of an Arrow column of strings, lists of longs, or structs with a ``text``."""
    if pa.types.is_struct(values.type):
        return _weights(pc.struct_field(values, "text"))
    if pa.types.is_list(values.type):
        return pc.multiply(pc.list_value_length(values), 8)
    return pc.binary_length(values)


def slabs(sizes, most=SLAB_CHARS):
    """``(start, end)`` runs of values that hold about ``most`` bytes or one value."""
    start, held = 0, 0
    sizes = sizes.to_pylist()
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def _rows(values, rows):
    """Rows of an Arrow column, given as a slice or as places."""
    if isinstance(rows, slice):
        return values.slice(rows.start, rows.stop - rows.start)
    return values.take(rows)


def map_column(df, name, make, schema, most=SLAB_CHARS, pick=None):
    """Replaces the column ``name`` by columns made from its values in batches.

    ``make()`` is called once in a task and gives ``function(values)``, which takes a list and returns a
    dict of columns (lists or Arrow arrays) as long as the list. The result has the other columns of
    ``df``, followed by ``schema`` (a DDL string). ``most`` bytes of values are handed over at a time;
    ``pick(batch)``, if given, returns the places of the rows of an Arrow batch to go on with.
    """
    on_workers(df.sparkSession)
    kept = [n for n in df.columns if n != name]
    full = StructType([df.schema[n] for n in kept] + StructType.fromDDL(schema).fields)
    arrow = to_arrow_schema(full)

    def run(batches):
        function = make()
        for batch in batches:
            at = None if pick is None else pa.array(pick(batch), pa.int64())
            values = batch.column(batch.schema.get_field_index(name))
            sizes = _weights(values).fill_null(0)
            for start, end in slabs(sizes if at is None else sizes.take(at), most):
                rows = slice(start, end) if at is None else at.slice(start, end - start)
                made = function(_rows(values, rows).to_pylist())
                columns = [_rows(batch.column(batch.schema.get_field_index(n)), rows) for n in kept]
                columns += [
                    v if isinstance(v := made[f.name], pa.Array) else pa.array(v, type=f.type)
                    for f in list(arrow)[len(kept):]
                ]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow
                )
                # What a slab took is given back before the next one, as workers live long.
                del made, columns
                pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, full)


def map_texts(docs, make, schema, **options):
    """:func:`map_column` of the column ``text``."""
    return map_column(docs, "text", make, schema, **options)


def crc_part(column, parts):
    """crc32 of the id written as text, modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(parts))
