"""What the raw payload of a bronze row holds beyond the columns of its feed.

The payload is read as a variant, so no schema is needed: a census lists all paths and types that
occur, and single fields can be read from rows that landed long before anyone asked for them.
"""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

#: Type of a row whose payload is no JSON, in a census.
BROKEN = "BROKEN"


def as_variant(column):
    """A text column as a variant; NULL where it is no JSON."""
    return F.try_parse_json(column)


def kind(value):
    """Name of a variant's type without its parts, such as BIGINT, DECIMAL, STRING, VOID, OBJECT, ARRAY."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _step(key):
    """How a key is written in a path: plain names after a dot, others in quotes."""
    quoted = F.concat(F.lit("['"), F.replace(F.replace(key, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("']"))
    return F.when(key.rlike("^[A-Za-z_][A-Za-z0-9_]*$"), F.concat(F.lit("."), key)).otherwise(quoted)


def census(rows, column="_raw_json", levels=4):
    """``path``, ``type`` and ``count`` of all values in the payloads, down to ``levels`` below the root.

    Items of an array share the path ``…[]``. An object or array at the last level is counted as such,
    without what is inside. Payloads that are no JSON, or NULL, count as type ``BROKEN`` at the root. A path with
    values of several types has a row each. One scan; counts are added up before they are shuffled.

    Each level is exploded into a row per value inside, so a row in the end stands for a value with nothing below
    it. Rows are counted by keys and types; paths are only put together for the kinds of rows that there are.
    A value with others inside is counted with the first of them.
    """
    spark = rows.sparkSession
    found, held = rows.select(as_variant(column).alias("_v0")), []
    for level in range(levels):
        inside = spark.tvf.variant_explode_outer(F.col(f"_v{level}").outer())
        # Types of objects and arrays are told by what is inside; others have short ones.
        itself = F.when(F.col("key").isNotNull(), "OBJECT").when(F.col("pos").isNotNull(), "ARRAY")
        found = found.lateralJoin(inside).select(
            *held,
            itself.otherwise(F.schema_of_variant(f"_v{level}")).alias(f"_t{level}"),
            F.col("key").alias(f"_k{level + 1}"), F.col("pos").isNotNull().alias(f"_in{level + 1}"),
            (F.coalesce("pos", F.lit(0)) == 0).alias(f"_first{level + 1}"), F.col("value").alias(f"_v{level + 1}"),
        )
        held = found.columns[:-1]
    last = kind(F.col(f"_v{levels}")).alias(f"_t{levels}")
    found = found.select(*held, last).groupBy(*held, f"_t{levels}").agg(F.count(F.lit(1)).alias("_rows"))

    path, nodes = F.lit("$"), []
    for level in range(levels + 1):
        there = F.lit(True)
        if level:
            key = F.col(f"_k{level}")
            path = F.concat(path, F.when(key.isNull(), "[]").otherwise(_step(key)))
            there = F.col(f"_in{level}")
        for below in range(level + 1, levels + 1):
            there = there & F.col(f"_first{below}")
        # Only a payload that could not be read has no type.
        type_ = F.coalesce(F.regexp_extract(f"_t{level}", "^[A-Z]+", 0), F.lit(BROKEN))
        nodes.append(F.when(there, F.struct(path.alias("path"), type_.alias("type"))))
    return (
        found.select(F.explode(F.array_compact(F.array(*nodes))).alias("node"), "_rows")
        .groupBy("node.path", "node.type").agg(F.sum("_rows").alias("count"))
    )


def schema_paths(schema, path="$"):
    """Paths that a feed's schema reads, written as in :func:`census`."""
    if isinstance(schema, StructType):
        inner = [schema_paths(f.dataType, f"{path}.{f.name}") for f in schema.fields]
        return reduce(lambda a, b: a | b, inner, {path})
    if isinstance(schema, ArrayType):
        return {path} | schema_paths(schema.elementType, f"{path}[]")
    return {path}


def left_out(found, schema):
    """Rows of a census whose paths the schema doesn't read."""
    return found.where(~F.col("path").isin(sorted(schema_paths(schema))))


def field(path, kind="string", column="_raw_json"):
    """The value at a path such as ``$.a.b[0]`` as ``kind``; NULL if it isn't there or can't be one."""
    return F.try_variant_get(as_variant(column), path, kind)
