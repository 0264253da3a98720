from pyspark.sql.types import StructType

from trendmill.sources import payload

ODD = [
    '{"a":1,"b":{"c":[1,null,{"d":"x"}],"e f":1.5}}', '{"a":"t","b":null}', "[1,2]", "no{", None, "{}", "3",
    '{"it\'s":true}',
]


def census(spark, rows, **options):
    found = payload.census(spark.createDataFrame([(r,) for r in rows], "_raw_json string"), **options)
    return {(r["path"], r["type"]): r["count"] for r in found.collect()}


def test_census_of_odd_payloads(spark):
    assert census(spark, ODD) == {
        ("$", "OBJECT"): 4, ("$", "ARRAY"): 1, ("$", "BIGINT"): 1, ("$", "BROKEN"): 2,
        ("$.a", "BIGINT"): 1, ("$.a", "STRING"): 1, ("$.b", "OBJECT"): 1, ("$.b", "VOID"): 1,
        ("$.b.c", "ARRAY"): 1, ("$.b.c[]", "BIGINT"): 1, ("$.b.c[]", "VOID"): 1, ("$.b.c[]", "OBJECT"): 1,
        ("$.b.c[].d", "STRING"): 1, ("$.b['e f']", "DECIMAL"): 1, ("$[]", "BIGINT"): 2,
        ("$['it\\'s']", "BOOLEAN"): 1,
    }


def test_what_lies_deeper_is_counted_at_the_last_level(spark):
    assert census(spark, ODD[:1], levels=1) == {
        ("$", "OBJECT"): 1, ("$.a", "BIGINT"): 1, ("$.b", "OBJECT"): 1,
    }
    assert census(spark, []) == {}


def test_paths_that_a_schema_leaves_out(spark):
    schema = StructType.fromDDL("a long, b struct<c: array<long>>")
    assert payload.schema_paths(schema) == {"$", "$.a", "$.b", "$.b.c", "$.b.c[]"}
    rows = spark.createDataFrame([(ODD[0],)], "_raw_json string")
    left = payload.left_out(payload.census(rows), schema)
    assert {r["path"] for r in left.collect()} == {"$.b.c[].d", "$.b['e f']"}


def test_fields_by_path(spark):
    rows = spark.createDataFrame([(r,) for r in ODD], "_raw_json string").select(
        payload.field("$.a", "bigint"), payload.field("$.b.c[2].d"), payload.field("$.b['e f']", "double")
    )
    found = [tuple(r) for r in rows.collect()]
    assert found[0] == (1, "x", 1.5)
    assert found[1:] == [(None, None, None)] * (len(ODD) - 1)


def test_values_are_exploded_and_not_gone_through_in_lambdas(spark):
    rows = spark.range(500).selectExpr(
        """concat('{"a":[[],[1,', id, ',null],{}],"x y":{"b":"', id, '"}}') AS _raw_json"""
    )
    found = payload.census(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert {(r["path"], r["type"]): r["count"] for r in found.collect()} == {
        ("$", "OBJECT"): 500, ("$.a", "ARRAY"): 500, ("$.a[]", "ARRAY"): 1000, ("$.a[]", "OBJECT"): 500,
        ("$.a[][]", "BIGINT"): 1000, ("$.a[][]", "VOID"): 500, ("$['x y']", "OBJECT"): 500,
        ("$['x y'].b", "STRING"): 500,
    }
    # Nothing is done value by value in lambdas; those above the counts only see kinds of rows.
    assert "lambdafunction" not in plan[plan.index("variant_explode"):]
