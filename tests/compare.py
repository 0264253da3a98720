"""Runs registered queries next to their oracles and compares the results."""

import datetime as dt
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if hasattr(value, "tolist"):
        return plain(value.tolist())
    return value


def key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def connect(folder):
    import duckdb

    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def differences(frame, connection, sql):
    """Empty when query and oracle agree, else a short text."""
    names = sorted(frame.columns)
    mine = sorted((tuple(plain(r[n]) for n in names) for r in frame.collect()), key=key)
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return f"columns {names} != {sorted(columns)}"
    order = [columns.index(n) for n in names]
    theirs = sorted((tuple(plain(r[i]) for i in order) for r in result.fetchall()), key=key)
    types = dict(zip(columns, (str(d[1]) for d in result.description)))
    wrong = [n for n in names if not same_type(dict(frame.dtypes)[n], types[n])]
    if wrong:
        return f"types {[(n, dict(frame.dtypes)[n], types[n]) for n in wrong]}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        cells = [(n, str(x)[:80], str(y)[:80]) for n, x, y in zip(names, *bad[0]) if x != y]
        return f"{len(bad)} of {len(mine)} rows differ, first {cells}"
    return "" if mine else "no rows"


_SAME = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
         "timestamp": "TIMESTAMP", "array<string>": "VARCHAR[]"}


def same_type(spark_type, duck_type):
    return duck_type in (_SAME.get(spark_type), "NULL", '"NULL"')


def main(folder, names):
    import __spark_entry__
    from tests.conftest import local_session

    spark = local_session()
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    connection = connect(folder)
    failed = []
    for name in names or queries:
        start = time.time()
        try:
            if name in oracles:
                problem = differences(queries[name](spark, folder), connection, oracles[name])
            else:
                problem = "" if queries[name](spark, folder).collect() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - start:.1f}s {problem}",
              flush=True)
        failed += [name] if problem else []
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
