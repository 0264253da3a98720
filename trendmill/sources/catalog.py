"""Databases and tables of Spark's own catalog."""

from functools import reduce

from pyspark.sql import functions as F


def create_databases(spark, names):
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def create_table(spark, name, schema, partition_columns=(), properties=None):
    """Creates an empty parquet table unless it exists; returns whether it was created."""
    if spark.catalog.tableExists(name):
        return False
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.fields
    )
    statement = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
    if partition_columns:
        statement += f" PARTITIONED BY ({', '.join(partition_columns)})"
    if properties:
        pairs = ", ".join(f"'{key}' = '{value}'" for key, value in properties.items())
        statement += f" TBLPROPERTIES ({pairs})"
    spark.sql(statement)
    return True


def publish(spark, name, path):
    """Makes a written parquet table known to SQL under ``name``, with all its partitions."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet")
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def row_counts(spark, named):
    """Row count per table in one job; a missing table (None) counts as -1."""
    parts = []
    for name, df in named.items():
        if df is None:
            count = spark.range(1).select(F.lit(-1).cast("bigint").alias("row_count"))
        else:
            count = df.agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(count.select(F.lit(name).alias("table"), "row_count"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def open_tables(spark, names):
    """Catalog tables by name, None where the catalog has no such table."""
    return {name: spark.table(name) if spark.catalog.tableExists(name) else None for name in names}
