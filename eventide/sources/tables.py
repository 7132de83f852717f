"""Relational tables (orders, saga_instance, rules) as DataFrames.

Parquet (or any file format) on shared storage, or a JDBC source partitioned
on a numeric column so a large table is read by many tasks in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    jdbc_url: str | None = None,
    table: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    num_partitions: int | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Load a table; filters and projections applied later are pushed into the
    file scan or the JDBC query.  A JDBC read needs a numeric column, its bounds
    and a number of partitions: without them it would be one task."""
    if jdbc_url:
        if not (partition_column and bounds and num_partitions):
            raise ValueError("a JDBC read needs partition_column, bounds and num_partitions")
        return spark.read.jdbc(jdbc_url, table, column=partition_column, lowerBound=bounds[0],
                               upperBound=bounds[1], numPartitions=num_partitions,
                               properties=properties or {})
    return spark.read.format(fmt).load(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite",
                fmt: str = "parquet") -> None:
    """Write a snapshot (e.g. the result of ``operators.tables.upsert_table``)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
