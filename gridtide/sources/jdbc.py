"""JDBC source and sink.

Connection settings always come from the caller; nothing is stored here.
Reads can be split into ``num_partitions`` range scans on a numeric, date or
timestamp column (or explicit ``predicates``); filters and column pruning
reach the database through Spark's JDBC pushdown.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    num_partitions: int | None = None,
    predicates: Sequence[str] | None = None,
    fetchsize: int | None = None,
) -> DataFrame:
    """Read a table (or a parenthesised query with an alias)."""
    props = dict(properties or {})
    if fetchsize:
        props["fetchsize"] = str(fetchsize)
    if predicates:
        return spark.read.jdbc(url=url, table=table, predicates=list(predicates), properties=props)
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned reads need lower_bound, upper_bound and num_partitions")
        return spark.read.jdbc(
            url=url,
            table=table,
            column=partition_column,
            lowerBound=lower_bound,
            upperBound=upper_bound,
            numPartitions=num_partitions,
            properties=props,
        )
    return spark.read.jdbc(url=url, table=table, properties=props)


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    mode: str = "overwrite",
    batchsize: int | None = None,
    truncate: bool | None = None,
    num_partitions: int | None = None,
) -> None:
    """S3: write a DataFrame to a table; ``overwrite`` by default.

    ``num_partitions`` caps the number of concurrent connections (Spark
    coalesces to it before writing).
    """
    props = dict(properties or {})
    if batchsize:
        props["batchsize"] = str(batchsize)
    if truncate is not None:
        props["truncate"] = "true" if truncate else "false"
    if num_partitions:
        props["numPartitions"] = str(num_partitions)
    df.write.jdbc(url=url, table=table, mode=mode, properties=props)
