"""Catalog tables, SQL text and JDBC relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def query(
    spark: SparkSession,
    sql: str,
    params: dict | list | tuple | None = None,
    views: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Run SQL text with bound parameters, ``:name`` or ``?``, over tables and the given frames.

    Frames are named in the text as ``{name}``. A query that fails raises.
    """
    args = list(params) if isinstance(params, tuple) else params
    return spark.sql(sql, args=args, **(views or {}))


def read_table(spark: SparkSession, table: str, columns: list[str] | None = None) -> DataFrame:
    """A catalog table, or some of its columns."""
    df = spark.read.table(table)
    return df.select(*columns) if columns else df


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    fetch_size: int = 10_000,
    partition: tuple[str, object, object, int] | None = None,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Reader options. ``partition`` is ``(column, lower, upper, count)`` and splits the read."""
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    options = {"url": url, "fetchsize": str(fetch_size), **(properties or {})}
    if partition:
        column, lower, upper, count = partition
        # A partitioned read takes a table only, so a query enters as a subselect.
        options["dbtable"] = table or f"({query}) q"
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(count),
        }
    elif query:
        options["query"] = query
    else:
        options["dbtable"] = table
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    query: str | None = None,
    fetch_size: int = 10_000,
    partition_column: str | None = None,
    num_partitions: int = 1,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A table or query of a database; filters and column choices on the result push down to it.

    With a partition column the read is split by its range, which one small
    query finds first.
    """
    def load(options):
        return spark.read.format("jdbc").options(**options).load()

    whole = load(jdbc_options(url, table, query, fetch_size, None, properties))
    if not partition_column or num_partitions < 2:
        return whole
    low, high = whole.agg(F.min(partition_column), F.max(partition_column)).first()
    if low is None:
        return whole
    split = (partition_column, low, high, num_partitions)
    return load(jdbc_options(url, table, query, fetch_size, split, properties))
