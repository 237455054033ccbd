"""Names, callables and check SQL of the registered queries."""

from __future__ import annotations

import textwrap
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that must give the same rows."""

    def wrap(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: naive_times(function(spark, sf_dir))
        if sql:
            CHECK_SQL[name] = textwrap.dedent(sql).strip()
        return function

    return wrap


def naive_times(df: DataFrame) -> DataFrame:
    """Times without a zone, as the check SQL has them."""
    new = {
        f.name: F.col(f.name).cast("timestamp_ntz")
        for f in df.schema.fields
        if isinstance(f.dataType, T.TimestampType)
    }
    return df.withColumns(new) if new else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_name(stem: str) -> str:
    """A catalog name no other run uses."""
    return f"ledgerloom_{stem}_{uuid.uuid4().hex[:12]}"


def released(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a table made for one query; its catalog entry goes, its files stay."""
    df = spark.read.table(name)
    spark.sql(f"DROP TABLE {name}")
    return df
