"""Removal of duplicate rows. Missing keys count as equal to each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ledgerloom.functions.columns import column
from ledgerloom.operators.joins import fits_broadcast
from ledgerloom.operators.statistics import present
from ledgerloom.session import written_table


def drop_duplicates(
    df: DataFrame,
    subset: list[str] | None = None,
    keep: str | bool = "first",
    order_by: list[str] | None = None,
) -> DataFrame:
    """Keep the first row, the last row or (``keep=False``) no row of each group of equal keys.

    Rows carry no order of their own: ``order_by`` says which is first, and the
    remaining columns break ties, so the result never depends on how the data
    is spread. Without a subset whole rows are compared.

    Each form cuts a large group down inside the map tasks, before the shuffle:
    the rank filter by a partial limit, the others by partial aggregation.
    """
    if keep not in ("first", "last", False):
        raise ValueError("keep must be 'first', 'last' or False")
    keys = subset or df.columns
    if keep is False:
        return _only_unique(df, keys)
    if subset is None:
        return _by_keys(df, keys)
    order = list(order_by or [])
    order += [
        f.name
        for f in df.schema.fields
        if f.name not in keys and f.name not in order and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    grouping = [present(df, k) for k in keys]
    if not order:
        return _by_keys(df, keys)
    ranked = [column(c).asc() if keep == "first" else column(c).desc() for c in order]
    window = Window.partitionBy(*grouping).orderBy(*ranked)
    place = "__place"
    return df.withColumn(place, F.row_number().over(window)).where(F.col(place) == 1).drop(place)


def _by_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each group of equal keys, whichever; NaN and NULL are equal."""
    floats = [k for k in keys if isinstance(df.schema[k].dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df.dropDuplicates(keys)
    same = {f"__p{i}": present(df, c) for i, c in enumerate(floats)}
    kept = [*same, *[k for k in keys if k not in floats]]
    return df.withColumns(same).dropDuplicates(kept).select(*[column(c) for c in df.columns])


def _only_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs once.

    Keys are counted alone, in the map tasks first; those that repeat are written
    and then left out by a lookup. While they are few enough to broadcast, rows
    are not shuffled.
    """
    named = [f"__k{i}" for i in range(len(keys))]
    counted = df.select(*[present(df, k).alias(n) for n, k in zip(named, keys)]).groupBy(*named)
    repeated = written_table(counted.agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n"), "repeated")
    test = F.lit(True)
    for name, key in zip(named, keys):
        test = test & present(df, key).eqNullSafe(F.col(name))
    side = F.broadcast(repeated) if fits_broadcast(repeated) else repeated.hint("merge")
    return df.join(side, test, "left_anti")
