"""Treatment of missing values. NULL and NaN both count as missing."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.functions.columns import quoted
from ledgerloom.operators import statistics

logger = logging.getLogger(__name__)

STATISTICS = ("mean", "median", "mode")


def drop_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a missing value in the subset, or in any column."""
    return df.dropna(how="any", subset=[quoted(c) for c in subset] if subset else None)


def drop_incomplete_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop those of the columns that hold a missing value. Reads the data once to decide."""
    return df.drop(*statistics.columns_with_missing(df, columns or df.columns))


def _fits(value, data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StringType):
        return True
    if isinstance(data_type, T.BooleanType):
        return isinstance(value, bool)
    if isinstance(data_type, T.IntegralType):
        return isinstance(value, (int, float)) and not isinstance(value, bool) and float(value).is_integer()
    if isinstance(data_type, T.NumericType):
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    return not isinstance(value, (bool, int, float))


def fill_values(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace missing values by one constant per column."""
    types = {f.name: f.dataType for f in df.schema.fields}
    new = {}
    for name, value in values.items():
        if value is None or name not in types:
            continue
        if not _fits(value, types[name]):
            raise ValueError(f"{value!r} does not fit column {name} of type {types[name].simpleString()}")
        new[name] = F.coalesce(statistics.present(df, name), F.lit(value).cast(types[name]))
    return df.withColumns(new) if new else df


def fill_constant(df: DataFrame, value, columns: list[str] | None = None) -> DataFrame:
    """Fill with a constant; None changes nothing.

    Without a column list, the columns whose type can hold the constant are filled.
    """
    if value is None:
        logger.warning("no fill value given, nothing filled")
        return df
    if columns is None:
        columns = [f.name for f in df.schema.fields if _fits(value, f.dataType)]
    return fill_values(df, dict.fromkeys(columns, value))


def fill_statistic(df: DataFrame, statistic: str, columns: list[str] | None = None) -> DataFrame:
    """Fill with the mean, median or mode of the column itself.

    Mean and median skip columns that are not numeric. The statistic is read in
    a job of its own and enters the plan as a constant, so the fill itself is a
    plain projection.
    """
    names = [c for c in (columns or df.columns) if c in df.columns]
    if statistic != "mode":
        for skipped in [c for c in names if not statistics.is_numeric(df, c)]:
            logger.warning("column %s is not numeric, %s not filled", skipped, statistic)
        names = [c for c in names if statistics.is_numeric(df, c)]
    if not names:
        return df
    found = getattr(statistics, statistic + "s")(df, names)
    return _fill_found(df, found)


def _fill_found(df: DataFrame, found: dict[str, object]) -> DataFrame:
    """Fill with statistics. A mean or median makes a whole-number column double, whatever its value."""
    new = {}
    for name, value in found.items():
        if value is None:
            logger.warning("column %s has no value to take a statistic from", name)
            continue
        data_type = df.schema[name].dataType
        if isinstance(value, float) and isinstance(data_type, T.IntegralType):
            data_type = T.DoubleType()
        kept = statistics.present(df, name).cast(data_type)
        new[name] = F.coalesce(kept, F.lit(value).cast(data_type))
    return df.withColumns(new) if new else df


def handle_missing(
    df: DataFrame,
    strategy: str = "drop_row",
    columns: list[str] | None = None,
    fill_value=None,
    subset_for_drop: list[str] | None = None,
) -> DataFrame:
    """One strategy for a set of columns: drop_row, drop_column, fill, mean, median or mode."""
    if strategy == "drop_row":
        return drop_rows(df, subset_for_drop)
    if strategy == "drop_column":
        return drop_incomplete_columns(df, columns)
    if strategy == "fill":
        return fill_constant(df, fill_value, columns)
    if strategy in STATISTICS:
        return fill_statistic(df, strategy, columns)
    raise ValueError(f"unknown strategy {strategy!r}")


def apply_strategies(
    df: DataFrame,
    column_strategies: dict[str, str | tuple[str, object]],
    default_strategy: str | None = None,
    take: Callable[[DataFrame, list[str], list[str], list[str]], dict[str, object]] | None = None,
) -> DataFrame:
    """One strategy per column: drop_row, fill_mean, fill_median, fill_mode or fill_constant.

    ``fill_constant`` is written as a pair with its value. Columns not listed
    follow the default. All statistics are taken from the input, means and
    medians in shared scans, or by ``take``, which is given the columns of each
    kind; rows are dropped after the fills.
    """
    by_kind: dict[str, list[str]] = {}
    constants = {}
    listed = {c: s for c, s in column_strategies.items() if c in df.columns}
    if default_strategy:
        listed = {**dict.fromkeys(df.columns, default_strategy), **listed}
    for name, strategy in listed.items():
        kind = strategy if isinstance(strategy, str) else strategy[0]
        if kind == "fill_constant":
            constants[name] = None if isinstance(strategy, str) else strategy[1]
        elif kind in ("drop_row", "fill_mean", "fill_median", "fill_mode"):
            by_kind.setdefault(kind, []).append(name)
        else:
            raise ValueError(f"unknown strategy {kind!r} for column {name}")
    numeric = {c for c in df.columns if statistics.is_numeric(df, c)}
    wanted = [[c for c in by_kind.get(k, []) if c in numeric] for k in ("fill_mean", "fill_median")]
    found = (take or statistics.of_columns)(df, *wanted, by_kind.get("fill_mode", []))
    out = fill_values(_fill_found(df, found), constants)
    return drop_rows(out, by_kind["drop_row"]) if by_kind.get("drop_row") else out
