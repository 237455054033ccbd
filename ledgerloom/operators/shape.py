"""Selecting, renaming and fitting rows to a declared schema."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import parsing
from ledgerloom.functions.columns import column
from ledgerloom.operators.convert import lost_counts

logger = logging.getLogger(__name__)


def select_and_rename(df: DataFrame, column_map: dict[str, str]) -> DataFrame:
    """Keep the mapped columns in map order; names the input lacks are skipped."""
    absent = [name for name in column_map if name not in df.columns]
    if absent:
        logger.warning("columns to rename not found, skipped: %s", absent)
    return df.select(*[column(k).alias(v) for k, v in column_map.items() if k not in absent])


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop the named columns, ignoring those the input lacks."""
    return df.drop(*names)


def rename_columns(df: DataFrame, rename_map: dict[str, str]) -> DataFrame:
    """Rename in place, ignoring names the input lacks."""
    return df.withColumnsRenamed(rename_map)


def clean_name(name: str, case: str = "snake") -> str:
    """Trim; blanks, dashes and dots to underscores; other marks out; single underscores inside."""
    joined = "".join("_" if ch in " -." else ch for ch in str(name).strip())
    kept = "".join(ch for ch in joined if ch.isalnum() or ch == "_")
    tidy = "_".join(part for part in kept.split("_") if part)
    if case == "upper":
        return tidy.upper()
    return tidy.lower() if case in ("snake", "lower") else tidy


def clean_column_names(df: DataFrame, case: str = "snake") -> DataFrame:
    """Clean every column name; a number is added where two names would collide."""
    taken: set[str] = set()
    names = []
    for raw in df.columns:
        base = name = clean_name(raw, case)
        extra = 1
        while name.lower() in taken:
            extra += 1
            name = f"{base}_{extra}"
        taken.add(name.lower())
        names.append(name)
    return df.toDF(*names)


REQUIRED_KEYS = ("target_name", "source_column", "dtype")


def check_target_schema(target_schema) -> None:
    """A definition is a list of dicts, each with a target name, a source column and a dtype."""
    if not isinstance(target_schema, list) or not all(isinstance(d, dict) for d in target_schema):
        raise ValueError("the target schema must be a list of dicts")
    for position, definition in enumerate(target_schema):
        lacking = [key for key in REQUIRED_KEYS if key not in definition]
        if lacking:
            raise ValueError(f"target schema item {position} lacks {lacking}: {definition}")


@dataclass(frozen=True)
class Conformed:
    """Rows in the target schema, and the required columns the input did not have."""

    df: DataFrame
    missing_required: list[str]
    missing_optional: list[str]


def conform(df: DataFrame, target_schema: list[dict], on_error: str = "null") -> Conformed:
    """Select, rename, cast and order the columns of a target schema; drop all others.

    A source column the input lacks becomes a typed column of nulls.
    ``on_error`` says what happens to values that do not fit the type: ``null``
    them, ``raise`` at run time, or ``keep`` the whole source column unchanged,
    which needs one pass over the data to know.
    """
    check_target_schema(target_schema)
    types = {f.name: f.dataType for f in df.schema.fields}
    present = [d for d in target_schema if d["source_column"] in types]
    converted = {}
    for d in present:
        source = d["source_column"]
        converted[d["target_name"]] = parsing.convert(
            column(source), types[source], parsing.spark_type(d["dtype"])
        )
    lost = {}
    if on_error == "keep":
        lost = lost_counts(
            df, {d["target_name"]: (column(d["source_column"]), converted[d["target_name"]]) for d in present}
        )
    out, required, optional = [], [], []
    for d in target_schema:
        target, source, dtype = d["target_name"], d["source_column"], d["dtype"]
        if source not in types:
            (required if d.get("required") else optional).append(target)
            value = F.lit(None).cast(parsing.spark_type(dtype))
        elif lost.get(target):
            value = column(source)
        elif on_error == "raise":
            value = parsing.raise_where_lost(converted[target], column(source), str(dtype))
        else:
            value = converted[target]
        out.append(value.alias(target))
    if required:
        logger.error("required source columns not found for: %s", required)
    if optional:
        logger.warning("optional source columns not found for: %s", optional)
    return Conformed(df.select(*out), required, optional)
