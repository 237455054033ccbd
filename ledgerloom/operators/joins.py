"""Joins against a side that is usually small."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.functions.columns import column
from ledgerloom.session import written_table

# A lookup side is broadcast only when counted to lie within both bounds.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Count the rows and the bytes in them; only partial sums move.

    Arrays, maps and structs count by their text, which is no shorter than what
    they hold. Types without one are not broadcast.
    """
    length = F.lit(0)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            length = length + F.coalesce(F.octet_length(column(f.name)), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            # Eight bytes for each mark of the text cover the numbers in it.
            length = length + F.coalesce(F.octet_length(F.to_json(F.struct(column(f.name)))), F.lit(0)) * 8
        elif isinstance(f.dataType, T.VariantType):
            return False
        else:
            length = length + F.lit(8)
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(length.cast("long")).alias("bytes")).first()
    return found["n"] <= rows and (found["bytes"] or 0) <= size


def lookup_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "left", rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join a large left side to a keyed right side.

    Within the bounds the right side is broadcast and the left side stays where
    it is. Beyond them both sides are shuffled on the key and the adaptive
    planner splits the partitions of hot keys, which it can do here because the
    right side holds each key once. It looks for a plain shuffle on both sides,
    so the right one is written first, whatever it was computed from.
    """
    if fits_broadcast(right, rows):
        return left.join(F.broadcast(right), on, how)
    return left.join(written_table(right, "lookup").hint("merge"), on, how)
