"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.session import written_table


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node with a link: the smallest node it can reach, itself included.

    ``links`` has two long columns ``a`` and ``b``. Every round hangs each node's
    larger neighbours on its smallest one (large star), then each node and its
    smaller neighbours on the smallest of these (small star), until the set of
    links stays the same. A round moves links only, its minima are taken before
    the shuffle, and its result is written to the shared folder. The minima are
    written too: a join with a plain table lets the planner split a hub.
    No links give no rows; null nodes and links of a node to itself are ignored.
    """
    edges = written_table(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .distinct(),
        "links",
    )
    before = _mark(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both)
        large = (
            both.join(least.hint("merge"), "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = written_table(large, "links")
        least = _least(large)
        edges = written_table(
            large.join(least.hint("merge"), "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct(),
            "links",
        )
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _least(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return written_table(least.select("u", F.least("u", "m").alias("m")), "least")


def _mark(edges: DataFrame) -> tuple:
    """Count and checksum of the links."""
    hashed = F.xxhash64("u", "v")
    found = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.shiftright(hashed, 16)).alias("s"), F.bit_xor(hashed).alias("x")
    ).first()
    return found["n"], found["s"], found["x"]
