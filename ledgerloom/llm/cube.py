"""Mixing sources to target weights by balanced sampling.

Every source gets a target in words. Each of its documents is taken a whole number
of times, and once more with a probability. Which documents that are is settled by
the cube method: the probabilities of three documents at a time move along the
direction that changes neither the words nor the number of documents to be taken,
until one of them is 0 or 1. At most two documents per block stay open; they go on
together with those of other blocks, and the last two of a source are landed.
Of rows equal in doc_id, text and source as many as their chances add up to are
taken at once, and one stays with the rest of the sum; both sums are kept by that.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import mixed
from ledgerloom.operators.joins import lookup_join
from ledgerloom.session import written_table

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
WORD = r"[^\x20\x09-\x0D]+"
# Documents settled in one group.
BLOCK_ROWS = 8192


def words(text: str | Column = "text") -> Column:
    """Words of the whole text; none in null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """``source, source_size, n_docs, number, target`` of every source in ``sizes`` (``source, size``).

    Sources in order of code point, null last, bear the weights in turn and share
    the total size. A target stops at ``most`` times its source's size; what is
    over goes to the others by weight, until none is above. The table has one
    row per source, and each round takes sums over it.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("number") % len(weights) + 1)
    each = written_table(
        each.withColumn("number", place)
        .withColumn("weight", weight)
        .withColumn("top", F.col("source_size").cast("double") * most),
        "mix-sources",
    )
    level, full = 0.0, -1
    while True:
        capped = F.col("weight") * F.lit(level) > F.col("top")
        found = each.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(capped, 1).otherwise(0)).alias("full"),
            F.sum(F.when(capped, F.col("top")).otherwise(0.0)).alias("given"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not found["open"] or found["full"] == full:
            break
        full = found["full"]
        level = (found["total"] - found["given"]) / found["open"]
    return each.select("source", "source_size", "n_docs", "number", F.least(F.col("weight") * F.lit(level), "top").alias("target"))


def flight(chance: np.ndarray, size: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Move the chances of the documents to 0 or 1, at most two excepted; ``draws`` are uniform numbers.

    Sums of the chances, and of the chances times the sizes, stay what they are.
    """
    chance = chance.copy()
    p, s = chance.tolist(), size.astype(float).tolist()
    held: list[int] = []
    for at in range(len(p)):
        if p[at] <= 0.0 or p[at] >= 1.0:
            continue
        held.append(at)
        if len(held) < 3:
            continue
        a, b, c = held
        u = (s[b] - s[c], s[c] - s[a], s[a] - s[b])
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for unit, step in zip(held, u):
            if step > 0:
                up, down = min(up, (1 - p[unit]) / step), min(down, p[unit] / step)
            elif step < 0:
                up, down = min(up, p[unit] / -step), min(down, (1 - p[unit]) / -step)
        move = up if draws[at] * (up + down) < down else -down
        for unit, step in zip(held, u):
            value = p[unit] + move * step
            p[unit] = 0.0 if value < 1e-9 else 1.0 if value > 1 - 1e-9 else value
        held = [unit for unit in held if 0.0 < p[unit] < 1.0]
        if len(held) == 3:
            # Rounding kept all three open: settle the one that is closest.
            unit = min(held, key=lambda k: min(p[k], 1 - p[k]))
            p[unit] = float(round(p[unit]))
            held.remove(unit)
    return np.array(p)


def land(chance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Settle the open documents, two at most: first keep the words, then the number of documents."""
    chance = chance.copy()
    open_ = np.flatnonzero((chance > 0) & (chance < 1))
    want, count = float((chance[open_] * size[open_]).sum()), float(chance[open_].sum())
    choices = [[bool(n >> k & 1) for k in range(len(open_))] for n in range(1 << len(open_))]
    best = min(choices, key=lambda c: (abs(float(size[open_][c].sum()) - want), abs(sum(c) - count), c))
    chance[open_] = np.array(best, dtype=float)
    return chance


def settle(rows: pd.DataFrame) -> pd.DataFrame:
    """One block of a source: flight, and landing where the source has no other block."""
    rows = rows.sort_values(["dice", "doc_id", "size"], kind="stable")
    size = rows["size"].to_numpy(np.float64)
    dice = rows["dice"].to_numpy(np.int64).view(np.uint64) + np.arange(len(rows), dtype=np.uint64)
    draws = (mixed(dice) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    chance = flight(rows["chance"].to_numpy(np.float64), size, draws)
    if int(rows["blocks"].iloc[0]) <= 1:
        chance = land(chance, size)
    return rows.assign(chance=chance)


def settled_keys(docs: DataFrame, weights: tuple[int, ...], most: int, seed: int = 7) -> DataFrame:
    """``doc_id, row_key, source, size, source_size, target, whole, n, more``, one row for all rows equal in the first four.

    ``n`` rows of the table are such, ``more`` of them are taken ``whole + 1``
    times, the others ``whole`` times. A row that many share is counted in the
    map tasks and then one row, so no block grows with it.
    """
    sizes = written_table(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_key"), "source", words().alias("size")
        ),
        "mix-sizes",
    )
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    share = (
        targets(sizes, weights, most)
        .withColumn("times", times)
        .withColumn("whole", F.floor(F.col("times") + 1e-12).cast("int"))
        .withColumn("chance", F.greatest(F.col("times") - F.col("whole"), F.lit(0.0)))
        .withColumn("blocks", F.ceil(F.col("n_docs") / F.lit(BLOCK_ROWS)).cast("int"))
        .select(
            F.col("source").isNull().alias("unnamed"),
            F.coalesce("source", F.lit("")).alias("named"),
            *("source_size", "target", "number", "whole", "chance", "blocks"),
        )
    )
    rows = sizes.groupBy("doc_id", "row_key", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumns({"unnamed": F.col("source").isNull(), "named": F.coalesce("source", F.lit(""))})
    dice = F.xxhash64("doc_id", "row_key", F.lit(seed))
    total = F.col("n") * F.col("chance")
    sure = F.least(F.floor(total + 1e-9), F.col("n")).cast("long")
    rows = lookup_join(rows, share, ["unnamed", "named"]).select(
        *("doc_id", "row_key", "source", "size", "source_size", "target", "number", "whole", "n", "blocks"),
        sure.alias("sure"),
        F.greatest(total - sure, F.lit(0.0)).alias("chance"),
        dice.alias("dice"),
        F.pmod(F.xxhash64("doc_id", "row_key"), F.col("blocks")).cast("int").alias("block"),
    )
    open_ = rows
    settled = None
    while True:
        done = written_table(open_.groupBy("number", "block").applyInPandas(settle, open_.schema), "mix-settled")
        still = (F.col("chance") > 0) & (F.col("chance") < 1)
        settled = done.where(~still) if settled is None else settled.union(done.where(~still))
        open_ = done.where(still)
        if open_.isEmpty():
            break
        # Two rows a block are left, so this many old blocks make a new one.
        fewer = F.ceil(F.col("blocks") / F.lit(BLOCK_ROWS // 2)).cast("int")
        open_ = open_.withColumn("block", F.pmod("block", fewer).cast("int")).withColumn("blocks", fewer)
    return settled.select(
        *("doc_id", "row_key", "source", "size", "source_size", "target", "whole", "n"),
        (F.col("sure") + F.col("chance").cast("long")).alias("more"),
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES, seed: int = 7) -> DataFrame:
    """``doc_id, row_key, source, size, source_size, target, copies, taken``, one row per row of ``docs``.

    ``taken`` is ``copies`` times the size; no document is taken more than
    ``most`` times. Words of null and empty texts are 0, null is a source of its
    own, a source without words has target 0. The draw hangs on a hash of doc_id
    and text, so reruns agree however the table is stored; rows equal in both
    may swap places. Other columns are ignored, an empty table gives no rows.

    Blocks of a source are groups of hashes, so a hot source is spread over
    tasks; what a block leaves open, two rows at most, goes to the next round.
    A row that very many share is spread over tasks in pieces of a block.
    """
    keys = settled_keys(docs, weights, most, seed)
    size = F.lit(BLOCK_ROWS).cast("long")
    few = keys.where(F.col("n") <= size).withColumn("place", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    last = F.floor((F.col("n") - 1) / size).cast("long")
    many = keys.where(F.col("n") > size).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    many = many.repartition("doc_id", "row_key", "piece").withColumn(
        "place", F.explode(F.sequence(F.col("piece") * size + 1, F.least("n", (F.col("piece") + 1) * size)))
    )
    copies = F.col("whole") + (F.col("place") <= F.col("more")).cast("int")
    return few.union(many.drop("piece").select(few.columns)).select(
        *("doc_id", "row_key", "source", "size", "source_size", "target"),
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """``docs`` with a column ``copies``: the rows the mix takes, and how often; rows not taken are left out.

    Rows that agree in doc_id, text and source are matched in any order. Where
    they differ in copies they are numbered in pieces of about a block each. A
    column ``copies`` of the input is replaced.
    """
    if "copies" in docs.columns:
        docs = docs.drop("copies")
    counted = written_table(
        settled_keys(docs, weights, most)
        .groupBy(F.col("doc_id").alias("w0"), F.col("row_key").alias("w1"), F.col("source").alias("w2"))
        .agg(F.sum("n").alias("n"), F.sum("more").alias("more"), F.max("whole").alias("whole")),
        "mix-copies",
    )
    plain = docs.toDF(*[f"c{at}" for at in range(len(docs.columns))])
    doc_id, text, source = (plain[f"c{docs.columns.index(name)}"] for name in ("doc_id", "text", "source"))
    keyed = plain.select("*", doc_id.cast("long").alias("k0"), F.xxhash64(text).alias("k1"), source.alias("k2"))
    same = F.expr("k0 <=> w0 AND k1 = w1 AND k2 <=> w2")
    alike = counted.where("more = n OR more = 0 AND whole > 0").withColumn("copies", F.expr("whole + int(more > 0)"))
    out = keyed.join(alike.hint("merge"), same).select(*plain.columns, "copies")
    differing = counted.where("more > 0 AND more < n")
    if not differing.isEmpty():
        out = out.union(numbered(keyed.join(differing.hint("merge"), same)).select(*plain.columns, "copies"))
    return out.withColumn("copies", F.col("copies").cast("int")).toDF(*docs.columns, "copies")


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copies``: ``whole + 1`` for ``more`` of the ``n`` rows of a key (w0, w1, w2), ``whole`` for the others, if any."""
    pieces = F.ceil(F.col("n") / F.lit(BLOCK_ROWS))
    # Written once, as the random pieces must stay what they are.
    rows = written_table(rows.withColumn("piece", F.floor(F.rand(7) * pieces).cast("int")), "mix-pieces")
    key = ["w0", "w1", "w2"]
    before = F.sum("held").over(Window.partitionBy(*key).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    room = (
        rows.groupBy(*key, "piece", "more")
        .agg(F.count(F.lit(1)).alias("held"))
        .select(*[F.col(k).alias(f"r{k}") for k in key], F.col("piece").alias("rpiece"), (F.col("more") - F.coalesce(before, F.lit(0))).alias("room"))
    )
    rows = rows.join(room, F.expr("w0 <=> rw0 AND w1 = rw1 AND w2 <=> rw2 AND piece = rpiece"))
    place = F.row_number().over(Window.partitionBy(*key, "piece").orderBy("w1"))
    return rows.withColumn("copies", F.col("whole") + (place <= F.col("room")).cast("int")).where("copies > 0")
