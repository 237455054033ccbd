"""A prefix trie of conversations, found by digests of blocks of turns.

Conversations are grouped by the digests of successive blocks of ``BLOCK_TURNS``
turns, each chained to the one before, so conversations that share a beginning
share the digests of all its blocks. Where a beginning goes on in a single block,
the turns of that block part no conversations and are taken as they are; only
where several blocks follow one beginning are these blocks, one row each however
many conversations hold them, opened at their turns and grouped again.

Sums over subtrees need no walk over the levels. The smallest conversation of a
node owns it, so a conversation owns the end of its path from some turn on. Let
``free`` be its words before that turn. A node's descendants then save the sum of
``free`` over all members, less the owner's own, less the words before the node
for each other member; and its leaves are the members that own a leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerloom.operators.joins import lookup_join
from ledgerloom.session import written_table

BLOCK_TURNS = 4
DIGEST_BYTES = 16
ROOT = bytes(DIGEST_BYTES)
# Ids joined into one text before their hash goes on.
PIECE_IDS = 8192
BATCH_ROWS = 4096
WORDS = r"[^\x20\x09-\x0D]+"
BLOCKS = "conv_id long, block long, prefix binary, node binary, digests binary, words array<long>, before long, total long, last boolean"


def digest(*parts: Column) -> Column:
    """The first 128 bits of the SHA-256 of binary columns behind each other."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 2 * DIGEST_BYTES))


def numbered(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, digest, words`` of every turn: its place from 0, its hash, its words.

    Turns are ordered by ``turn``, null first, then by role and text; null roles
    and texts are empty, rows with a null conv_id are left out, repeated rows are
    turns of their own. Texts are not shuffled, but for turns that share their
    number, where they decide the order.
    """
    plain = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    marked = plain.withColumn("no_turn", F.col("turn").isNull()).withColumn("turn", F.coalesce("turn", F.lit(0)))
    place = ["conv_id", "no_turn", "turn"]
    tied = marked.groupBy(*place).count().where("count > 1").select(*place, F.lit(True).alias("tied"))
    rows = lookup_join(marked, tied, place).select(
        *place,
        F.when(F.col("tied"), F.col("role")).alias("role"),
        F.when(F.col("tied"), F.col("text")).alias("text"),
        digest(F.octet_length("role").cast("string").cast("binary"), F.lit(b":"), F.col("role").cast("binary"), F.col("text").cast("binary")).alias("digest"),
        F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.desc("no_turn"), "turn", "role", "text")
    return rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("pos"), "digest", "words")


def chained(batches: Iterator[pa.RecordBatch], size: int = BLOCK_TURNS) -> Iterator[pa.RecordBatch]:
    """Turns in order of conversation and place to blocks; of a conversation only the open block is held.

    A row without a digest says that the conversation is there, also if no turn follows.
    """
    names = [column.split()[0] for column in BLOCKS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.bool_()]
    done: list[tuple] = []
    conv, block, prefix, before = None, 0, ROOT, 0
    held: list[bytes] = []
    words: list[int] = []

    def close(last: bool) -> bytes:
        raw = b"".join(held)
        node = hashlib.sha256(prefix + raw).digest()[:DIGEST_BYTES] if held else prefix
        done.append((conv, block, prefix, node, raw, list(words), before, before + sum(words), last))
        return node

    for batch in batches:
        for c, found, n in zip(*(batch.column(name).to_pylist() for name in ("conv_id", "digest", "words"))):
            if c != conv:
                if conv is not None:
                    close(True)
                conv, block, prefix, before = c, 0, ROOT, 0
                held.clear()
                words.clear()
            if found is None:
                continue
            if len(held) == size:
                prefix, before = close(False), before + sum(words)
                block += 1
                held.clear()
                words.clear()
            held.append(found)
            words.append(n)
            if len(done) >= BATCH_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done), kinds)], names)
                done.clear()
    if conv is not None:
        close(True)
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done), kinds)], names)


def unfolded(variants: DataFrame, how: dict[str, Column], spread: list[Column]) -> DataFrame:
    """The turns of each block as nodes; those of blocks that diverge from siblings are grouped by ``how``.

    ``spread`` are columns that belong to a node whatever block it was found in.
    """
    turns = variants.select("*", F.posexplode("words").alias("at", "own"))
    upto = lambda n: digest(F.col("prefix"), F.expr(f"substring(digests, 1, {DIGEST_BYTES} * ({n}))"))
    nodes = turns.select(
        upto("at + 1").alias("key"), *spread, "diverges", *[F.col(name) for name in how]
    )
    same = [c for c in nodes.columns if c not in how and c != "diverges"]
    parted = nodes.where("diverges").groupBy(*same).agg(*[c.alias(name) for name, c in how.items()])
    return nodes.where("NOT diverges").select(*same, *how).unionByName(parted)


def nodes(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per distinct beginning of conversations, the empty one (the root) included.

    ``turns`` holds ``conv_id, pos, digest, words`` as ``numbered`` gives them;
    ``pos`` only orders. ``ids`` names conversations (``conv_id``) that are there
    even without a turn. Columns: ``node`` and ``parent`` (hex digests of the
    turns, null for the root's parent), ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``words`` (of
    the last turn), ``saved_tokens`` and ``ends_sha256``. No conversation at all
    gives no row. A conversation goes through one task turn by turn, without its
    texts, and is never held whole; one beginning may be common to any number.
    """
    rows = turns.select("conv_id", "pos", "digest", "words")
    if ids is not None:
        there = ids.select("conv_id", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words"))
        rows = rows.unionByName(there)
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    blocks = written_table(ordered.mapInArrow(chained, BLOCKS), "trie-blocks")

    # What a node is made of follows from its digest, so grouping by it all is grouping by the digest.
    path = ["prefix", "node", "block", "digests", "words", "before"]
    held = blocks.where("digests <> X''").groupBy(*path).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
    held = written_table(held, "trie-variants")
    several = held.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("prefix", F.lit(True).alias("diverges"))
    variants = lookup_join(held, several, ["prefix"]).withColumn("diverges", F.coalesce("diverges", F.lit(False)))
    spread = [
        F.when(F.col("at") == 0, F.col("prefix")).otherwise(digest(F.col("prefix"), F.expr(f"substring(digests, 1, {DIGEST_BYTES} * at)"))).alias("parent"),
        (F.col("block") * BLOCK_TURNS + F.col("at") + 1).alias("depth"),
        (F.col("before") + F.aggregate(F.slice("words", 1, F.col("at")), F.lit(0).cast("long"), lambda a, b: a + b)).alias("before"),
        F.col("own").alias("words"),
    ]
    below = unfolded(variants, {"n_convs": F.sum("n_convs"), "conv_id": F.min("conv_id")}, spread)
    root = blocks.where("block = 0").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = root.select(F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"), zero.alias("depth"), zero.alias("before"), zero.alias("words"), "n_convs", "conv_id")
    found = written_table(below.unionByName(root), "trie-nodes")
    children = found.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    family = written_table(found.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", zero)), "trie-family")

    owners = family.groupBy("conv_id").agg(F.min("before").alias("free"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    ends = blocks.where("last").select("conv_id", "node", "total")
    scored = ends.join(owners, "conv_id", "left").select(
        "conv_id", F.coalesce("free", "total").alias("free"), F.coalesce("leaf", zero).alias("leaf")
    )
    scored = written_table(scored, "trie-scores")
    sums = blocks.where("digests <> X''").select("conv_id", "node").join(scored, "conv_id").groupBy("node").agg(F.sum("free").alias("free"), F.sum("leaf").alias("leaf"))
    totals = unfolded(variants.join(sums, "node"), {"free": F.sum("free"), "leaf": F.sum("leaf")}, [])
    totals = totals.unionByName(scored.agg(F.sum("free").alias("free"), F.sum("leaf").alias("leaf")).select(F.lit(ROOT).alias("key"), "free", "leaf"))

    own = owners.select("conv_id", F.col("free").alias("owner_free"))
    full = family.join(totals, "key").join(ended(ends.select(F.col("node").alias("key"), "conv_id")), "key", "left")
    full = full.join(own, "conv_id")
    parents = found.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return lookup_join(full, parents, ["parent"]).select(
        F.lower(F.hex("key")).alias("node"),
        F.lower(F.hex("parent")).alias("parent"),
        *("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "words"),
        F.col("leaf").alias("n_leaves"),
        (F.col("free") - F.col("owner_free") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def ended(ends: DataFrame) -> DataFrame:
    """``key, ends_sha256``: the SHA-256 of the ids that end at a node, ascending and joined by commas.

    Ids are sorted over all tasks and joined into pieces where they lie; only the
    pieces of a node then meet, one after the other in one running hash.
    """
    kind = "key binary, first long, ids string"
    placed = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = placed.mapInArrow(joined_ids, kind).repartition("key").sortWithinPartitions("key", "first")
    return pieces.mapInArrow(hashed_ids, "key binary, ends_sha256 string")


def joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, id) rows to pieces of at most ``PIECE_IDS`` ids of one key."""
    names, kinds = ["key", "first", "ids"], [pa.binary(), pa.int64(), pa.string()]
    key, held = None, []
    for batch in batches:
        out = []
        for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if k != key or len(held) == PIECE_IDS:
                if held:
                    out.append((key, held[0], ",".join(map(str, held))))
                key, held = k, []
            held.append(c)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names)
    if held:
        row = (key, held[0], ",".join(map(str, held)))
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names)


def hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one hash per key, which runs on from piece to piece."""
    names, kinds = ["key", "ends_sha256"], [pa.binary(), pa.string()]
    key, running = None, None
    for batch in batches:
        out = []
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if k == key:
                running.update(b"," + ids.encode())
                continue
            if key is not None:
                out.append((key, running.hexdigest()))
            key, running = k, hashlib.sha256(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], kinds[0]), pa.array([running.hexdigest()], kinds[1])], names)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of ``conversations`` (``conv_id, turn, role, text``) as they stand; see ``numbered`` and ``nodes``."""
    return nodes(written_table(numbered(conversations), "trie-turns"))
