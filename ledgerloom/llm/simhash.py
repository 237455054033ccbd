"""SimHash fingerprints, and near-duplicate classes through an inverted index over their bytes.

A fingerprint has eight bytes. Two that differ in at most three bits differ in at
most three bytes, so they share at least five positional bytes. The index posts
every distinct fingerprint under sets of four (position, byte) pairs, chosen so
that any five positions contain one of the sets. Within a posting list the shared
positional bytes of each pair are tallied, pairs below five are dropped, and the
bit distance of the rest is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.llm.common import row_key, small_components
from ledgerloom.llm.graph import components
from ledgerloom.operators.joins import lookup_join
from ledgerloom.session import written_table

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
# A posting list longer than this is compared block by block, in tasks of its own.
LIST_ROWS = 4096

_LOWER = bytes(byte + 32 if 65 <= byte <= 90 else byte for byte in range(256))
_PIECE = 1 << 18
_PAIRED = 64


def position_sets() -> list[tuple[int, ...]]:
    """22 sets of four byte positions; any five of the eight positions contain one.

    The positions form four couples. Five positions hold either two whole
    couples, or one whole couple and one of each other couple: the sets are all
    two couples, and each couple with one of each of two others.
    """
    couples = [(0, 1), (2, 3), (4, 5), (6, 7)]
    sets = [a + b for a, b in combinations(couples, 2)]
    for couple in couples:
        first, second = [other for other in couples if other != couple][:2]
        sets += [couple + picked for picked in product(first, second)]
    return [tuple(sorted(found)) for found in sets]


def fingerprint(text: str | None, words_each: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a whole text, as an unsigned number.

    A-Z is lowered, words are split at ASCII white space. A text with fewer
    words than a shingle has one shingle of all its words; a text without words,
    and null, has fingerprint zero.
    """
    words = (b"" if text is None else text.encode("utf-8", "surrogatepass").translate(_LOWER)).split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words_each, len(words))
    begins, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(begins), _PIECE):
        hashes = [digest(whole[a:b], SEED) for a, b in zip(begins[at : at + _PIECE], ends[at : at + _PIECE])]
        octets = np.array(hashes, dtype=np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(begins)).tobytes(), "big")


def fingerprinting(words_each: int):
    def fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(text.as_py(), words_each) for text in batch.column("text")], dtype=np.uint64)
            others = [name for name in batch.schema.names if name != "text"]
            columns = [batch.column(name) for name in others] + [pa.array(values.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, others + ["fp"])

    return fingerprinted


def fingerprints(docs: DataFrame, words_each: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``row_key`` and the fingerprint ``fp`` (a signed long) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"), "text")
    return rows.mapInArrow(fingerprinting(words_each), "doc_id long, row_key long, fp long")


def postings(prints: DataFrame) -> DataFrame:
    """``(key, fp)``: each fingerprint once under each of its sets of positional bytes."""
    keys = []
    for number, positions in enumerate(position_sets()):
        key = F.lit(number).cast("long")
        for position in positions:
            byte = F.shiftright("fp", 8 * position).bitwiseAND(F.lit(255).cast("long"))
            key = F.shiftleft(key, 8).bitwiseOR(byte)
        keys.append(key)
    return prints.select(F.explode(F.array(*keys)).alias("key"), "fp")


def matches(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """Pairs that reach the count of shared positional bytes, then lie within ``bits`` bits."""
    different = left ^ right
    octets = np.ascontiguousarray(different).view(np.uint8).reshape(*different.shape, 8)
    found = (octets == 0).sum(axis=-1, dtype=np.uint8) >= 8 - bits
    found[found] = np.bitwise_count(different[found]) <= bits
    return found


def block_pairs(left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of matching pairs of two short lists, compared a strip at a time."""
    found = []
    for at in range(0, len(left), 256):
        i, j = np.nonzero(matches(left[at : at + 256, None], right[None, :], bits))
        found.append((i + at, j))
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def list_links(keys: np.ndarray, prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what matches within each posting list: a tree per class, not all its pairs.

    ``keys`` is sorted and holds whole lists of at most ``LIST_ROWS`` rows.
    """
    bounds = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
    sizes = np.diff(bounds)
    left, right = [], []
    own = np.repeat(sizes, sizes)
    few = own <= _PAIRED
    step = 1
    rows = np.flatnonzero(few)
    while True:
        rows = rows[rows + step < len(keys)]
        rows = rows[keys[rows] == keys[rows + step]]
        if not len(rows):
            break
        hit = rows[matches(prints[rows], prints[rows + step], bits)]
        left.append(hit)
        right.append(hit + step)
        step += 1
    for at in np.flatnonzero(sizes > _PAIRED):
        a, b = bounds[at], bounds[at + 1]
        i, j = block_pairs(prints[a:b], prints[a:b], bits)
        left.append(i[i < j] + a)
        right.append(j[i < j] + a)
    if not left:
        return prints[:0], prints[:0]
    label = small_components(len(keys), np.concatenate(left), np.concatenate(right))
    tied = np.flatnonzero(label != np.arange(len(keys)))
    return prints[label[tied]], prints[tied]


def linking(bits: int, limit: int):
    """Over rows sorted by key: links of short lists; rows of longer lists are handed on (``kind`` 1)."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(kind, a, b):
            columns = [pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))]
            return pa.RecordBatch.from_arrays(columns, ["kind", "a", "b"])

        held_keys, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        long_key = None
        for batch in batches:
            keys = np.concatenate([held_keys, batch.column("key").to_numpy(zero_copy_only=False)])
            prints = np.concatenate([held, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(keys):
                continue
            # The last list may go on in the next batch.
            cut = int(np.searchsorted(keys, keys[-1], "left"))
            done_keys, done = keys[:cut], prints[:cut]
            held_keys, held = keys[cut:], prints[cut:]
            bounds = np.flatnonzero(np.concatenate(([True], done_keys[1:] != done_keys[:-1], [True]))) if cut else np.zeros(1, int)
            sizes = np.diff(bounds)
            longer = np.repeat((sizes > limit) | (done_keys[bounds[:-1]] == long_key if long_key is not None else False), sizes)
            if longer.any():
                yield rows(1, done_keys[longer], done[longer])
            if cut:
                yield rows(0, *list_links(done_keys[~longer], done[~longer], bits)) if (~longer).any() else rows(0, done[:0], done[:0])
            if len(held) > limit or held_keys[0] == long_key:
                long_key = held_keys[0]
                yield rows(1, held_keys, held)
                held_keys, held = held_keys[:0], held[:0]
        if len(held):
            yield rows(0, *list_links(held_keys, held, bits))

    return linked


def linking_blocks(bits: int):
    """Over rows sorted by (key, block pair, side): links within and between two blocks of a long list."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, sides = None, ([], [])

        def links():
            left, right = (np.concatenate(side) if side else np.zeros(0, np.uint64) for side in sides)
            prints = np.concatenate([left, right])
            if group[1] == group[2]:
                i, j = block_pairs(prints, prints, bits) if len(prints) else (np.zeros(0, int),) * 2
                i, j = i[i < j], j[i < j]
            else:
                i, j = block_pairs(left, right, bits) if len(left) and len(right) else (np.zeros(0, int),) * 2
                j = j + len(left)
            label = small_components(len(prints), i, j)
            tied = np.flatnonzero(label != np.arange(len(prints)))
            columns = [pa.array(prints[label[tied]].view(np.int64)), pa.array(prints[tied].view(np.int64))]
            return pa.RecordBatch.from_arrays(columns, ["a", "b"])

        for batch in batches:
            columns = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("key", "i", "j", "side")]
            prints = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(prints):
                continue
            change = np.zeros(len(prints), bool)
            for column in columns:
                change[1:] |= column[1:] != column[:-1]
            edges = [0, *np.flatnonzero(change).tolist(), len(prints)]
            for a, b in zip(edges, edges[1:]):
                here = tuple(int(column[a]) for column in columns[:3])
                if group is not None and here != group:
                    yield links()
                    sides = ([], [])
                group = here
                sides[int(columns[3][a])].append(prints[a:b])
        if group is not None:
            yield links()

    return linked


def links(prints: DataFrame, bits: int = MAX_BITS, limit: int = LIST_ROWS) -> DataFrame:
    """``(a, b)``: links that connect all distinct fingerprints within ``bits`` bits of each other.

    ``prints`` has distinct longs in ``fp``. Classes come out connected as by all
    pairs, but a posting list gives a tree per class. Lists over ``limit`` rows
    are cut into blocks, and every two blocks are compared in a group of their own.
    """
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"the sets of positions are made for at most {MAX_BITS} bits")
    found = written_table(
        postings(prints)
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(linking(bits, limit), "kind int, a long, b long"),
        "simhash-links",
    )
    pairs = found.where("kind = 0").select("a", "b")
    long_lists = found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    counts = long_lists.groupBy("key").agg(F.ceil(F.count(F.lit(1)) * 2 / F.lit(limit)).cast("int").alias("blocks"))
    if counts.isEmpty():
        return pairs
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = (
        long_lists.join(written_table(counts, "simhash-lists").hint("merge"), "key")
        .select("key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select(
            "key",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
            "fp",
        )
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "side")
    )
    return pairs.union(dealt.mapInArrow(linking_blocks(bits), "a long, b long"))


def classes(rows: DataFrame, bits: int = MAX_BITS, limit: int = LIST_ROWS) -> DataFrame:
    """Each distinct ``fp`` with ``root``, the key of its class, and ``component_id``, the class's smallest doc_id."""
    prints = written_table(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-prints")
    roots = written_table(components(links(prints.select("fp"), bits, limit)), "simhash-roots")
    named = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = written_table(named, "simhash-named")
    least = written_table(named.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least")
    return written_table(named.select("fp", "root").join(least.hint("merge"), "root"), "simhash-classes")


def near_duplicates(
    docs: DataFrame, words_each: int = SHINGLE_WORDS, bits: int = MAX_BITS, limit: int = LIST_ROWS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``row_key``, ``fingerprint``, ``root``, ``component_id``.

    Fingerprints within ``bits`` bits are linked; ``component_id`` is the smallest
    doc_id that can be reached, null where all of them are null. Texts without
    words (null, empty, blank) share fingerprint zero and link like any other.
    Repeated rows give repeated rows; other columns are ignored. Documents with
    equal fingerprints meet the index once, however many they are.
    """
    rows = written_table(fingerprints(docs, words_each), "simhash-rows")
    found = classes(rows, bits, limit)
    return rows.join(found.hint("merge"), "fp").select(
        "doc_id", "row_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "root", "component_id"
    )


def keep_one_each(docs: DataFrame, words_each: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: the smallest doc_id, ties by text hash, nulls last.

    Of rows that agree in doc_id and text one stays. All columns are kept,
    whatever their names. Winners are found on keys alone, aggregated in the map
    tasks. Texts stay where they are while the keys that go can be broadcast.
    """
    found = near_duplicates(docs, words_each, bits)
    key = ["k0", "k1", "no_id"]
    named = found.select("root", F.col("doc_id").alias("k0"), F.col("row_key").alias("k1"))
    named = named.withColumn("no_id", F.col("k0").isNull()).withColumn("k0", F.coalesce("k0", F.lit(0).cast("long")))
    counted = written_table(named.groupBy("root", *key).agg(F.count(F.lit(1)).alias("n")), "simhash-counted")
    least = F.min(F.struct("no_id", "k0", "k1")).alias("least")
    winners = written_table(counted.groupBy("root").agg(least).select("least.*"), "simhash-winners")
    losers = counted.select(*key).join(winners.hint("merge"), key, "left_anti")
    # Rows equal in id and text that win together: one of them stays.
    repeated = written_table(counted.where("n > 1").select(*key).join(winners.hint("merge"), key, "left_semi"), "simhash-repeated")
    plain = docs.toDF(*[f"c{at}" for at in range(len(docs.columns))])
    doc_id, text = (plain[f"c{docs.columns.index(name)}"] for name in ("doc_id", "text"))
    keyed = plain.select(
        "*", F.coalesce(doc_id.cast("long"), F.lit(0).cast("long")).alias("k0"), F.xxhash64(text).alias("k1"), doc_id.isNull().alias("no_id")
    )
    kept = lookup_join(keyed, written_table(losers, "simhash-losers"), key, "left_anti")
    if repeated.isEmpty():
        return kept.select(plain.columns).toDF(*docs.columns)
    only = Window.partitionBy(*key).orderBy("k1")
    once = lookup_join(kept, repeated, key, "left_semi").withColumn("rank", F.row_number().over(only)).where("rank = 1")
    single = lookup_join(kept, repeated, key, "left_anti")
    return single.select(plain.columns).union(once.select(plain.columns)).toDF(*docs.columns)
