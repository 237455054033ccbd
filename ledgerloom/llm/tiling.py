"""Benchmark decontamination by greedy string tiling.

Texts are lower-cased and split into tokens: words, and single characters of
scripts that put no blanks between words. Rolling hashes of ``SEED_TOKENS`` tokens
of every document (of all an item has, where it has fewer) are looked up in the
seeds of the benchmark. For an item that could still reach the threshold, the
seeds are extended to maximal matches, and the longest match that overlaps no tile
becomes a tile, again and again, in whatever order the passages stand. The share
of the item's tokens under tiles decides.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import BLOCK_BYTES, TOKEN_BYTES, blocks, grams, joined, runs, span_hashes
from ledgerloom.session import written_table

SEED_TOKENS = 5
THRESHOLD = 0.5
# Benchmark text sent to the tasks at a time; larger benchmarks take several passes over the documents.
QUERY_BYTES = 16 << 20
# Pairs of equal seeds laid out at a time.
PAIRS = 1 << 20


@lru_cache(maxsize=1)
def _resized() -> re.Pattern:
    """The characters that lower-casing makes longer or shorter in UTF-8."""
    found = [chr(c) for c in range(0x80, 0x20000) if not 0xD800 <= c < 0xE000 and len(chr(c).lower().encode()) != len(chr(c).encode())]
    return re.compile("([" + "".join(map(re.escape, found)) + "])")


def folded(text: str | None) -> str | None:
    """Lower case at the same places in UTF-8: the few characters that would change their length stay."""
    if text is None or text.isascii():
        return text and text.lower()
    return "".join(part if at % 2 else part.lower() for at, part in enumerate(_resized().split(text)))


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of characters of scripts written without blanks (Han, kana, Thai, Lao, Khmer, Burmese)."""
    lead = np.flatnonzero(data >= 0xE0)
    lead = lead[lead + 2 < len(data)]
    a, b = data[lead], data[lead + 1]
    kept = (a == 0xE0) & (b >= 0xB8) & (b <= 0xBB) | (a == 0xE1) & ((b >= 0x80) & (b <= 0x82) | (b == 0x9E) | (b == 0x9F))
    kept |= (a == 0xE3) & (b >= 0x81) | (a >= 0xE4) & (a <= 0xE9) | (a == 0xEF) & (b >= 0xA4) & (b <= 0xAB) | (a == 0xF0) & (b >= 0xA0)
    return lead[kept], lead[kept] + 3 + (a[kept] == 0xF0)


def tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the tokens in folded bytes."""
    inside = TOKEN_BYTES[data]
    single, after = _unspaced(data)
    if not len(single):
        starts, ends = runs(inside)
        return starts, ends, span_hashes(data, starts, ends)
    # The punctuation of these scripts stands between tokens: U+3000 to U+303F, and the full-width forms of ASCII's.
    lead = np.flatnonzero((data == 0xE3) | (data == 0xEF))
    lead = lead[lead + 2 < len(data)]
    a, b, c = data[lead], data[lead + 1], data[lead + 2]
    marks = lead[(a == 0xE3) & (b == 0x80) | (a == 0xEF) & (b == 0xBC) & ((c <= 0x8F) | (c >= 0x9A) & (c <= 0xA0))]
    for at in range(3):
        inside[marks + at] = False
    cuts = np.zeros(len(data) + 1, bool)
    cuts[single] = cuts[after] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | cuts[1:-1]
    ends[:-1] &= ~inside[1:] | cuts[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, ends, span_hashes(data, starts, ends)


@dataclass
class Items:
    """Benchmark items of one seed length with their tokens, and their seeds in order of hash."""

    k: int
    ids: np.ndarray
    starts: np.ndarray
    hashes: np.ndarray
    seeds: np.ndarray
    seed_at: np.ndarray

    def tokens_of(self, item: int) -> np.ndarray:
        return self.hashes[self.starts[item] : self.starts[item + 1]]


def index_items(ids: list[int], texts: list[str | None], k: int = SEED_TOKENS) -> list[Items]:
    """The items by their seed length: ``k`` tokens, or as many as an item has. Items without a token are left out."""
    found = [tokens(joined([(folded(text) or "").encode("utf-8", "surrogatepass")])[0])[2] for text in texts]
    return [
        _index([ids[at] for at in chosen], [found[at] for at in chosen], length)
        for length in range(1, k + 1)
        if (chosen := [at for at, hashes in enumerate(found) if min(len(hashes), k) == length])
    ]


def _index(ids: list[int], found: list[np.ndarray], k: int) -> Items:
    starts = np.zeros(len(found) + 1, np.int64)
    np.cumsum([len(hashes) for hashes in found], out=starts[1:])
    seeds = [grams(hashes, k) for hashes in found]
    seed = np.concatenate(seeds)
    place = np.concatenate([np.arange(len(s)) + start for s, start in zip(seeds, starts)])
    order = np.argsort(seed, kind="stable")
    return Items(k, np.array(ids, np.int64), starts, np.concatenate(found), seed[order], place[order])


def places_hit(doc: np.ndarray, items: Items) -> np.ndarray:
    """Positions in the items' tokens of the seeds that a document holds, each once."""
    low, high = np.searchsorted(items.seeds, doc, "left"), np.searchsorted(items.seeds, doc, "right")
    held = high > low
    low, first = np.unique(low[held], return_index=True)
    n = high[held][first] - low
    offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return items.seed_at[np.repeat(low, n) + offset]


def matches(doc: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal rows of equal seeds: place in the document, place in the item, number of seeds.

    Pairs of equal seeds are laid out ``PAIRS`` at a time and put together along
    their diagonals at once, so that a word repeated over and over makes one row
    per diagonal and never all pairs together.
    """
    order = np.argsort(item, kind="stable")
    low, high = np.searchsorted(item[order], doc, "left"), np.searchsorted(item[order], doc, "right")
    hits = np.flatnonzero(high > low)
    n = (high - low)[hits]
    before = np.concatenate(([0], np.cumsum(n)))
    out, at = [], 0
    while at < len(hits):
        to = max(at + 1, int(np.searchsorted(before, before[at] + PAIRS, "right")) - 1)
        i = np.repeat(hits[at:to], n[at:to])
        offset = np.arange(len(i)) - np.repeat(before[at:to] - before[at], n[at:to])
        out.append(_rows(i, order[np.repeat(low[hits[at:to]], n[at:to]) + offset], np.ones(len(i), np.int64)))
        at = to
    if not out:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing
    return _rows(*(np.concatenate(part) for part in zip(*out)))


def _rows(i: np.ndarray, j: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that follow each other on a diagonal, put together."""
    order = np.lexsort((i, i - j))
    i, j, length = i[order], j[order], length[order]
    fresh = np.ones(len(i), bool)
    fresh[1:] = (np.diff(i - j) != 0) | (i[1:] != i[:-1] + length[:-1])
    begins = np.flatnonzero(fresh)
    return i[begins], j[begins], np.add.reduceat(length, begins)


def covered(positions: np.ndarray, k: int, size: int) -> int:
    """Tokens under windows of ``k`` tokens that start at ``positions``."""
    mark = np.zeros(size + 1, np.int64)
    np.add.at(mark, positions, 1)
    np.add.at(mark, np.minimum(positions + k, size), -1)
    return int((np.cumsum(mark)[:size] > 0).sum())


def tiles(
    doc_at: np.ndarray, item_at: np.ndarray, lengths: np.ndarray, k: int, doc_size: int, item_size: int
) -> list[tuple[int, int, int]]:
    """Greedy tiling: (document position, item position, length), longest first, ties by position.

    The arguments are maximal matches, their lengths in tokens. It ends when the
    item has no stretch of ``k`` tokens left.
    """
    order = np.lexsort((item_at, doc_at, -lengths))
    heap: list[tuple[int, int, int]] = []
    doc_used, item_used = np.zeros(doc_size, bool), np.zeros(item_size, bool)
    placed, at = [], 0
    while heap or at < len(order):
        best = (-int(lengths[order[at]]), int(doc_at[order[at]]), int(item_at[order[at]])) if at < len(order) else None
        if best is None or heap and heap[0] < best:
            n, a, b = heapq.heappop(heap)
        else:
            n, a, b = best
            at += 1
        n = -n
        free = ~(doc_used[a : a + n] | item_used[b : b + n])
        if free.all():
            doc_used[a : a + n] = True
            item_used[b : b + n] = True
            placed.append((a, b, n))
            begin, end = runs(~item_used)
            if not len(begin) or int((end - begin).max()) < k:
                break
            continue
        # Parts of the match that no tile covers compete again by their own length.
        for x, y in zip(*(edge.tolist() for edge in runs(free))):
            if y - x >= k:
                heapq.heappush(heap, (x - y, a + x, b + x))
    return placed


def contaminations(doc: np.ndarray, seeds: np.ndarray, items: Items, threshold: float) -> list[tuple]:
    """(item, covered share, tiles) of every item that the document covers to the threshold."""
    place = np.sort(places_hit(seeds, items))
    if not len(place):
        return []
    item_of = np.searchsorted(items.starts, place, "right") - 1
    bounds = np.flatnonzero(np.concatenate(([True], item_of[1:] != item_of[:-1], [True])))
    out, k = [], items.k
    for a, b in zip(bounds, bounds[1:]):
        item = int(item_of[a])
        size = int(items.starts[item + 1] - items.starts[item])
        # No tiling covers more than all seeds together.
        if covered(place[a:b] - items.starts[item], k, size) < threshold * size:
            continue
        i, j, n = matches(seeds, grams(items.tokens_of(item), k))
        placed = tiles(i, j, n + k - 1, k, len(doc), size)
        share = sum(n for _, _, n in placed) / size
        if share >= threshold:
            out.append((int(items.ids[item]), share, placed))
    return out


def scanning(groups: list[Items], threshold: float):
    """Over batches of documents: a list of hits per row."""
    hit = pa.struct(
        [
            ("item_id", pa.int64()),
            ("coverage", pa.float64()),
            ("spans", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
        ]
    )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = [name for name in batch.schema.names if name != "scan_text"]
            found: list[list[dict]] = []
            texts = [folded(text) for text in batch.column("scan_text").to_pylist()]
            for _, raws in blocks(texts, BLOCK_BYTES):
                data, starts = joined(raws)
                begin, end, hashes = tokens(data)
                first = np.searchsorted(begin, starts)
                hits: list[list[dict]] = [[] for _ in raws]
                for items in groups:
                    seeds = grams(hashes, items.k)
                    place = np.searchsorted(items.seeds, seeds)
                    known = np.zeros(len(hashes) + 1, np.int64)
                    known[1 : len(seeds) + 1] = items.seeds[np.minimum(place, len(items.seeds) - 1)] == seeds
                    known = np.cumsum(known)
                    for row in range(len(raws)):
                        a, b = int(first[row]), int(first[row + 1])
                        last = max(a, b - items.k + 1)
                        if known[last] == known[a]:
                            continue
                        for item, share, placed in contaminations(hashes[a:b], seeds[a:last], items, threshold):
                            spans = [
                                {"begin": int(begin[a + x] - starts[row]), "end": int(end[a + x + n - 1] - starts[row])}
                                for x, _, n in sorted(placed)
                            ]
                            hits[row].append({"item_id": item, "coverage": share, "spans": spans})
                found += hits
            columns = [batch.column(name) for name in others] + [pa.array(found, pa.list_(hit))]
            yield pa.RecordBatch.from_arrays(columns, others + ["hits"])

    return scanned


HITS = "array<struct<item_id: bigint, coverage: double, spans: array<struct<begin: int, end: int>>>>"


def query_blocks(benchmark: DataFrame, size: int = QUERY_BYTES) -> Iterator[tuple[list, list]]:
    """The benchmark in blocks of about ``size`` bytes of text, read one block at a time.

    An item goes to a block by a hash; an item without text matches nothing.
    """
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    count = max(1, -(-total // size))
    for number in range(count):
        block = rows if count == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number)
        found = sorted(((r["item_id"], r["text"]) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        found = [(-1 if i is None else i, t) for i, t in found]
        yield [i for i, _ in found], [t for _, t in found]


def scan(docs: DataFrame, benchmark: DataFrame, k: int = SEED_TOKENS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with plain column names ``c0..`` and the array ``hits``, one pass per block of the benchmark.

    Documents are not shuffled. A hit names the item, the share of its tokens
    that tiles cover, and the spans of the tiles in bytes of the text. An item
    with fewer than ``k`` tokens is found where all of them stand together. Null
    and empty texts have no hits, items without a token are never found, a null
    item_id is reported as -1, items with equal ids are looked for one by one,
    and items repeated with their text once.
    """
    text = docs.columns.index("text")
    out = docs.toDF(*[f"c{at}" for at in range(len(docs.columns))])
    plain = out.columns
    out = out.withColumn("hits", F.array().cast(HITS))
    for number, (ids, texts) in enumerate(query_blocks(benchmark)):
        if number:
            # One index in a stage at a time, however large the benchmark is.
            out = written_table(out, "tiling-scan")
        groups = index_items(ids, texts, k)
        rows = out.select(*plain, F.col("hits").alias("before"), F.col(f"c{text}").alias("scan_text"))
        schema = rows.drop("scan_text").schema.add("hits", out.schema["hits"].dataType)
        found = rows.mapInArrow(scanning(groups, threshold), schema)
        out = found.select(*plain, F.concat("before", "hits").alias("hits"))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = SEED_TOKENS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``item_ids`` (sorted), ``coverage`` (the largest) and ``hits`` of contaminated rows."""
    found = scan(docs.select("doc_id", "text"), benchmark, k, threshold).where(F.size("hits") > 0)
    return found.select(
        F.col("c0").alias("doc_id"),
        F.array_sort(F.transform("hits", lambda h: h["item_id"])).alias("item_ids"),
        F.array_max(F.transform("hits", lambda h: h["coverage"])).alias("coverage"),
        "hits",
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, k: int = SEED_TOKENS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns stay, nothing is shuffled."""
    found = scan(docs, benchmark, k, threshold).where(F.size("hits") == 0)
    return found.select([f"c{at}" for at in range(len(docs.columns))]).toDF(*docs.columns)
