"""Ranked lexical search: best-first over document intervals bounded by range maxima.

Documents lie in shards. A shard holds a posting list per term, by document; a
list gets a sparse table, from which the place of the largest impact in any range
is read in two look-ups. For a query an interval of documents cannot score more
than the sum of its terms' largest impacts in it. The interval with the largest
bound is taken next and split at the document of the largest single impact, which
is scored; the two sides are bounded anew. An interval of few postings is not
split any more: its documents are scored. The search of a shard ends when no
bound reaches the last place of the ranking, which a task carries on from shard
to shard; ranks of all tasks meet at the end, a few rows per task and query.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ledgerloom.llm.common import TOKEN_BYTES
from ledgerloom.operators.joins import BROADCAST_BYTES, fits_broadcast
from ledgerloom.session import written_table

TOP = 10
SHARD_DOCS, SHARD_POSTINGS = 8192, 1 << 20
# Distinct query text sent to the tasks at a time; more takes several passes over the postings, not over the texts.
QUERY_BYTES = 16 << 20
# Bytes of text taken apart at a time.
STRETCH = 1 << 20
LEAF_POSTINGS = 1024
# Fixed value: term bytes stay, A-Z in lower case; all others separate.
PLAIN = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if TOKEN_BYTES[b] else 0x20 for b in range(256))
# The level of a sparse table that covers a range, by the range's length.
LEVELS = np.frexp(np.arange(SHARD_DOCS + 1, dtype=np.float64))[1].astype(np.int64) - 1
SHARDS = (
    "n_docs long, n_terms long, doc_ids array<long>, sizes array<long>, "
    "terms array<binary>, counts array<int>, places array<int>, tfs array<long>"
)
SHARD_KINDS = [
    *(pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())),
    *(pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64())),
]


def term_parts(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a whole text, some at a time; a null text has none."""
    raw = b"" if text is None else text.encode("utf-8", "surrogatepass").translate(PLAIN)
    at = 0
    while at < len(raw):
        end = len(raw) if len(raw) - at <= STRETCH else raw.find(b" ", at + STRETCH)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def counted_terms(text: str | None, wanted=None) -> tuple[int, Counter]:
    """How many terms a text has, and how often each (wanted) one occurs."""
    size, counts = 0, Counter()
    for words in term_parts(text):
        size += len(words)
        counts.update(words if wanted is None else filter(wanted.__contains__, words))
    return size, counts


class Shard:
    """Postings of documents in the order they come."""

    def __init__(self):
        self.n_docs = self.n_terms = self.postings = 0
        self.doc_ids: list = []
        self.sizes: list[int] = []
        self.lists: dict[bytes, tuple[list[int], list[int]]] = {}

    def add(self, doc_id, size: int, counts: Counter) -> None:
        self.n_docs += size > 0
        self.n_terms += size
        if not counts:
            return
        place = len(self.doc_ids)
        self.doc_ids.append(doc_id)
        self.sizes.append(size)
        self.postings += len(counts)
        for term, tf in counts.items():
            places, tfs = self.lists.setdefault(term, ([], []))
            places.append(place)
            tfs.append(tf)

    def full(self) -> bool:
        return len(self.doc_ids) >= SHARD_DOCS or self.postings >= SHARD_POSTINGS

    def batch(self) -> pa.RecordBatch:
        terms = sorted(self.lists)
        places = [p for term in terms for p in self.lists[term][0]]
        tfs = [n for term in terms for n in self.lists[term][1]]
        counts = [len(self.lists[term][0]) for term in terms]
        row = (self.n_docs, self.n_terms, self.doc_ids, self.sizes, terms, counts, places, tfs)
        return pa.RecordBatch.from_arrays(
            [pa.array([value], kind) for value, kind in zip(row, SHARD_KINDS)], [c.split()[0] for c in SHARDS.split(", ")]
        )


def index(docs: DataFrame, wanted: frozenset[bytes] | None = None) -> DataFrame:
    """The shards of all rows of ``docs``, written once: documents, their sizes, and posting lists by term.

    ``wanted`` limits the lists to some terms (a set whose size was checked);
    sizes and counts of documents always cover everything. Repeated rows are
    documents of their own, null ids are kept, null texts have no term.
    """
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def sharding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, terms = Shard(), shared.value
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                shard.add(doc_id.as_py(), *counted_terms(text.as_py(), terms))
                if shard.full():
                    yield shard.batch()
                    shard = Shard()
        if shard.n_docs:
            yield shard.batch()

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written_table(plain.mapInArrow(sharding, SHARDS), "ranked-shards")


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def damping(sizes: np.ndarray, n: int, length: int) -> np.ndarray:
    """``25 + (75 * size * n) div length`` of each document, in whole numbers of any size."""
    distinct, where = np.unique(sizes, return_inverse=True)
    return np.array([100 - 75 + 75 * int(size) * n // length for size in distinct], np.int64)[where]


class Postings:
    """Posting lists of one shard behind each other, their impacts, and sparse tables of the largest ones."""

    def __init__(self, key: np.ndarray, impact: np.ndarray, n_docs: int, longest: int):
        # A posting's key is its list times the documents plus its place, so keys rise over all lists.
        self.key, self.impact, self.n_docs = key, impact, n_docs
        levels = max(1, longest.bit_length())
        self.tables = np.zeros((levels, len(key)), np.int32)
        self.tables[0] = np.arange(len(key), dtype=np.int32)
        for level in range(1, levels):
            width = 1 << (level - 1)
            left, right = self.tables[level - 1, :-width], self.tables[level - 1, width:]
            self.tables[level, :-width] = np.where(impact[right] > impact[left], right, left)

    def largest(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The place of the largest impact in each range, none of them empty."""
        level = LEVELS[end - begin]
        left, right = self.tables[level, begin], self.tables[level, end - (1 << level)]
        return np.where(self.impact[right] > self.impact[left], right, left)


class Ranking:
    """The best documents found for one query: higher scores first, then smaller ids, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.held: list[tuple[int, int, int]] = []

    def offer(self, score: int, doc_id: int | None) -> None:
        entry = (score, 0 if doc_id is None else 1, 0 if doc_id is None else -doc_id)
        if len(self.held) < self.k:
            heapq.heappush(self.held, entry)
        elif entry > self.held[0]:
            heapq.heapreplace(self.held, entry)

    def least(self) -> int:
        """The score below which nothing can enter any more."""
        return self.held[0][0] if len(self.held) == self.k else 1

    def rows(self) -> list[tuple[int, int | None]]:
        return [(score, -negated if known else None) for score, known, negated in self.held]


def search(postings: Postings, doc_ids: list, lists: np.ndarray, times: np.ndarray, begin: np.ndarray, end: np.ndarray, ranking: Ranking) -> None:
    """Offer ``ranking`` every document of a shard that can enter it.

    ``lists`` numbers the query's terms in the shard, ``times`` says how often
    the query holds each, ``begin`` and ``end`` are their ranges.
    """
    impact, key, n = postings.impact, postings.key, postings.n_docs
    heap: list = []
    number = 0

    def push(lists, times, begin, end) -> None:
        nonlocal number
        if not len(begin):
            return
        best = postings.largest(begin, end)
        gain = times * impact[best]
        bound = int(gain.sum())
        if bound >= ranking.least():
            number += 1
            top = int(gain.argmax())
            heapq.heappush(heap, (-bound, number, int(key[best[top]]) - int(lists[top]) * n, lists, times, begin, end))

    push(lists, times, begin, end)
    while heap:
        bound, _, place, lists, times, begin, end = heapq.heappop(heap)
        if -bound < ranking.least():
            return
        if int((end - begin).sum()) <= LEAF_POSTINGS:
            score_all(postings, doc_ids, lists, times, begin, end, ranking)
            continue
        at = np.searchsorted(key, lists * n + place)
        here = at < end
        here[here] = key[at[here]] == lists[here] * n + place
        score = int((times[here] * impact[at[here]]).sum())
        if score > 0:
            ranking.offer(score, doc_ids[place])
        left, right = at > begin, at + here < end
        push(lists[left], times[left], begin[left], at[left])
        push(lists[right], times[right], (at + here)[right], end[right])


def score_all(postings: Postings, doc_ids: list, lists, times, begin, end, ranking: Ranking) -> None:
    """Score every document of a short interval."""
    width = end - begin
    which = np.repeat(np.arange(len(width)), width)
    at = np.arange(int(width.sum())) + np.repeat(begin - (np.cumsum(width) - width), width)
    place = postings.key[at] - lists[which] * postings.n_docs
    first = int(place.min())
    scores = np.zeros(int(place.max()) - first + 1, np.int64)
    np.add.at(scores, place - first, times[which] * postings.impact[at])
    least = ranking.least()
    for here in np.flatnonzero(scores >= least).tolist():
        ranking.offer(int(scores[here]), doc_ids[first + here])


def searching(queries: list[Counter], weights: dict[bytes, int], n: int, length: int, k: int):
    """Over shards: the best documents of the task for each query, given as numbers of the list."""
    numbers = {term: at for at, term in enumerate(weights)}
    worth = np.array(list(weights.values()), np.int64)
    # Per query its terms and how often it holds them.
    asked = []
    for query in queries:
        known = [(numbers[term], times) for term, times in query.items() if term in numbers]
        asked.append((np.array([t for t, _ in known], np.int64), np.array([x for _, x in known], np.int64)))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rankings: dict[int, Ranking] = {}
        for batch in batches:
            for row in range(len(batch)):
                doc_ids, sizes, terms, counts, places, tfs = (batch.column(c)[row].values for c in ("doc_ids", "sizes", "terms", "counts", "places", "tfs"))
                if not len(doc_ids):
                    continue
                found = np.array([numbers.get(term, -1) for term in terms.to_pylist()], np.int64)
                counts = counts.to_numpy(zero_copy_only=False)
                used = np.repeat(found >= 0, counts)
                lengths = counts[found >= 0].astype(np.int64)
                if not len(lengths):
                    continue
                place = places.to_numpy(zero_copy_only=False)[used].astype(np.int64)
                tf = tfs.to_numpy(zero_copy_only=False)[used]
                m = damping(sizes.to_numpy(zero_copy_only=False), n, length)[place]
                of = np.repeat(np.arange(len(lengths)), lengths)
                impact = worth[found[found >= 0]][of] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                postings = Postings(of * len(doc_ids) + place, impact, len(doc_ids), int(lengths.max()))
                ids = doc_ids.to_pylist()
                ends = np.cumsum(lengths)
                # Where the shard has each of the known terms.
                local = np.full(len(worth), -1, np.int64)
                local[found[found >= 0]] = np.arange(len(lengths))
                for number, (wanted, times) in enumerate(asked):
                    lists = local[wanted]
                    here = lists >= 0
                    if not here.any():
                        continue
                    lists = lists[here]
                    ranking = rankings.setdefault(number, Ranking(k))
                    search(postings, ids, lists, times[here], ends[lists] - lengths[lists], ends[lists], ranking)
        rows = [(number, doc_id, score) for number, ranking in rankings.items() for score, doc_id in ranking.rows()]
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], ["number", "doc_id", "score"])

    return searched


def query_blocks(texts: DataFrame, size: int = QUERY_BYTES) -> Iterator[list[tuple[str, str]]]:
    """Distinct query texts with their keys, in blocks of about ``size`` bytes, read one block at a time."""
    total = texts.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    count = max(1, -(-total // size))
    for number in range(count):
        block = texts if count == 1 else texts.where(F.pmod(F.xxhash64("text"), F.lit(count)) == number)
        yield sorted((r["key"], r["text"]) for r in block.collect())


def ranked(shards: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of an index for each of ``items`` (``item_id, text``).

    Equal texts are searched once. Equal scores go by doc_id, null last. An item
    without terms, or whose terms no document holds, has no rows; items that
    share an id are ranked one by one, repeated items once. Texts go to the
    tasks in blocks of bounded size.
    """
    spark = shards.sparkSession
    known = items.select("item_id", "text", F.sha2("text", 256).alias("key")).where("text IS NOT NULL").distinct()
    texts = written_table(known.select("key", "text").dropDuplicates(["key"]), "ranked-queries")
    total = shards.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("length")).first()
    n, length = total["n"] or 0, total["length"] or 0
    kinds = "number long, doc_id long, score long"
    found = spark.createDataFrame([], "key string, doc_id long, score long")
    for block in query_blocks(texts):
        queries = [counted_terms(text)[1] for _, text in block]
        terms = {term for query in queries for term in query}
        if not terms or not length:
            continue
        weights = {term: weight(n, df) for term, df in document_counts(shards, terms)}
        best = shards.mapInArrow(searching(queries, weights, n, length, k), kinds)
        keys = spark.createDataFrame(list(enumerate(key for key, _ in block)), "number long, key string")
        found = found.unionByName(best.join(F.broadcast(keys), "number").select("key", "doc_id", "score"))
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = written_table(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "ranked-top")
    return known.select("item_id", "key").join(top, "key").select("item_id", "rank", "doc_id", "score")


def document_counts(shards: DataFrame, terms: set[bytes]) -> list[tuple[bytes, int]]:
    """How many documents hold each of a block's terms; terms that none holds are left out."""
    spark = shards.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(bytearray(term),) for term in sorted(terms)], "term binary"))
    pairs = shards.select(F.explode(F.arrays_zip("terms", "counts")).alias("p")).select(F.col("p.terms").alias("term"), "p.counts")
    found = pairs.join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("counts").alias("df"))
    return sorted((bytes(r["term"]), r["df"]) for r in found.collect())


def query_terms(items: DataFrame) -> frozenset[bytes] | None:
    """The distinct terms of all items if they may be broadcast, else None."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                for words in term_parts(text.as_py()):
                    yield pa.RecordBatch.from_arrays([pa.array(sorted(set(words)), pa.binary())], ["term"])

    terms = written_table(items.select("text").mapInArrow(split, "term binary").distinct(), "ranked-terms")
    if not fits_broadcast(terms, size=BROADCAST_BYTES // 4):
        return None
    return frozenset(bytes(r["term"]) for r in terms.collect())


def rank(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` best rows of ``docs`` for each of ``items``; see ``ranked``.

    The index holds the terms of the items only, if these fit a broadcast, and
    all terms otherwise. To search the same documents often, keep ``index(docs)``.
    """
    return ranked(index(docs, query_terms(items)), items, k)
