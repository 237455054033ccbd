import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import ranked
from ledgerloom.llm.queries import op13_ranked_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranks_by_definition(docs, items, k=10):
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    n, length = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(term for _, c in counted for term in c)
    out = set()
    for item_id, text in set(items):
        if text is None:
            continue
        scored = []
        for doc_id, c in counted:
            m = 100 - 75 + 75 * sum(c.values()) * n // length if length else 0
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text)
                if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out |= {(item_id, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)}
    return out


def collected(df):
    rows = [tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def drawn(seed, n, words=40):
    chance = random.Random(seed)
    said = [f"w{int(words * chance.random() ** 2)}" for _ in range(4000)]
    return [" ".join(chance.choices(said, k=chance.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("leaf", [0, 5, 1024])
def test_search_by_definition(spark, monkeypatch, leaf):
    """Intervals split to the end, to short ones, and hardly at all; many ties, as half of the documents are copies."""
    monkeypatch.setattr(ranked, "LEAF_POSTINGS", leaf)
    monkeypatch.setattr(ranked, "SHARD_DOCS", 70)
    texts = drawn(leaf, 150)
    docs = list(enumerate(texts)) + [(1000 - at, text) for at, text in enumerate(texts)]
    items = list(enumerate(drawn(leaf + 1, 12)))
    found = collected(ranked.rank(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")))
    assert found == ranks_by_definition(docs, items)


def test_largest_in_range():
    chance = np.random.default_rng(3)
    for _ in range(40):
        lengths = chance.integers(1, 30, 4)
        impact = chance.integers(0, 5, lengths.sum())
        ends = np.cumsum(lengths)
        key = np.concatenate([at * 100 + np.sort(chance.choice(100, size, replace=False)) for at, size in enumerate(lengths)])
        held = ranked.Postings(key, impact, 100, int(lengths.max()))
        begin = np.array([chance.integers(e - s, e) for s, e in zip(lengths, ends)])
        end = np.array([chance.integers(b + 1, e + 1) for b, e in zip(begin, ends)])
        assert [impact[at] for at in held.largest(begin, end)] == [impact[b:e].max() for b, e in zip(begin, end)]


def test_less_is_scored_than_searched(monkeypatch):
    """Where few documents hold the query together, bounds leave most of the intervals alone."""
    chance = random.Random(5)
    shard = ranked.Shard()
    for at in range(5000):
        words = ["abcdefg"[at // 715]] * 3 if at % 500 else list("abcdefg") * 3
        shard.add(at, len(words), Counter(w.encode() for w in words))
    monkeypatch.setattr(ranked, "LEAF_POSTINGS", 64)
    seen = []
    whole = ranked.score_all
    monkeypatch.setattr(ranked, "score_all", lambda *a: (seen.append(int((a[5] - a[4]).sum())), whole(*a)))
    weights = {w.encode(): 100 for w in "abcdefg"}
    out = list(ranked.searching([Counter(w.encode() for w in "abcdefg")], weights, 5000, 15_000, 10)(iter([shard.batch()])))
    assert sorted(out[0].column("doc_id").to_pylist()) == list(range(0, 5000, 500))
    assert sum(seen) < shard.postings / 4, (sum(seen), shard.postings)


def test_stretches_and_bytes(monkeypatch):
    monkeypatch.setattr(ranked, "STRETCH", 3)
    chance = random.Random(8)
    letters = ["a", "B", "Z", "9", " ", "-", "_", "\x00", "\x1c", "\x7f", "\x85", "\xa0", "é", "İ", "中", "　", "\U0001f600", "\n"]
    for _ in range(2000):
        text = "".join(chance.choices(letters, k=chance.randint(0, 30)))
        size, counts = ranked.counted_terms(text)
        assert size == len(terms(text)) and counts == Counter(t.encode() for t in terms(text))


def test_whole_numbers_do_not_overflow():
    sizes = np.array([10**12, 5, 10**12], np.int64)
    assert ranked.damping(sizes, 10**11, 10**14).tolist() == [25 + 75 * s * 10**11 // 10**14 for s in sizes.tolist()]


def test_blocks_and_whole_indexes_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(drawn(21, 80))), "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate(drawn(22, 15))), "item_id long, text string")
    once = collected(ranked.rank(docs, items, 4))
    monkeypatch.setattr(ranked, "QUERY_BYTES", 300)
    monkeypatch.setattr(ranked, "BROADCAST_BYTES", 4)
    assert ranked.query_terms(items) is None
    assert collected(ranked.rank(docs, items, 4)) == once


def test_awkward_rows(spark, awkward, nothing):
    items = [(1, "the CAT"), (1, "the cat"), (2, None), (3, ""), (None, "words, very long"), (4, "same row twice same"), (4, "same row twice same"), (5, "zzz"), (6, "中文 é")]
    asked = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, doc_id string, score int")
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    rows = [tuple(r) for r in ranked.rank(awkward, asked).collect()]
    assert set(rows) == ranks_by_definition(docs, items)
    assert ranked.rank(nothing, asked).count() == 0
    assert ranked.rank(awkward, asked.limit(0)).count() == 0


def test_one_very_long_text(spark):
    docs = [(1, "word " * 700_000 + "x" * 3_000_000), (2, "word other"), (3, "nothing")]
    items = [(1, "word other")]
    found = ranked.rank(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert collected(found) == ranks_by_definition(docs, items)


def test_query_by_definition(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert collected(op13_ranked_search(spark, folder)) == ranks_by_definition(docs, items)
