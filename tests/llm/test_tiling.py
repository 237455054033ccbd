import random
import re

import numpy as np
import pytest

from ledgerloom.llm import tiling


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def plain_tiles(a, b, k):
    """Greedy string tiling by its definition: the longest unmarked match, leftmost first, until none has k tokens."""
    used_a, used_b, total = [False] * len(a), [False] * len(b), []
    while True:
        best = (k - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not used_a[i + n] and not used_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < k:
            return total
        n, i, j = best
        used_a[i : i + n] = [True] * n
        used_b[j : j + n] = [True] * n
        total.append((i, j, n))


def windows(tokens, k):
    """A number for each window of ``k`` tokens, equal for equal windows."""
    return np.array([sum(ord(t) * 1000**n for n, t in enumerate(tokens[i : i + k])) for i in range(len(tokens) - k + 1)], np.uint64)


@pytest.mark.parametrize("pairs", [1, 7, 1 << 20])
def test_tiles_by_definition(monkeypatch, pairs):
    monkeypatch.setattr(tiling, "PAIRS", pairs)
    draw = random.Random(pairs)
    for _ in range(150):
        letters = draw.choice(["a", "ab", "abc"])
        a = [draw.choice(letters) for _ in range(draw.randrange(5, 40))]
        b = [draw.choice(letters) for _ in range(draw.randrange(5, 25))]
        k = draw.randrange(2, 5)
        i, j, n = tiling.matches(windows(a, k), windows(b, k))
        got = tiling.tiles(i, j, n + k - 1, k, len(a), len(b))
        assert [n for _, _, n in got] == [n for _, _, n in plain_tiles(a, b, k)]
        assert all(a[x : x + n] == b[y : y + n] for x, y, n in got)
        assert sum(n for *_, n in got) == len({x + d for x, _, n in got for d in range(n)}) == len({y + d for _, y, n in got for d in range(n)})


def texts_of(text):
    raw = tiling.folded(text).encode()
    starts, ends, _ = tiling.tokens(np.frombuffer(raw + b"\n", np.uint8))
    return [raw[a:b].decode() for a, b in zip(starts, ends)]


def test_scripts_without_blanks_have_a_token_per_character():
    assert texts_of("Hello, wörld 42") == ["hello", "wörld", "42"]
    assert texts_of("北京是首都。Tokyo東京x") == [*"北京是首都", "tokyo", *"東京", "x"]
    assert texts_of("ภาษาไทย ok") == [*"ภาษาไทย", "ok"]
    assert texts_of("「かな」，カナ！𠀋𠀋") == [*"かなカナ𠀋𠀋"]
    assert texts_of("한국어 낱말") == ["한국어", "낱말"]
    assert texts_of("中") == ["中"] and texts_of("") == []


def test_short_items_and_unspaced_scripts(spark):
    bench = [(1, "Quux zork?"), (2, "法国的首都是巴黎吗"), (3, "。、"), (4, "blorp")]
    docs = [(1, "say quux, zork and go"), (2, "quux then zork"), (3, "请问法国的首都是巴黎吗？谢谢"), (4, "法国有首都"), (5, "nothing"), (6, "BLORP!"), (7, "blorps")]
    found = tiling.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    assert {r["doc_id"]: r["item_ids"] for r in found.collect()} == {1: [1], 3: [2], 6: [4]}


def test_spans_are_those_of_the_text(spark):
    text = "İİİ İstanbul ẞ K alpha Beta GAMMA delta epsilon, zeta İ end"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta")], "item_id long, text string")
    (span,) = tiling.contaminated(docs, bench).first()["hits"][0]["spans"]
    assert text.encode()[span["begin"] : span["end"]].decode() == "alpha Beta GAMMA delta epsilon, zeta"


def test_a_word_over_and_over_stays_within_bounds():
    import tracemalloc

    groups = tiling.index_items([1, 2], ["word " * 160, "word other " * 80])
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["word " * 2_000_000])], ["scan_text"])
    tracemalloc.start()
    (out,) = list(tiling.scanning(groups, 0.5)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    (hits,) = out.column("hits").to_pylist()
    assert [(h["item_id"], h["coverage"], len(h["spans"])) for h in hits] == [(1, 1.0, 1)]
    assert peak < 500e6, peak


def test_table_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = {r["item_id"]: words(r["text"]) for r in bench.collect()}
    want = {}
    k = tiling.SEED_TOKENS
    for row in docs.collect():
        doc = words(row["text"])
        seeds = {tuple(doc[i : i + k]) for i in range(len(doc) - k + 1)}
        for item, tokens in items.items():
            if any(tuple(tokens[j : j + k]) in seeds for j in range(len(tokens) - k + 1)):
                share = sum(n for *_, n in plain_tiles(doc, tokens, k)) / len(tokens)
                if share >= tiling.THRESHOLD:
                    want.setdefault(row["doc_id"], {})[item] = round(share, 9)
    got = {
        r["doc_id"]: {h["item_id"]: round(h["coverage"], 9) for h in r["hits"]}
        for r in tiling.contaminated(docs, bench).collect()
    }
    assert got == want and want


def reordered(spark):
    sentences = [f"alpha{n} beta{n} gamma{n} delta{n} epsilon{n} zeta{n} eta{n}" for n in range(6)]
    bench = [(1, ". ".join(sentences)), (2, "two words"), (3, None), (4, ""), (None, "no id but quite a few tokens to find here")]
    draw = random.Random(4)
    mixed = sentences[:]
    draw.shuffle(mixed)
    docs = [
        (10, "before it. " + ", ".join(mixed).upper() + " after it", "x"),
        (11, " ".join(sentences[:2]) + " filler" * 40, "x"),
        (12, "nothing in common with it at all", "x"),
        (13, None, "x"),
        (14, "", "x"),
        (15, "so: No id but quite a few tokens to find here!", "x"),
        (16, "these are two words", "x"),
        (None, ". ".join(sentences), "x"),
    ]
    return spark.createDataFrame(docs, "doc_id long, text string, hits string"), spark.createDataFrame(bench, "item_id long, text string")


def test_reordered_passages(spark):
    docs, bench = reordered(spark)
    got = {r["doc_id"]: (r["item_ids"], r["coverage"]) for r in tiling.contaminated(docs, bench).collect()}
    assert got == {10: ([1], 1.0), None: ([1], 1.0), 15: ([-1], 1.0), 16: ([2], 1.0)}
    kept = tiling.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [11, 12, 13, 14]


def test_blocks_of_a_large_benchmark_give_the_same(spark, monkeypatch):
    docs, bench = reordered(spark)
    want = sorted(map(str, tiling.contaminated(docs, bench).select("doc_id", "item_ids", "coverage").collect()))
    original = tiling.query_blocks
    monkeypatch.setattr(tiling, "query_blocks", lambda benchmark: original(benchmark, 40))
    assert sorted(map(str, tiling.contaminated(docs, bench).select("doc_id", "item_ids", "coverage").collect())) == want


def test_empty_tables(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, "the cat sat on the mat today")], "item_id long, text string")
    assert tiling.remove_contaminated(nothing, bench).count() == 0
    assert tiling.remove_contaminated(awkward, bench.limit(0)).count() == 11
    assert tiling.remove_contaminated(awkward, bench).count() == 10
