import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import graph, simhash
from ledgerloom.llm.queries import op2_simhash


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) > len(hashes) / 2)


def plain_classes(prints, bits=3):
    """The smallest position reachable from each, by all pairs."""
    prints = np.array(prints, dtype=np.uint64)
    label = list(range(len(prints)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= bits):
            a, b = find(i), find(int(j))
            label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_sets_cover_any_five_positions():
    from itertools import combinations

    sets = [set(s) for s in simhash.position_sets()]
    assert all(any(s <= set(five) for s in sets) for five in combinations(range(8), 5))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_all_pairs(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
    rows.sort(key=lambda r: r["doc_id"])
    prints = [plain_fingerprint(r["text"]) for r in rows]
    roots = plain_classes(prints)
    want = {r["doc_id"]: (f"{p:016x}", rows[root]["doc_id"]) for r, p, root in zip(rows, prints, roots)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op2_simhash(spark, f"/root/testdata/{sf}").collect()}
    assert got == want
    assert len(set(roots)) < len(roots)


@pytest.mark.parametrize("limit", [8, 40, 4096])
def test_long_lists_are_compared_in_blocks(spark, limit):
    draw = random.Random(3)
    centre = [draw.getrandbits(64) for _ in range(6)]
    prints = set()
    for c in centre:
        for _ in range(60):
            value = c
            for _ in range(draw.randrange(5)):
                value ^= 1 << draw.randrange(64)
            prints.add(value)
    prints |= {draw.getrandbits(64) for _ in range(100)}
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = spark.createDataFrame(signed, "fp long")
    roots = {r["node"]: r["root"] for r in graph.components(simhash.links(df, limit=limit)).collect()}
    got = [roots.get(p, p) for (p,) in signed]
    want = plain_classes(prints)
    by_class = {}
    for g, w in zip(got, want):
        assert by_class.setdefault(w, g) == g
    assert len(set(by_class.values())) == len(by_class)


def test_awkward_rows(awkward, nothing):
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == 11
    blank = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert {r["doc_id"] for r in blank} == {2, 3, 4} and {r["component_id"] for r in blank} == {2}
    assert {r["component_id"] for r in rows if r["doc_id"] in (5, 6)} == {5}
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    kept = simhash.keep_one_each(awkward)
    assert kept.columns == awkward.columns
    ids = sorted((r["doc_id"] or -1, r["text"]) for r in kept.where("doc_id <> 2 or doc_id is null").collect())
    assert [i for i, _ in ids] == [-1, 1, 5, 7, 7, 8]
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one_each(nothing).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(n, n + 1) for n in range(40)] + [(1000, n) for n in range(1001, 1100)] + [(7, 7), (None, 3)]
    roots = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert roots == {n: 0 for n in range(41)} | {n: 1000 for n in range(1000, 1100)}


def test_no_python_per_pair(spark, plan):
    text = plan(simhash.postings(spark.range(10).select(F.col("id").alias("fp"))))
    assert "Cartesian" not in text and "NestedLoop" not in text
