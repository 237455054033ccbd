import re
from collections import defaultdict

import numpy as np
import pytest

from ledgerloom.llm import cube
from ledgerloom.llm.queries import op5_mixture


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight, what is over the top going to the others until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s] + 1e-9}
        if not over:
            return {s: share.get(s, most * sizes[s]) for s in names}
        capped |= over


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    folder = f"/root/testdata/{sf}"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op5_mixture(spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    sizes, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in rows:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", docs[r["doc_id"]]["text"] or ""))
        source = docs[r["doc_id"]]["source"]
        assert r["size"] == size and r["taken"] == r["copies"] * size and 0 <= r["taken"] <= 3 * size
        sizes[source] += size
        taken[source] += r["taken"]
        target[source] = r["target"]
        largest[source] = max(largest[source], size)
    want = plain_targets(sizes)
    for source in sizes:
        assert abs(target[source] - want[source]) < 1e-6 * max(1, want[source])
        assert abs(taken[source] - target[source]) <= largest[source]
    again = {(r["doc_id"], r["taken"]) for r in op5_mixture(spark, folder).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in rows}


def test_flight_keeps_both_sums():
    draw = np.random.default_rng(1)
    size, chance = draw.integers(0, 500, 400).astype(float), np.full(400, 0.37)
    out = cube.flight(chance, size, draw.random(400))
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert abs(out.sum() - chance.sum()) < 1e-6 and abs((out * size).sum() - (chance * size).sum()) < 1e-4
    landed = cube.land(out, size)
    assert set(landed) <= {0.0, 1.0} and abs((landed * size).sum() - (chance * size).sum()) <= 500


def test_chances_come_out_on_average():
    size = np.array([1.0, 5, 9, 2, 40, 3, 3, 3])
    draw = np.random.default_rng(2)
    mean = sum(cube.flight(np.full(8, 0.4), size, draw.random(8)) for _ in range(3000)) / 3000
    assert np.abs(mean - 0.4).max() < 0.04


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(cube, "BLOCK_ROWS", 8)
    docs = spark.range(600).selectExpr("id AS doc_id", "repeat('w ', cast(id % 17 as int)) AS text", "if(id % 3 = 0, 'a', 'b') AS source")
    rows = cube.mix(docs).collect()
    assert len(rows) == 600
    for source in "ab":
        own = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 16


def test_awkward_rows(awkward, nothing):
    rows = cube.mix(awkward).collect()
    assert len(rows) == 11 and {r["source"] for r in rows} == {"a", "b", "c", "\U0001f600", None}
    assert {r["target"] for r in rows if r["source"] in ("b", None)} == {0.0}
    out = cube.mixed_documents(awkward)
    assert out.columns == [*awkward.columns, "copies"]
    assert sum(r["copies"] for r in out.collect()) == sum(r["copies"] for r in rows)
    assert cube.mix(nothing).count() == 0 and cube.mixed_documents(nothing).count() == 0


def test_rows_that_many_share(spark, monkeypatch):
    monkeypatch.setattr(cube, "BLOCK_ROWS", 64)
    largest = []

    def written(df, name, write=cube.written_table):
        out = write(df, name)
        if name == "mix-settled":
            largest.append(out.groupBy("number", "block").count().agg({"count": "max"}).first()[0])
        if name == "mix-pieces":
            largest.append(out.groupBy("w0", "w1", "w2", "piece").count().agg({"count": "max"}).first()[0])
        return out

    monkeypatch.setattr(cube, "written_table", written)
    docs = spark.range(3000).selectExpr(
        "if(id < 2000, if(id < 1500, 7, null), id) AS doc_id",
        "if(id < 2000, 'one two three', repeat('w ', cast(id % 17 as int))) AS text",
        "if(id % 3 = 0, 'a', if(id % 3 = 1, 'b', null)) AS source",
        "id AS other",
    )
    rows = cube.mix(docs).collect()
    assert len(rows) == 3000 and max(largest) < 200
    for source in ("a", "b", None):
        own = [r for r in rows if r["source"] == source]
        assert len(own) == 1000 and abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 16
        shared = [r["copies"] for r in own if r["doc_id"] == 7]
        assert len(shared) == 500 and max(shared) - min(shared) <= 1
    out = cube.mixed_documents(docs).collect()
    assert max(largest) < 200 and len({r["other"] for r in out}) == len(out)

    def tally(found):
        return sorted((r["doc_id"] or 0, str(r["source"]), r["copies"]) for r in found if r["copies"])

    assert tally(out) == tally(rows)
