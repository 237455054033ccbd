import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import crf, mil
from ledgerloom.llm.queries import op4_quality_lines, op10_toxicity
from ledgerloom.llm.samples import held_out, labelled

SF = "/root/testdata/sf0.01"


def held_out_figures(spark, query, label, folder):
    rows = query(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    scores = [(r["score"], r[label], r["predicted"]) for r in rows]
    good = [s for s, y, _ in scores if y]
    bad = [s for s, y, _ in scores if not y]
    area = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    return area, sum(p == y for _, y, p in scores) / len(scores)


def test_quality_on_held_out_documents(spark):
    area, right = held_out_figures(spark, op4_quality_lines, "quality", SF)
    assert area > 0.97 and right > 0.93


def test_toxicity_on_held_out_documents(spark):
    area, right = held_out_figures(spark, op10_toxicity, "toxic", "/root/testdata/sf0.1")
    assert area > 0.97 and right > 0.96


def test_fold(spark):
    rows = spark.range(200).select(F.col("id"), held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)
    assert not spark.sql("SELECT CAST(NULL AS LONG) AS doc_id").select(held_out().alias("h")).first()["h"]


def test_sample_is_bounded_and_out_of_the_fold(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    ids = [r["doc_id"] for r in labelled(docs, labels, "quality", 50).collect()]
    assert len(ids) == 50 and all(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids)


def test_forward_backward_against_all_paths():
    draw = np.random.default_rng(0)
    first = np.array([0, 3, 4, 9])
    scores, transitions = draw.normal(size=9), draw.normal(size=(2, 2))
    good, moved = crf.marginals(scores, first, transitions)
    want, want_moved = np.zeros(9), np.zeros((2, 2))
    for a, b in zip(first, first[1:]):
        paths = {}
        for path in itertools.product((0, 1), repeat=b - a):
            value = sum(scores[a + t] * y for t, y in enumerate(path)) + sum(transitions[x, y] for x, y in zip(path, path[1:]))
            paths[path] = math.exp(value)
        total = sum(paths.values())
        for path, weight in paths.items():
            for t, y in enumerate(path):
                want[a + t] += y * weight / total
            for x, y in zip(path, path[1:]):
                want_moved[x, y] += weight / total
    assert np.allclose(good, want) and np.allclose(moved, want_moved)


def test_line_features_do_not_cross_texts():
    alone, _, _ = crf.line_features([b"one two\nTHREE!! ###"])
    among, _, first = crf.line_features([b"x y z", b"one two\nTHREE!! ###", b"", b"q"])
    assert np.allclose(alone, among[first[1] : first[2]]) and first.tolist() == [0, 1, 3, 4, 5]


def test_noisy_or_finds_the_sentence(spark):
    toxic = [(n, f"Fine words {n} here. You utter scum of number {n}! More fine words.", 1) for n in range(40)]
    fine = [(n, f"Fine words {n} here. You utter friend of number {n}! More fine words.", 0) for n in range(100, 180)]
    docs = spark.createDataFrame(toxic + fine, "doc_id long, text string, toxic int")
    model = mil.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    text = "Nothing at all. SCUM, I say. Nothing again."
    row = mil.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert [text[o["begin"] : o["end"]] for o in row["offending"]] == ["SCUM, I say"]
    longer = "İzmir İİİ Kelvin K. SCUM, İ say. Nothing again."
    row_of_longer = mil.score(spark.createDataFrame([(1, longer)], "doc_id long, text string"), model).first()
    assert [longer.encode()[o["begin"] : o["end"]].decode() for o in row_of_longer["offending"]] == ["SCUM, İ say"]
    whole = 1 - math.prod(1 - 1 / (1 + math.exp(-s)) for s in mil.sentence_scores(mil.sentences([text.lower().encode()]), model))
    assert abs(row["score"] - whole) < 1e-9


@pytest.mark.parametrize("operator", [crf, mil])
def test_awkward_rows(spark, awkward, nothing, operator):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (5, 0, 1), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    rows = operator.classify(awkward, labels).collect()
    assert len(rows) == 11 and all(0 <= r["score"] <= 1 for r in rows)
    assert operator.classify(nothing, labels).count() == 0
    assert operator.classify(awkward, labels.limit(0)).count() == 11


def test_sample_has_one_row_for_each_id(spark):
    docs = spark.range(900).selectExpr(
        "id % 30 AS doc_id", "if(id % 30 = 4 or id < 30, null, concat('text ', id % 7)) AS text"
    )
    labels = spark.range(30).selectExpr("id AS doc_id", "int(id % 2) AS quality")
    rows = labelled(docs.repartition(5), labels, "quality", 20).collect()
    ids = [r["doc_id"] for r in rows]
    assert 0 < len(ids) == len(set(ids)) <= 20
    assert all((r["text"] is None) == (r["doc_id"] == 4) and r["label"] == r["doc_id"] % 2 for r in rows)
    again = labelled(docs.repartition(3), labels, "quality", 20).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, rows), key=str)


def test_long_texts_are_scored_in_stretches_as_at_once(monkeypatch):
    import pyarrow as pa

    draw = np.random.default_rng(9)
    kinds = ["a plain line of words", "SHOUT | SHOUT !!", "", "12 34 56", "x"]
    texts = ["\n".join(draw.choice(kinds, n)) for n in (1, 2, 7, 8, 9, 16, 100, 333)] + ["", None, "\n\n"]
    field = crf.Field(draw.normal(size=crf.FEATURES) * 3, draw.normal(size=(2, 2)) * 2)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])

    def scores():
        (out,) = list(crf.scoring(field, True)(iter([batch])))
        return np.array(out.column("score").to_pylist()), [np.array(x) for x in out.column("lines_good").to_pylist()]

    whole, lines = scores()
    monkeypatch.setattr(crf, "LINES", 8)
    parts, again = scores()
    assert np.allclose(whole, parts, atol=1e-12)
    assert all(np.allclose(a, b, atol=1e-12) for a, b in zip(lines, again))


def test_one_letter_lines_stay_within_bounds():
    """A hundred bytes a line at most, beside what a stretch takes."""
    import tracemalloc

    import pyarrow as pa

    field = crf.Field(np.linspace(-1, 1, crf.FEATURES), np.zeros((2, 2)))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a\n" * 400_000])], ["doc_id", "text"])
    tracemalloc.start()
    (out,) = list(crf.scoring(field, False)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 < out.column("score")[0].as_py() < 1 and peak < 100e6, peak
