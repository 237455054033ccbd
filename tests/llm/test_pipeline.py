import re

import corpus_pipeline
from ledgerloom.llm import chunks, crf, cube, rules, simhash, tiling  # noqa: F401
from tests.llm.test_chunks import plain as plain_chunks
from tests.llm.test_rules import plain as plain_measures
from tests.llm.test_simhash import plain_classes, plain_fingerprint

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    bench = [re.findall(r"\w+", r["text"].lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "decontaminate", "mix"]
    before = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written_table(stage(spark, docs, SF), f"test-{name}")
        after = {r["doc_id"]: r for r in docs.collect()}
        assert len(after) == docs.count() and set(after) <= set(before)
        assert docs.columns == columns + ["copies"] * (name == "mix")
        if name == "quality_rules":
            def passes(text):
                n, chars, symbols, _, _, repeats, upper, letters = plain_measures(text)
                return n >= 50 and repeats * 2 <= n and 10 * symbols <= n and 10 * upper <= 4 * letters and 2 * n <= chars <= 25 * n

            assert set(after) == {k for k, r in before.items() if passes(r["text"])}
        if name == "line_dedup":
            want = {k: t for k, t in plain_chunks([(k, r["text"]) for k, r in before.items()], True).items() if t.strip()}
            assert {k: r["text"] for k, r in after.items()} == want
            assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        if name == "near_dedup":
            ids = sorted(before)
            roots = plain_classes([plain_fingerprint(before[k]["text"]) for k in ids])
            assert set(after) == {ids[n] for n in roots}
        if name == "decontaminate":
            def holds(text):
                tokens = " ".join(re.findall(r"\w+", text.lower()))
                return any(f" {' '.join(item)} " in f" {tokens} " for item in bench)

            assert not any(holds(r["text"]) for r in after.values())
            assert all(holds(before[k]["text"]) for k in set(before) - set(after))
        if name == "mix":
            assert all(1 <= r["copies"] <= 3 for r in after.values())
        before = after


def test_awkward_tables(spark, awkward, nothing, tmp_path):
    spark.createDataFrame([(1, "the cat sat on the mat today")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (awkward, nothing):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            out.collect()
            assert out.columns[: len(docs.columns)] == docs.columns
