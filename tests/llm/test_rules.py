import re
from collections import Counter

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import rules


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + d for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for d in range(3)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines),
        len(lines) - len(set(lines)),
        len(covered),
        len(re.findall("[A-Z]", text or "")),
        len(re.findall("[A-Za-z]", text or "")),
    )


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "a b c", "\n", " ", "\t", " ", "#", "é", "\U0001f600", "X|", "\x0b", "\x85"])).map(" ".join))
def test_measures(text):
    assert rules.measures(text) == plain(text)


def test_measures_of_the_table(documents):
    for row in documents.collect():
        assert rules.measures(row["text"]) == plain(row["text"])


def test_awkward_rows(awkward, nothing):
    rows = rules.ledger(awkward)
    assert rows.count() == 11 and rules.ledger(nothing).count() == 0
    assert rows.where("doc_id = 2").first()["fail_bits"] & 1
    kept = rules.filter_documents(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == 0
    clean = " ".join(f"word{n}" for n in range(60))
    more = awkward.union(awkward.where("doc_id = 5").withColumn("text", F.lit(clean)))
    assert [r["text"] for r in rules.filter_documents(more).collect()] == [clean]
    assert rules.filter_documents(nothing).count() == 0


def test_policies_and_ablations(documents):
    rows = rules.ledger(documents).cache()
    bits = [r["fail_bits"] for r in rows.collect()]
    for version in rules.POLICIES:
        mask = rules.mask(version)
        assert rows.where(rules.passes("fail_bits", version)).count() == sum(1 for b in bits if not b & mask)
        for row in rules.ablations(rows, version).collect():
            bit = 1 << list(rules.RULES).index(row["rule"])
            assert row["n_failed"] == sum(1 for b in bits if b & bit)
            assert row["n_only"] == sum(1 for b in bits if b & mask == bit)
            assert row["n_kept_without"] == sum(1 for b in bits if not b & mask & ~bit)
    rows.unpersist()


def test_clean_documents_stay(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = rules.ledger(docs).join(labels, "doc_id").withColumn("kept", rules.passes("fail_bits"))
    good = rows.where((F.col("quality") == 1) & rules.passes("fail_bits", rules.BASE_POLICY))
    assert good.where("NOT kept").count() == 0
    assert rows.where("quality = 0 AND kept").count() == 0
