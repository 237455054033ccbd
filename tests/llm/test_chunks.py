import random

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import chunks


def chunk_spans(lines):
    """Chunks that count as passages, by the rule: an end after a long line, before one, or where two lines' hashes say so."""
    words = [len(line.split()) for line in lines]
    hashes = [xxhash.xxh64_intdigest(line) for line in lines]
    spans, begin = set(), 0
    for at in range(len(lines)):
        two = (hashes[at] + (hashes[at - 1] * chunks._BASE if at else 0)) % (1 << 64)
        size = at + 1 - begin
        ended = at + 1 == len(lines) or words[at] >= 40 or words[at + 1] >= 40
        if ended or size >= 2 and (two >> 32) % 2 == 0 or size >= 64:
            said = [w for w in words[begin : at + 1] if w]
            if len(said) >= 2 or (said and max(said) >= 40):
                spans.add((begin, at + 1))
            begin = at + 1
    return spans


def run_spans(lines):
    """Runs with 50 words, a word in their first and last line, that have fewer without the one or without the other."""
    words = [len(line.split()) for line in lines]
    spans = set()
    for i in range(len(lines)):
        if not words[i]:
            continue
        total = 0
        for j in range(i, len(lines)):
            total += words[j]
            if total >= 50:
                if words[j]:
                    spans.add((i, j + 1))
                break
    for j in range(len(lines)):
        if not words[j]:
            continue
        total = 0
        for i in range(j, -1, -1):
            total += words[i]
            if total >= 50:
                if words[i]:
                    spans.add((i, j + 1))
                break
    return spans


def plain(docs, runs=False):
    """The same removal with dictionaries: rows in order of id, first occurrence stays."""
    owner, count, spans, split = {}, {}, {}, {}
    for doc_id, text in docs:
        lines = split[doc_id] = text.encode().split(b"\n")
        spans[doc_id] = sorted(chunk_spans(lines) | (run_spans(lines) if runs else set()))
        for i, j in spans[doc_id]:
            held = b"\n".join(lines[i:j])
            count[held] = count.get(held, 0) + 1
            owner[held] = min(owner.get(held, doc_id), doc_id)
    out = {}
    for doc_id, lines in split.items():
        gone, first = set(), {}
        for i, j in spans[doc_id]:
            held = b"\n".join(lines[i:j])
            if count[held] > 1:
                kept_to = first.setdefault(held, j)
                if owner[held] != doc_id or i >= kept_to:
                    gone.update(range(i, j))
        out[doc_id] = b"\n".join(line for at, line in enumerate(lines) if at not in gone).decode()
    return out


@pytest.mark.parametrize("runs", [False, True])
def test_documents_against_dictionaries(spark, runs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()], runs)
    got = {r["doc_id"]: r["text"] for r in chunks.remove_repeated(docs, runs=runs).collect()}
    assert got == want
    assert sum(map(len, want.values())) < docs.agg(F.sum(F.length("text"))).first()[0]


def test_same_passages_without_a_broadcast(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    few, many = (sorted(map(tuple, chunks.repeated_passages(docs, n).collect())) for n in (0, 500_000))
    assert few == many and few


def test_passages_inside_other_text(spark):
    draw = random.Random(5)

    def line(words):
        return " ".join(f"w{draw.randrange(5000)}" for _ in range(words))

    one_line = line(60)
    many_lines = "\n".join(line(12) for _ in range(30))
    docs = []
    for n in range(30):
        around = [line(draw.randrange(4, 20)) for _ in range(draw.randrange(2, 8))]
        around.insert(draw.randrange(len(around)), one_line)
        around.insert(draw.randrange(len(around)), many_lines)
        docs.append((n, "\n".join(around), around))
    rows = chunks.remove_repeated(spark.createDataFrame([(n, t) for n, t, _ in docs], "doc_id long, text string"), counts=True)
    got = {r["doc_id"]: r for r in rows.collect()}
    assert one_line in got[0]["text"] and many_lines in got[0]["text"]
    shared = set(many_lines.split("\n"))
    for n, _, around in docs[1:]:
        left = got[n]["text"].split("\n")
        assert one_line not in left
        # All but the chunks that the passage shares with its neighbours are gone.
        assert sum(1 for x in left if x in shared) <= 12
        assert all(x in left for x in around if x != one_line and x != many_lines)
        assert got[n]["removed_lines"] + len(left) == len(docs[n][1].split("\n")) or not left


def test_boundaries_shift_with_the_text():
    draw = random.Random(1)
    lines = [f"line {draw.random()}".encode() for _ in range(300)]
    ends, _ = chunks.chunk_ends(lines)
    moved, _ = chunks.chunk_ends([b"new first line", b"and another"] + lines)
    assert len(set(ends) - {end - 2 for end in moved}) <= 2


@pytest.mark.parametrize("runs", [False, True])
def test_awkward_rows(awkward, nothing, runs):
    out = chunks.remove_repeated(awkward, runs=runs)
    assert out.columns == awkward.columns and out.count() == 11
    rows = {r["doc_id"]: r["text"] for r in out.where("doc_id <> 7").collect()}
    assert rows[2] is None and rows[3] == "" and rows[4] == " \n\t\n "
    assert rows[5].count("\n") == 3999 and rows[6].count("\n") <= 1
    assert chunks.remove_repeated(nothing, runs=runs).count() == 0


def test_equal_rows_stay_equal(spark):
    text = "first line of it\nsecond line of it\nthird line of it\nfourth line of it"
    df = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text)], "doc_id long, text string")
    rows = sorted((r["doc_id"] or 99, r["text"]) for r in chunks.remove_repeated(df).collect())
    assert rows[0] == rows[1] and rows[2][1] == rows[3][1]
    assert len(rows[2][1]) < len(text)


def equal_runs(docs):
    """Lines that a search of all runs of ``PASSAGE_WORDS`` finds again in an earlier document, or earlier in their own."""
    texts = [text.split("\n") for _, text in sorted(docs)]
    gone = [set() for _ in texts]
    for n, lines in enumerate(texts):
        for m in range(n + 1):
            for i in range(len(lines)):
                for j in range(len(texts[m]) if m < n else i):
                    words = size = 0
                    while i + size < len(lines) and j + size < (len(texts[m]) if m < n else i) and lines[i + size] == texts[m][j + size]:
                        words += len(lines[i + size].split())
                        size += 1
                    if words >= chunks.PASSAGE_WORDS:
                        gone[n].update(range(i, i + size))
    return [[line for k, line in enumerate(lines) if k not in gone[n]] for n, lines in enumerate(texts)]


def test_short_passages_against_all_equal_runs(spark):
    draw = random.Random(11)

    def lines(count, words):
        cuts = [0, *sorted(draw.sample(range(1, words), count - 1)), words]
        return [" ".join(f"w{draw.randrange(10**6)}" for _ in range(b - a)) for a, b in zip(cuts, cuts[1:])]

    passages = [p for n in range(2, 9) for p in (lines(n, draw.randrange(51, 101)) for _ in range(8)) if max(len(x.split()) for x in p) < 40]
    docs, foreign = [], lambda: lines(3, 24)
    for n in range(60):
        text = foreign()
        for passage in draw.sample(passages, 4):
            text += passage + foreign()
        docs.append((n, "\n".join(text)))
    docs.append((60, "\n".join(passages[0] + foreign() + passages[0])))
    # The same line over and over: one passage of it stays.
    docs.append((61, "\n".join(["w0 w1 w2 w3 w4 w5 w6 w7 w8 w9"] * 40)))
    want = equal_runs(docs[:61])
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["text"].split("\n") for r in chunks.remove_repeated(df, runs=True).collect()}
    assert [got[n] for n in range(61)] == want
    assert len(got[61]) <= 5 and sum(map(len, want)) < sum(text.count("\n") + 1 for _, text in docs[:61])
    few, many = (sorted(map(tuple, chunks.repeated_passages(df, n, runs=True).collect())) for n in (0, 500_000))
    assert few == many and few


def test_places_of_equal_rows_count_once(spark, monkeypatch):
    most = []

    def written(df, name, write=chunks.written_table):
        out = write(df, name)
        if name == "chunk-places":
            most.append(out.agg(F.max(F.size("places"))).first()[0])
        return out

    monkeypatch.setattr(chunks, "written_table", written)
    text = "\n".join(f"line {n} of a text that many rows have" for n in range(20))
    df = spark.range(600).selectExpr("if(id < 500, 1, id) AS doc_id").withColumn("text", F.lit(text)).repartition(8)
    rows = chunks.remove_repeated(df, runs=True).collect()
    assert len(rows) == 600 and most[0] <= 60
    assert all((r["text"] == text) == (r["doc_id"] == 1) for r in rows)


def test_texts_that_are_shuffled_or_not_come_out_the_same(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    few, many = (sorted(map(tuple, chunks.remove_repeated(docs, True, True, n).collect())) for n in (0, 500_000))
    assert few == many and any(row[-1] for row in few) and not all(row[-1] for row in few)
