import re

import numpy as np
import pytest

from ledgerloom.llm import licenses
from ledgerloom.llm.queries import op6_licenses


def test_lines_of_the_table(spark):
    folder = "/root/testdata/sf0.1"
    got = {(r["doc_id"], r["license"]) for r in op6_licenses(spark, folder).where("coverage = 1").collect()}
    want = set()
    for row in spark.read.parquet(f"{folder}/documents.parquet").collect():
        tokens = " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", row["text"].lower()))
        for name, template in licenses.TEMPLATES.items():
            if f" {' '.join(re.findall('[0-9a-z]+', template.lower()))} " in f" {tokens} ":
                want.add((row["doc_id"], name))
    assert got == want and want


def test_changed_statement(spark):
    grant = licenses.TEMPLATES["MIT-grant"]
    changed = grant.replace("sublicense, ", "").replace("any person obtaining", "any one person now obtaining")
    text = "Head of it.\n" + changed + "\nand " + licenses.TEMPLATES["MIT-line"] + " tail. " + licenses.TEMPLATES["MIT-line"]
    docs = spark.createDataFrame([(1, text), (2, grant[:80])], "doc_id long, text string")
    rows = licenses.scan(docs).collect()
    assert sorted((r["doc_id"], r["license"]) for r in rows) == [(1, "MIT-grant"), (1, "MIT-line"), (1, "MIT-line")]
    row = next(r for r in rows if r["license"] == "MIT-grant")
    assert 0.9 < row["coverage"] < 1 and len(row["spans"]) >= 3
    assert text[row["begin"] : row["end"]] == changed


def test_alignment_against_full_table():
    draw = np.random.default_rng(3)
    for _ in range(40):
        a, b = draw.integers(0, 6, 12), draw.integers(0, 6, 18)
        table = np.zeros((13, 19), int)
        for i in range(12):
            for j in range(18):
                table[i + 1, j + 1] = max(table[i, j + 1], table[i + 1, j], table[i, j] + 1 if a[i] == b[j] else 0)
        pairs = licenses.align(a, b, 0, 20)
        assert len(pairs) == table[-1, -1]
        assert all(a[i] == b[j] for i, j in pairs) and pairs == sorted(pairs)
        assert len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)


def test_short_templates_are_refused():
    with pytest.raises(ValueError):
        licenses.index_templates({"short": "All rights reserved."})


def test_awkward_rows(awkward, nothing):
    assert licenses.scan(awkward).count() == 0 and licenses.scan(nothing).count() == 0
    assert licenses.scan(awkward).columns == ["doc_id", "license", "coverage", "begin", "end", "spans"]


def all_alignments(doc, index):
    """Document tokens of every alignment that has the coverage, of every template at every offset."""
    for number, wanted in enumerate(index.hashes):
        band = max(4, len(wanted) // 5)
        for offset in range(-len(wanted) - band, len(doc) + band):
            begin = max(0, offset - band)
            pairs = licenses.align(wanted, doc[begin : max(0, offset + len(wanted) + band + 1)], offset - begin, band)
            if len(pairs) >= licenses.COVERAGE * len(wanted):
                yield number, {begin + j for _, j in pairs}


def test_changed_statements_against_aligning_everywhere():
    templates = {name: text for name, text in licenses.TEMPLATES.items() if len(text) < 200}
    index = licenses.index_templates(templates)
    draw = np.random.default_rng(4)
    found = changed = 0
    for _ in range(60):
        doc = draw.integers(1, 1 << 60, 8).tolist()
        for number in draw.integers(0, len(templates), 2):
            tokens = index.hashes[number].tolist()
            for _ in range(int(draw.integers(0, 1 + len(tokens) // 4))):
                at, kind = int(draw.integers(len(tokens))), draw.integers(4)
                tokens[at : at + (kind > 0)] = [] if kind == 1 else draw.integers(1, 1 << 60, 1).tolist()
            doc += tokens + draw.integers(1, 1 << 60, int(draw.integers(0, 6))).tolist()
        doc = np.array(doc, np.uint64)
        got = [(t, {k for a, b in runs for k in range(a, b + 1)}) for t, share, runs in licenses.find(doc, index)]
        for number, places in all_alignments(doc, index):
            assert any(t == number and places & own for t, own in got)
            found, changed = found + 1, changed + (len(places) < len(index.hashes[number]))
        assert all(any(t == n and own & p for n, p in all_alignments(doc, index)) for t, own in got)
    assert found > changed > 50


def test_one_word_replaced_anywhere(spark):
    docs, want = [], set()
    for name in ("MIT-line", "CC-BY-NC-4.0-line", "Apache-2.0-line"):
        words = re.findall("[A-Za-z0-9]+", licenses.TEMPLATES[name])
        for at in range(len(words)):
            want.add((len(docs), name))
            docs.append((len(docs), "Head of it. " + " ".join([*words[:at], "quux", *words[at + 1 :]]) + " tail"))
    rows = licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert want <= {(r["doc_id"], r["license"]) for r in rows}


def changed_at(draw, tokens, places):
    """The tokens with something lacking, foreign or both at so many places."""
    out = list(tokens)
    for at in sorted(draw.choice(len(tokens), places, replace=False).tolist(), reverse=True):
        kind = draw.integers(3)
        out[at : at + (kind < 2)] = [] if kind == 0 else draw.integers(1, 1 << 60, int(draw.integers(1, 4))).tolist()
    return out


def test_statements_within_the_guarantee_share_a_fingerprint():
    index = licenses.index_templates(licenses.TEMPLATES)
    draw = np.random.default_rng(5)
    kept = 0
    for number, wanted in enumerate(index.hashes):
        own = index.needed[number]
        for _ in range(150):
            doc = changed_at(draw, wanted.tolist(), int(licenses.CHANGED * len(wanted)))
            if len(set(doc) & set(wanted.tolist())) == 0 or len(licenses.align(wanted, doc, 0, len(doc) + len(wanted))) < own:
                continue
            kept += 1
            doc = np.array([*draw.integers(1, 1 << 60, 5).tolist(), *doc, *draw.integers(1, 1 << 60, 5).tolist()], np.uint64)
            hits = [np.concatenate([p.template[a:b] for a, b in zip(low, high)]) for p, _, low, high in licenses.shared_fingerprints(doc, index) if len(low)]
            assert any(number in found for found in hits), index.names[number]
    assert kept > 1000


def test_gram_and_window_fit_the_longest_run():
    for size in range(licenses.FEWEST_TOKENS, 400):
        needed = -(-4 * size // 5)
        k, window = licenses.gram_and_window(size, needed)
        assert k >= 1 and window >= 1 and (k + window - 2) * (size // 4 + 1) < needed


def test_winnowing_by_definition():
    draw = np.random.default_rng(6)
    for _ in range(200):
        values, window = draw.integers(0, 6, int(draw.integers(0, 15))).astype(np.uint64), int(draw.integers(1, 6))
        want = set()
        for start in range(max(1, len(values) - window + 1) if len(values) else 0):
            part = values[start : start + window].tolist()
            want.add(start + max(k for k, v in enumerate(part) if v == min(part)))
        assert licenses.winnowed(values, window).tolist() == sorted(want)


def test_bodies_with_a_tenth_of_their_words_changed(spark):
    draw = np.random.default_rng(7)
    docs, want = [], set()
    for name, text in licenses.BODIES.items():
        for _ in range(4):
            words = text.split()
            for at in draw.choice(len(words), len(words) // 10, replace=False):
                words[at] = "quux"
            want.add((len(docs), name))
            docs.append((len(docs), "İstanbul Head of it. " + " ".join(words) + "\nand what follows " * 30))
    rows = licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert want <= {(r["doc_id"], r["license"]) for r in rows}
    texts = dict(docs)
    for r in rows:
        if (r["doc_id"], r["license"]) in want:
            raw = texts[r["doc_id"]].encode()
            begin, end = len("İstanbul Head of it. ".encode()), raw.index(b"\nand what")
            assert 0.85 < r["coverage"] <= 1
            assert begin <= r["begin"] < begin + 40 and end - 40 < r["end"] <= end
