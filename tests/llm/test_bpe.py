import hashlib
import json
import random

import numpy as np
import pytest

from ledgerloom.llm import bpe
from ledgerloom.llm.queries import byte_vocabulary, op11_byte_bpe

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def path():
    return byte_vocabulary()


@pytest.fixture(scope="module")
def library(path):
    return tokenizers.Tokenizer.from_file(path)


@pytest.fixture(scope="module")
def encoder(path):
    return bpe.Encoder(bpe.read_vocabulary(path))


def same(encoder, library, text):
    ids = bpe.unpacked(encoder.encode(text))
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert bpe.decoded(encoder.vocabulary, encoder.encode(text)).decode() == library.decode(ids, skip_special_tokens=False) == text


PARTS = (
    ["a", "b", "e", " ", "  ", "\n", "t", "the", "ing", "'s", "'", "'ll", "1", "22", "\u00e9", "\u4e2d", "\u0558", "\U00010940"]
    + ["<|endoftext|>", "<|endof", "\t", "\x1c", "\x85", "\u3000", "\U0001d518", "\U0001f600", "!", "..", "==", "  \n", "A", "\x00", "\u0130"]
)


def test_random_texts(encoder, library):
    chance = random.Random(11)
    for _ in range(3000):
        same(encoder, library, "".join(chance.choice(PARTS) for _ in range(chance.randint(0, 40))))


def test_long_pieces(encoder, library):
    chance = random.Random(12)
    for letters in ("ab", "aAbBtheing", "=-_", "0123456789", "\u00e9\u00e0\u4e2d\u6587\u3042"):
        for n in (7, 60, 3000):
            same(encoder, library, "".join(chance.choice(letters) for _ in range(n)))
    for letter in ("a", "=", " ", "\u4e2d"):
        same(encoder, library, letter * 4001)


def test_every_character_is_cut_as_in_the_library(encoder, library):
    for first in range(0, 0x30000, 0x1000):
        points = [c for c in range(first, first + 0x1000) if not 0xD800 <= c < 0xE000]
        same(encoder, library, "".join(f"a{chr(c)} {chr(c)}1{chr(c)}" for c in points))


def test_stretches_do_not_show(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "STRETCH", 5)
    chance = random.Random(13)
    for _ in range(500):
        same(encoder, library, "".join(chance.choice(PARTS) for _ in range(chance.randint(0, 40))))
    ids = encoder.encode("some words of a text, \u4e2d\u6587 too")
    assert bpe.decoded(encoder.vocabulary, ids, 2) == "some words of a text, \u4e2d\u6587 too".encode()


def merged(pieces, ranks):
    """Merges one after the other, as the definition has it: the lowest rank first, of equals the leftmost."""
    while True:
        found = [(ranks[pair], at) for at, pair in enumerate(zip(pieces, pieces[1:])) if pair in ranks]
        if not found:
            return pieces
        at = min(found)[1]
        pieces = [*pieces[:at], pieces[at] + pieces[at + 1], *pieces[at + 2 :]]


def small_file(folder, merges):
    letters = sorted({c for pair in merges for part in pair for c in part} | set("abc"))
    vocab = {c: n for n, c in enumerate(dict.fromkeys([*letters, *(a + b for a, b in merges)]))}
    pre = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    model = {"type": "BPE", "vocab": vocab, "merges": [list(pair) for pair in merges]}
    name = folder / f"v{abs(hash(str(merges)))}.json"
    name.write_text(json.dumps({"version": "1.0", "added_tokens": [], "pre_tokenizer": pre, "decoder": pre, "model": model}))
    return str(name)


def test_any_merges_against_their_definition(tmp_path, monkeypatch):
    """Vocabularies drawn at random, among them such whose tokens are not reached by merging their own bytes."""
    monkeypatch.setattr(bpe, "unlike", lambda path: "")
    chance = random.Random(14)
    for _ in range(60):
        parts, merges = ["a", "b", "c"], []
        while len(merges) < 8:
            pair = (chance.choice(parts), chance.choice(parts))
            if "".join(pair) not in parts:
                merges.append(pair)
                parts.append("".join(pair))
        vocabulary = bpe.read_vocabulary.__wrapped__(small_file(tmp_path, merges))
        encoder, ranks = bpe.Encoder(vocabulary), {pair: n for n, pair in enumerate(merges)}
        for _ in range(60):
            text = "".join(chance.choice("abc") for _ in range(chance.randint(1, 14)))
            ids = bpe.unpacked(encoder.encode(text))
            assert [vocabulary.tokens[i].decode() for i in ids] == merged(list(text), ranks)


def test_query_against_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r for r in op11_byte_bpe(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        ids = library.encode(doc["text"], add_special_tokens=False).ids
        row = rows[doc["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_awkward_rows(awkward, nothing, path):
    clashing = awkward.withColumnRenamed("hits", "ids").withColumnRenamed("k0", "n_tokens")
    read = bpe.decode(bpe.encode(clashing, path), path).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    expected = sorted(((r["doc_id"], r["text"] or "") for r in awkward.collect()), key=key)
    assert sorted(((r["doc_id"], r["decoded"]) for r in read), key=key) == expected
    assert bpe.decode(bpe.encode(nothing, path), path).count() == 0


def test_decoding_numbers_that_fit_nothing(spark, path, library):
    ids = [1, 60000, 50256, 162, 17250]
    rows = spark.createDataFrame([(1, bytearray(np.array(ids, "<u4").tobytes()), "x"), (2, None, "y")], "doc_id long, ids binary, decoded string")
    found = {r["doc_id"]: r["decoded"] for r in bpe.decode(rows, path).collect()}
    assert found == {1: library.decode(ids, skip_special_tokens=False), 2: None}


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
