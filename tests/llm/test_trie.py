import hashlib
import random
import re
import zlib

import pytest

from ledgerloom.llm import trie
from ledgerloom.llm.queries import rebuilt
from ledgerloom.session import written_table

KIND = "conv_id long, turn long, role string, text string, node string, depth int"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def ordered(rows):
    """Turns of each conversation as (role, text), by turn, null first, then role and text."""
    convs = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [t[2:] for t in sorted(turns)] for conv, turns in convs.items()}


def nodes_by_definition(convs):
    members = {}
    for conv, turns in convs.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    out = []
    for path, held in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = {p for p in below if len(p) == len(path) + 1}
        words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        ends = sorted(c for c in held if len(convs[c]) == len(path))
        out.append(
            (
                min(held),
                len(path),
                min(members[path[:-1]]) if path else None,
                len(held),
                len(children),
                sum(not any(q[: len(p)] == p and len(q) == len(p) + 1 for q in below) for p in below),
                sum((len(members[p]) - 1) * words(p) for p in below),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def collected(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def drawn(seed, n, longest, said=("a", "b c", " d  e f ")):
    chance = random.Random(seed)
    rows = []
    for conv in range(n):
        # Many begin alike, some are copies, some go on beyond others.
        alike = [chance.choice(said) if chance.random() < 0.25 else said[0] for _ in range(chance.randint(1, longest))]
        rows += [(conv, turn, "user" if turn % 2 else "bot", text, "x", 1) for turn, text in enumerate(alike)]
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_nodes_by_definition(spark, seed):
    rows = drawn(seed, 40, 3 + 5 * seed)
    found = trie.prefix_trie(spark.createDataFrame(rows, KIND).repartition(4))
    assert collected(found) == nodes_by_definition(ordered(rows))


def test_block_length_does_not_show(spark):
    rows = drawn(7, 30, 9)
    turns = written_table(trie.numbered(spark.createDataFrame(rows, KIND)), "turns")
    one = {r["conv_id"]: r for r in turns.groupBy("conv_id").count().collect()}
    assert len(one) == 30
    blocks = turns.repartition(2, "conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(trie.chained, trie.BLOCKS).collect()
    assert all(len(r["words"]) <= trie.BLOCK_TURNS and len(r["digests"]) == 16 * len(r["words"]) for r in blocks)
    assert sum(r["last"] for r in blocks) == 30


def test_awkward_rows(spark):
    rows = [
        (5, 1, "user", "second", None, None),
        (5, None, "user", "null turn comes first", None, None),
        (5, None, None, None, None, None),
        (6, 1, "user", "tie b", None, None),
        (6, 1, "user", "tie a", None, None),
        (6, 1, "user", "tie a", None, None),
        (7, 1, "user", "tie a", None, None),
        (7, 2, "user", "tie a", None, None),
        (7, 3, "user", "tie b", None, None),
        (None, 1, "user", "whose is this", None, None),
        (8, 0, "user", "w " * 200_000, None, None),
        (9, 0, "user", "w " * 200_000, None, None),
        (9, 1, "us", "er x", None, None),
        (10, 0, "user", "w " * 200_000, None, None),
        (10, 1, "user", " x", None, None),
        *[(11, n, "user", "same", None, None) for n in range(300)],
        *[(12, n, "user", "same", None, None) for n in range(299)],
    ]
    found = trie.prefix_trie(spark.createDataFrame(rows, KIND).repartition(3))
    assert collected(found) == nodes_by_definition(ordered(rows))


def test_one_beginning_of_many(spark, monkeypatch):
    """A node where many conversations end: pieces of ids from several tasks, hashed in order."""
    rows = [(conv, 0, "user", "hello", None, None) for conv in range(3000)]
    rows += [(conv, 1, "user", f"go on {conv % 7}", None, None) for conv in range(0, 3000, 3)]
    found = trie.prefix_trie(spark.createDataFrame(rows, KIND).repartition(5))
    assert collected(found) == nodes_by_definition(ordered(rows))


def test_pieces_of_ids(spark):
    import pyarrow as pa

    rows = [(b"k", c) for c in range(20_000)] + [(b"l", 5)]
    batches = [pa.record_batch([pa.array([k for k, _ in part]), pa.array([c for _, c in part])], ["key", "conv_id"]) for part in (rows[:9000], rows[9000:])]
    pieces = list(trie.joined_ids(iter(batches)))
    assert [len(p) for b in pieces for p in (x.split(",") for x in b.column("ids").to_pylist())] == [8192, 8192, 3616, 1]
    hashes = [h for b in trie.hashed_ids(iter(pieces)) for h in b.column("ends_sha256").to_pylist()]
    assert hashes == [hashlib.sha256(t.encode()).hexdigest() for t in (",".join(map(str, range(20_000))), "5")]


def test_nothing(spark):
    empty = spark.createDataFrame([], KIND)
    assert trie.prefix_trie(empty).count() == 0


def test_conversations_without_a_turn(spark):
    rows = [(1, 0, "user", "a", None, None)]
    turns = trie.numbered(spark.createDataFrame(rows, KIND))
    ids = spark.createDataFrame([(1,), (0,), (2,)], "conv_id long")
    assert collected(trie.nodes(turns, ids)) == nodes_by_definition({0: [], 1: [("user", "a")], 2: []})


def test_rebuilt(spark):
    rows = [(conv, turn, "user", f"{conv} {turn}", None, None) for conv in [*range(0, 45), 81] for turn in range(1 + conv % 6)]
    turns = written_table(trie.numbered(spark.createDataFrame(rows, KIND)), "turns")
    convs = ordered(rows)
    expected = {}
    for conv, own in convs.items():
        h = zlib.crc32(str(conv).encode()) % 4
        expected[conv] = convs.get(conv - conv % 20, [])[:h] + own[h:]
    found = trie.nodes(rebuilt(turns), turns.where("pos = 0").select("conv_id"))
    assert collected(found) == nodes_by_definition(expected)
