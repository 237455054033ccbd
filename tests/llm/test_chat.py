import hashlib
from collections import defaultdict

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import chat

TURNS = "conv_id long, turn long, role string, text string, formatted string"


def test_round_trip_of_awkward_turns(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|im_end|>", "\\", "\\<|im_part|>\\", "<|im_sep|", "", None, "a\nb\r\n", "<<SYS>><</SYS>>", "\U0001f600"]
    rows = [(1, n, ["user", "assistant", "assistant"][n % 3], text, "x") for n, text in enumerate(nasty)]
    rows += [(2, None, None, "no turn", None), (2, 1, "us\ner<|im_sep|>", "odd role", None), (2, 1, "us\ner<|im_sep|>", "odd role", None)]
    rows += [(None, 3, "assistant", "no id", None)]
    rows += [(3, n, "assistant", f"text {n}", None) for n in range(700)]
    out = chat.format_conversations(spark.createDataFrame(rows, TURNS).repartition(5))
    got = {
        r["conv_id"]: r
        for r in out.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.learnt_text(F.col("segments")).alias("learnt")).collect()
    }
    want = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        want[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    assert set(got) == set(want)
    for conv, turns in want.items():
        turns.sort()
        row = got[conv]
        assert [(t["role"], t["text"]) for t in row["turns"]] == [(r, t) for _, r, t in turns]
        assert row["learnt"] == "".join(t for _, r, t in turns if r == "assistant")
        assert row["formatted"] == "".join(s["text"] for s in row["segments"])
        blocks = sum(1 for n, t in enumerate(turns) if n == 0 or turns[n - 1][1] != t[1])
        assert row["formatted"].count("<|im_start|>") == blocks == row["formatted"].count("<|im_end|>")
        assert "</s>" not in row["formatted"] and "[INST]" not in row["formatted"]


def test_no_rows(spark):
    assert chat.format_conversations(spark.createDataFrame([], TURNS)).count() == 0


def test_plan_is_native(spark, plan):
    out = chat.format_conversations(spark.range(9).selectExpr("id % 3 conv_id", "id turn", "'user' role", "'x' text"))
    assert not any(word in plan(out) for word in ("Python", "Pandas", "Arrow"))


def test_escape_reverses(spark):
    pieces = ["\\", "<", "[", "<s>", "</s>", "[INST]", "<|im_end|>", "<|im_start|>", "|im_part|>", "s>", "a", "\n"]

    @settings(max_examples=3, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(pieces), max_size=12).map("".join), min_size=40, max_size=80))
    def check(texts):
        df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
        for row in df.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
            assert row["t"] == row["u"]
            assert not any(control in row["e"] for control in chat.Template().controls)

    check()


def test_hash_of_learnt_text_by_hand(spark):
    rows = [(5, 0, "user", "hi", None), (5, 1, "assistant", "one", None), (5, 2, "assistant", "two", None)]
    out = chat.format_conversations(spark.createDataFrame(rows, TURNS))
    row = out.select("formatted", F.sha2(chat.learnt_text(F.col("segments")), 256).alias("h")).first()
    assert row["formatted"] == "<|im_start|>user<|im_sep|>hi<|im_end|><|im_start|>assistant<|im_sep|>one<|im_part|>two<|im_end|>"
    assert row["h"] == hashlib.sha256(b"onetwo").hexdigest()
