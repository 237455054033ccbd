"""Quality rules evaluated once per document into a ledger of failure bits.

The ledger holds a row of measurements and one bit per failed rule. A policy is a
set of rules under a version number; applying one, or asking what each rule costs,
only looks at the bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, n_upper long, n_letters long"

# Rule name -> failure, in terms of the measurements. The position is the bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "upper_case": "10 * n_upper > 4 * n_letters",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
    "repeated_lines": "10 * n_dup_lines > 7 * n_lines",
}

BASE_POLICY = 1
# Version -> rules whose failure drops a document. Add versions, never change one.
POLICIES: dict[int, tuple[str, ...]] = {
    1: ("few_words", "repeated_words"),
    2: ("few_words", "repeated_words", "symbols", "upper_case", "short_words", "long_words"),
    3: tuple(RULES),
}
CURRENT_POLICY = 2

_SPACES = list(b" \t\n\x0b\x0c\r")
_SYMBOLS = list(b"#*$%&|<>")


def measures(text: str | None) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of ``MEASURES``; null counts as empty.

    Letters are ASCII here; lines without a word are not counted.
    """
    raw = b"" if text is None else text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    points = len(raw) - int(counts[0x80:0xC0].sum())
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    upper = int(counts[0x41:0x5B].sum())
    return (
        len(words),
        points - int(counts[_SPACES].sum()),
        int(counts[_SYMBOLS].sum()),
        len(lines),
        len(lines) - len(set(lines)),
        repeat_words(words),
        upper,
        upper + int(counts[0x61:0x7B].sum()),
    )


def repeat_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(word, len(number)) for word in words], dtype=np.int64)
    if len(number) == len(words):
        return 0
    window = ids[:n]
    for at in range(1, width):
        # Renumbering keeps the products small, so no two windows share a number.
        window = np.unique(window * len(number) + ids[at : at + n], return_inverse=True)[1]
    repeated = np.bincount(window)[window] > 1
    covered = np.zeros(len(words), dtype=bool)
    for at in range(width):
        covered[at : at + n] |= repeated
    return int(covered.sum())


def measuring(text: str, dropped: tuple[str, ...] = ()):
    """A function over record batches that adds the measurements of the column ``text``."""
    names = [column.split()[0] for column in MEASURES.split(", ")]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measures(value.as_py()) for value in batch.column(text)]
            columns = list(zip(*rows)) if rows else [()] * len(names)
            others = [name for name in batch.schema.names if name not in dropped]
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in others] + [pa.array(column, pa.int64()) for column in columns],
                others + names,
            )

    return measured


def fail_bits(rules: dict[str, str] = RULES) -> Column:
    bits = F.lit(0).cast("long")
    for at, rule in enumerate(rules.values()):
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(1 << at)).otherwise(F.lit(0)).cast("long"))
    return bits


def mask(version: int) -> int:
    return sum(1 << at for at, name in enumerate(RULES) if name in POLICIES[version])


def ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measurements and ``fail_bits`` of every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; further columns are left behind. One
    output row per input row, repeated rows and null ids included; a null text
    counts as empty and fails ``few_words``. Nothing is shuffled.
    """
    plain = docs.select("doc_id", "text")
    schema = T.StructType([plain.schema["doc_id"], *T.StructType.fromDDL(MEASURES)])
    return plain.mapInArrow(measuring("text", ("text",)), schema).withColumn("fail_bits", fail_bits())


def passes(bits: Column | str, version: int = CURRENT_POLICY) -> Column:
    bits = F.col(bits) if isinstance(bits, str) else bits
    return bits.bitwiseAND(F.lit(mask(version)).cast("long")) == 0


def filter_documents(docs: DataFrame, version: int = CURRENT_POLICY) -> DataFrame:
    """The rows of ``docs`` that pass a policy, all columns kept, nothing shuffled.

    Measurements are made beside the row they belong to, so repeated and null
    ids need no care. Columns may have any names.
    """
    plain = docs.toDF(*[f"c{at}" for at in range(len(docs.columns))])
    schema = T.StructType([*plain.schema, *T.StructType.fromDDL(MEASURES)])
    rows = plain.mapInArrow(measuring(f"c{docs.columns.index('text')}"), schema)
    kept = rows.withColumn("fail_bits", fail_bits()).where(passes("fail_bits", version))
    return kept.select(plain.columns).toDF(*docs.columns)


def ablations(rows: DataFrame, version: int = CURRENT_POLICY) -> DataFrame:
    """What each rule of a policy does: documents that fail it, that only it drops, and that pass without it.

    Ledger rows are first counted per set of bits, at most one row per
    combination of rules; all figures then come from bitwise tests on these.
    """
    every = mask(version)
    bits = F.col("fail_bits")
    kinds = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    named = [(name, 1 << at) for at, name in enumerate(RULES) if name in POLICIES[version]]
    rule = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in named]))
    others = bits.bitwiseAND(F.lit(every).cast("long")).bitwiseAND(F.bitwise_not(F.col("rule.bit")))
    failed = bits.bitwiseAND(F.col("rule.bit")) != 0

    def count(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    return (
        kinds.withColumn("rule", rule)
        .groupBy(F.col("rule.rule").alias("rule"))
        .agg(
            count(failed).alias("n_failed"),
            count(failed & (others == 0)).alias("n_only"),
            count(others == 0).alias("n_kept_without"),
            F.bit_or(F.when(failed, others)).alias("fails_with"),
        )
    )
