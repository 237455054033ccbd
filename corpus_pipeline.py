"""A training corpus from ``documents``: rules, line dedup, near-dedup, decontamination, mixing.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame that is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of documents; the last adds ``copies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import chunks, cube, rules, simhash, tiling
from ledgerloom.plans.registry import register, table
from ledgerloom.session import written_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy."""
    return rules.filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, passages that stand elsewhere cut out. ``n_chars`` follows the text; texts left without a word go."""
    cut = chunks.remove_repeated(docs, runs=True)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.selectExpr(*[f"CAST(char_length(text) AS {kind.simpleString()}) AS n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns])
    return cut.where(r"text RLIKE '[^\\x20\\x09-\\x0D]'")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate class."""
    return simhash.keep_one_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return tiling.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, and how many copies of each."""
    return cube.mixed_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

# Rolling hashes, fingerprints and the balanced draw have no counterpart in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


register("pipeline")(run)
