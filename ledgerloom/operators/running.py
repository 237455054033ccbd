"""Exact means, medians and modes over all increments of a load so far.

Every run keeps what its own rows add: sums and counts for a mean, and for a median
or mode the distinct values with their counts, sorted into files by value. Lowest and
highest value and count of every file lie beside them, so that a median reads only the
files of each run that can hold the middle, a small share of the values kept. After
``RUNS_APART`` runs the next one keeps the counts of all of them together.
"""

from __future__ import annotations

import logging
from urllib.parse import quote

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from ledgerloom.functions.columns import column
from ledgerloom.operators.statistics import present
from ledgerloom.session import fresh_path
from ledgerloom.sinks.files_log import delete

logger = logging.getLogger(__name__)

# Files a run sorts the values of a column into, at most, and how many rows are worth one.
CELLS = 256
ROWS_A_CELL = 1 << 16
# Runs read side by side before their counts are put together.
RUNS_APART = 32
# How many distinct values the driver may take to finish a median.
LAST_VALUES = 100_000

SUMMARY = (
    "run string, covers array<string>, column string, kind string, file string, "
    "low double, high double, n long, total double"
)


class Running:
    """The statistics of one load, as its next run sees and extends them.

    ``done`` names the runs that count, in a column ``run_id``: what a run kept
    counts once it is among them, so a run that stopped is simply repeated. A
    repeated run replaces what it kept before. Run ids must differ.
    """

    def __init__(self, spark: SparkSession, folder: str, run_id: str, done: DataFrame):
        self.spark, self.folder, self.run_id = spark, folder.rstrip("/"), run_id
        spark.createDataFrame([], SUMMARY).write.mode("ignore").parquet(f"{self.folder}/summary/none")
        summary = spark.read.schema(SUMMARY).option("recursiveFileLookup", True).parquet(f"{self.folder}/summary")
        counted = summary.join(done.select(F.col("run_id").alias("run")).distinct(), "run", "left_semi")
        rows = counted.select(*summary.columns).collect()
        if any(r["run"] == run_id for r in rows):
            raise ValueError(f"run id {run_id!r} was used before")
        covered = {run for r in rows for run in r["covers"]}
        for run in sorted(covered & {r["run"] for r in rows}):
            # Their counts are part of a later run's that is done.
            delete(spark, f"{self.folder}/values/{self._name(run)}")
            delete(spark, f"{self.folder}/summary/{self._name(run)}")
        self._kept = [r for r in rows if r["run"] not in covered]
        self._runs = sorted({r["run"] for r in self._kept})
        self._covers = sorted(covered | set(self._runs)) if len(self._runs) >= RUNS_APART else []

    @staticmethod
    def _name(run: str) -> str:
        return f"run-{quote(run, safe='')}"

    def _path(self, run: str, kind: str, name: str) -> str:
        return f"{self.folder}/values/{self._name(run)}/{kind}-{quote(name, safe='')}"

    def _earlier(self, kind: str, name: str) -> list[Row]:
        found = [r for r in self._kept if r["kind"] == kind and r["column"] == name]
        lacking = set(self._runs) - {r["run"] for r in found}
        if lacking:
            logger.warning("%d earlier runs kept no %s of column %s", len(lacking), kind, name)
        return found

    def take(
        self, df: DataFrame, mean_columns: list[str], median_columns: list[str], mode_columns: list[str]
    ) -> dict[str, object]:
        """Statistics over the rows of all runs that count and those of ``df``, and keep what ``df`` adds.

        A column without any value has None. Nothing that is kept changes until
        the run is done, and then only by being left out for a later one.
        """
        aggregates = [F.count(F.lit(1)).alias("rows")]
        for i, name in enumerate(mean_columns):
            x = present(df, name).cast("double")
            aggregates += [F.sum(x).alias(f"s{i}"), F.count(x).alias(f"n{i}")]
        row = df.agg(*aggregates).first()
        found: dict[str, object] = {}
        kept: list[tuple] = []
        for i, name in enumerate(mean_columns):
            earlier = self._earlier("mean", name)
            n, total = row[f"n{i}"], row[f"s{i}"] or 0.0
            all_n = n + sum(r["n"] for r in earlier)
            all_total = total + sum(r["total"] for r in earlier)
            found[name] = all_total / all_n if all_n else None
            own = (all_n, all_total) if self._covers else (n, total)
            kept.append((self.run_id, self._covers, name, "mean", None, None, None, *own))
        for name in median_columns:
            cells = self._keep(df, "median", name, row["rows"])
            kept += [(self.run_id, self._covers, name, "median", *c[1:4], c[4], None) for c in cells]
            if not self._covers:
                cells += [
                    (self._path(r["run"], "median", name), r["file"], r["low"], r["high"], r["n"])
                    for r in self._earlier("median", name)
                    if r["n"]
                ]
            found[name] = self._median(cells)
            if not any(k[2:4] == (name, "median") for k in kept):
                kept.append((self.run_id, self._covers, name, "median", None, None, None, 0, None))
        for name in mode_columns:
            self._keep(df, "mode", name, row["rows"])
            kept.append((self.run_id, self._covers, name, "mode", None, None, None, row["rows"], None))
            runs = [] if self._covers else [r["run"] for r in self._earlier("mode", name)]
            counted = self._values(df, "mode", name, [*runs, self.run_id]).groupBy("value").agg(F.sum("n").alias("n"))
            best = counted.agg(F.min(F.struct(-F.col("n"), "value")).alias("best")).first()["best"]
            found[name] = best["value"] if best else None
        summary = self.spark.createDataFrame(kept, SUMMARY).coalesce(1)
        summary.write.mode("overwrite").parquet(f"{self.folder}/summary/{self._name(self.run_id)}")
        return found

    def _values(self, df: DataFrame, kind: str, name: str, runs: list[str]) -> DataFrame:
        data_type = T.DoubleType() if kind == "median" else df.schema[name].dataType
        schema = T.StructType().add("value", data_type).add("n", T.LongType())
        return self.spark.read.schema(schema).parquet(*[self._path(run, kind, name) for run in runs])

    def _keep(self, df: DataFrame, kind: str, name: str, rows: int) -> list[tuple]:
        """Write the values of a column with their counts; (folder, file, low, high, n) per file of a median."""
        value = present(df, name)
        own = df.select((value.cast("double") if kind == "median" else value).alias("value")).where("value IS NOT NULL")
        counts = own.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        if self._covers:
            earlier = self._earlier(kind, name)
            rows += sum(r["n"] for r in earlier)
            runs = sorted({r["run"] for r in earlier})
            if runs:
                counts = counts.unionByName(self._values(df, kind, name, runs)).groupBy("value").agg(F.sum("n").alias("n"))
        path = self._path(self.run_id, kind, name)
        if kind == "median":
            return _cells(counts, path, min(CELLS, 1 + rows // ROWS_A_CELL))
        counts.write.mode("overwrite").parquet(path)
        return []

    def _median(self, cells: list[tuple]) -> float | None:
        n = sum(c[4] for c in cells)
        if not n:
            return None
        low, high = (n - 1) // 2, n // 2
        first = _value_at(self.spark, cells, low)
        return first if low == high else (first + _value_at(self.spark, cells, high)) / 2


def _cells(counts: DataFrame, path: str, parts: int) -> list[tuple]:
    """Sort ``value, n`` into files by value; folder, file, lowest and highest value and rows of each."""
    ranged = counts.repartitionByRange(parts, "value").sortWithinPartitions("value")
    ranged.write.mode("overwrite").parquet(path)
    written = counts.sparkSession.read.schema(counts.schema).parquet(path)
    per_file = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("n")
    )
    return [(path, r["file"], r["low"], r["high"], r["n"]) for r in per_file.collect()]


def _bounds(cells: list[tuple], rank: int) -> tuple[float, float]:
    """Two values the one of a rank lies between, themselves included, by what the files hold at least."""
    low = high = None
    passed = 0
    for value, n in sorted((c[2], c[4]) for c in cells):
        # Rows below ``value`` lie in files that begin below it.
        if low is None or (value > low and passed <= rank):
            low = value
        passed += n
    passed = 0
    for value, n in sorted((c[3], c[4]) for c in cells):
        passed += n
        if passed > rank:
            high = value
            break
    return low, high


def _value_at(spark: SparkSession, cells: list[tuple], rank: int) -> float:
    """The value of a rank, counted from 0, among the rows of files sorted by value.

    Files beyond the bounds are not read. While those left hold more distinct
    values than the driver takes, they are put together and sorted anew.
    """
    while True:
        low, high = _bounds(cells, rank)
        if low == high:
            return low
        rank -= sum(n for _, _, _, top, n in cells if top < low)
        open_ = [f"{folder}/{file}" for folder, file, bottom, top, _ in cells if bottom <= high and top >= low]
        values = spark.read.schema("value double, n long").parquet(*open_)
        below = F.sum(F.when(F.col("value") < F.lit(low), F.col("n")))
        inside = F.count_if(F.col("value").between(F.lit(low), F.lit(high)))
        row = values.agg(below.alias("below"), inside.alias("inside")).first()
        rank -= row["below"] or 0
        counts = values.where(F.col("value").between(F.lit(low), F.lit(high))).groupBy("value").agg(F.sum("n").alias("n"))
        if row["inside"] <= LAST_VALUES:
            last = counts.toPandas().sort_values("value")
            return float(last["value"].iloc[np.searchsorted(np.cumsum(last["n"]), rank, side="right")])
        cells = _cells(counts, fresh_path(spark, "middle"), CELLS)
