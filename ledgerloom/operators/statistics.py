"""Exact column statistics that stay within bounded memory at any table size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.functions.columns import column
from ledgerloom.functions.parsing import null_if_nan
from ledgerloom.session import written_table

# How many values one task may sort to finish a median; more are narrowed first.
SORTED_VALUES_LIMIT = 1_000_000
SKETCH_ACCURACY = 10_000


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into null."""
    return null_if_nan(column(name), df.schema[name].dataType)


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def means(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Mean of each column, missing values left out: one job for all columns."""
    return means_and_medians(df, columns, [])[0]


@dataclass
class _Search:
    """The open interval known to hold the value of one rank, and how many values it holds."""

    column: str
    rank: int  # counted from 0 within the interval
    size: int
    low: float | None = None
    high: float | None = None
    value: float | None = None

    def inside(self, x: Column) -> Column:
        test = F.lit(True)
        if self.low is not None:
            test = test & (x > F.lit(self.low))
        if self.high is not None:
            test = test & (x < F.lit(self.high))
        return F.when(test, x)

    def narrow(self, a: float, b: float, below: int, at_a: int, between: int, at_b: int) -> None:
        """Move to the cell of ``< a | = a | a..b | = b | > b`` the rank falls into."""
        if self.rank < below:
            self.high, self.size = a, below
        elif self.rank < below + at_a:
            self.value = a
        elif self.rank < below + at_a + between:
            self.low, self.high = a, b
            self.rank, self.size = self.rank - below - at_a, between
        elif self.rank < below + at_a + between + at_b:
            self.value = b
        else:
            passed = below + at_a + between + at_b
            self.low, self.rank, self.size = b, self.rank - passed, self.size - passed


def medians(df: DataFrame, columns: list[str], limit: int = SORTED_VALUES_LIMIT) -> dict[str, float | None]:
    """Exact median of each column, the midpoint of the two middle values for even counts."""
    return means_and_medians(df, [], columns, limit)[1]


def means_and_medians(
    df: DataFrame, mean_columns: list[str], median_columns: list[str], limit: int = SORTED_VALUES_LIMIT
) -> tuple[dict[str, float | None], dict[str, float | None]]:
    """Means and exact medians; the first scan serves both.

    A sketch brackets the middle, exact counts check the bracket, and the few
    values inside it are sorted at the end. No pass shuffles rows: each returns
    one row of partial aggregates. A value held by many rows becomes a bracket
    end of its own, so ties cannot keep the bracket wide; a wrong sketch costs a
    further pass, never a wrong result.
    """
    columns = list(dict.fromkeys([*mean_columns, *median_columns]))
    if not columns:
        return {}, {}
    frame = df.select(*[present(df, c).cast("double").alias(c) for c in columns])
    first = [F.avg(column(c)).alias(f"m{i}") for i, c in enumerate(mean_columns)]
    for i, c in enumerate(median_columns):
        first += [F.count(column(c)).alias(f"n{i}"), _bracket(column(c), 0.5).alias(f"b{i}")]
    row = frame.agg(*first).first()
    found_means = {c: row[f"m{i}"] for i, c in enumerate(mean_columns)}
    middle: dict[str, list[_Search]] = {}
    brackets = {}
    for i, c in enumerate(median_columns):
        n = row[f"n{i}"]
        ranks = [] if n == 0 else sorted({(n - 1) // 2, n // 2})
        middle[c] = [_Search(c, r, n) for r in ranks]
        brackets |= {id(s): row[f"b{i}"] for s in middle[c]}
    searches = [s for found in middle.values() for s in found]
    if any(s.size > limit for s in searches):
        # More passes follow: they read the numbers alone, written once.
        frame = written_table(frame.select(*[column(c) for c in median_columns]), "numbers")
    while wide := [s for s in searches if s.value is None and s.size > limit]:
        _narrow(frame, wide, [brackets.pop(id(s), None) for s in wide])
    _finish(frame, [s for s in searches if s.value is None], limit)
    return found_means, {
        c: (found[0].value + found[-1].value) / 2 if found else None for c, found in middle.items()
    }


def _bracket(x: Column, share: float) -> Column:
    """Two values of ``x`` the given share of the values should lie between."""
    ends = [max(0.0, share - 2 / SKETCH_ACCURACY), min(1.0, share + 2 / SKETCH_ACCURACY)]
    return F.percentile_approx(x, ends, SKETCH_ACCURACY)


def _narrow(frame: DataFrame, searches: list[_Search], brackets: list) -> None:
    unknown = [i for i, ends in enumerate(brackets) if ends is None]
    if unknown:
        sketches = [
            _bracket(searches[i].inside(column(searches[i].column)), searches[i].rank / (searches[i].size - 1))
            .alias(f"b{i}")
            for i in unknown
        ]
        for i, ends in zip(unknown, frame.agg(*sketches).first()):
            brackets[i] = ends
    cells = []
    for i, s in enumerate(searches):
        a, b = brackets[i]
        x = s.inside(column(s.column))
        between = (x > F.lit(a)) & (x < F.lit(b))
        tests = [x < F.lit(a), x == F.lit(a), between, (x == F.lit(b)) & F.lit(a != b)]
        cells.extend(F.count_if(test).alias(f"c{i}_{j}") for j, test in enumerate(tests))
    counted = frame.agg(*cells).first()
    for i, s in enumerate(searches):
        s.narrow(*brackets[i], *counted[4 * i : 4 * i + 4])


def _finish(frame: DataFrame, searches: list[_Search], limit: int) -> None:
    """Sort the values left in the intervals and pick the ranks, at most ``limit`` values in a job."""
    by_interval: dict[tuple, list[_Search]] = {}
    for s in searches:
        by_interval.setdefault((s.column, s.low, s.high), []).append(s)
    jobs: list[list[list[_Search]]] = []
    held = limit
    for group in by_interval.values():
        if held + group[0].size > limit:
            jobs.append([])
            held = 0
        jobs[-1].append(group)
        held += group[0].size
    for groups in jobs:
        picks = []
        for i, group in enumerate(groups):
            ordered = F.array_sort(F.collect_list(group[0].inside(column(group[0].column))))
            picks.append(F.array(*[F.get(ordered, F.lit(s.rank)) for s in group]).alias(f"v{i}"))
        found = frame.agg(*picks).first()
        for i, group in enumerate(groups):
            for s, value in zip(group, found[i]):
                s.value = value


def modes(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """Most frequent value of each column, the smallest among ties; None for an empty column.

    One scan counts the values of all columns: each row gives one short row per
    column, of its number and its value in a column per type, so that a further
    column costs its own values only. Counts are combined before the shuffle and
    one row per column leaves the job.
    """
    by_type: dict[T.DataType, list[str]] = {}
    for name in dict.fromkeys(columns):
        by_type.setdefault(df.schema[name].dataType, []).append(name)
    if not by_type:
        return {}
    arrays = [F.array(*[present(df, c) for c in names]).alias(f"a{i}") for i, names in enumerate(by_type.values())]
    numbered = [name for names in by_type.values() for name in names]
    rows = df.select(*arrays).withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(len(numbered) - 1))))
    values, before = [], 0
    for i, names in enumerate(by_type.values()):
        # Null beyond the array's ends, which is where the other types have their numbers.
        values.append(F.get(f"a{i}", F.col("at") - before).alias(f"v{i}"))
        before += len(names)
    held = [f"v{i}" for i in range(len(values))]
    counted = rows.select("at", *values).dropna("all", subset=held)
    best = (
        counted.groupBy("at", *held)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("at")
        .agg(F.min(F.struct(-F.col("n"), *held)).alias("best"))
        .collect()
    )
    found = {numbered[row["at"]]: next(v for v in row["best"][1:] if v is not None) for row in best}
    return {name: found.get(name) for name in columns}


def of_columns(
    df: DataFrame, mean_columns: list[str], median_columns: list[str], mode_columns: list[str]
) -> dict[str, object]:
    """The statistic of each column, by the list it is in."""
    found_means, found_medians = means_and_medians(df, mean_columns, median_columns)
    return {**found_means, **found_medians, **modes(df, mode_columns)}


def columns_with_missing(df: DataFrame, columns: list[str]) -> set[str]:
    """Names of the columns holding at least one missing value: one job for all columns."""
    if not columns:
        return set()
    row = df.agg(*[F.bool_or(present(df, c).isNull()).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return {c for i, c in enumerate(columns) if row[i]}
