"""Type conversion of whole columns."""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.functions import parsing
from ledgerloom.functions.columns import column

logger = logging.getLogger(__name__)

ERROR_MODES = ("null", "keep", "raise")


def lost_counts(df: DataFrame, pairs: dict[str, tuple[Column, Column]]) -> dict[str, int]:
    """How many present values each conversion turned into null: one job for all columns."""
    if not pairs:
        return {}
    counts = df.agg(
        *[
            F.count_if(old.isNotNull() & new.isNull()).alias(f"c{i}")
            for i, (old, new) in enumerate(pairs.values())
        ]
    ).first()
    return {name: counts[i] for i, name in enumerate(pairs)}


def _apply(df: DataFrame, new: dict[str, Column], on_error: str, what: dict[str, str]) -> DataFrame:
    if on_error not in ERROR_MODES:
        raise ValueError(f"on_error must be one of {ERROR_MODES}")
    if on_error == "raise":
        new = {c: parsing.raise_where_lost(v, column(c), what[c]) for c, v in new.items()}
    elif on_error == "keep":
        lost = lost_counts(df, {c: (column(c), v) for c, v in new.items()})
        for name in [c for c in new if lost[c]]:
            logger.error("%d values of %s do not convert, column kept", lost[name], name)
            del new[name]
    return df.withColumns(new) if new else df


def convert_types(df: DataFrame, column_types: dict[str, object], on_error: str = "null") -> DataFrame:
    """Cast columns; names the input lacks are skipped.

    ``null`` empties the values that do not convert, ``raise`` fails the job on
    them, ``keep`` leaves a column as it is if any value of it does not convert.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    new, what = {}, {}
    for name, dtype in column_types.items():
        if name not in types:
            logger.warning("column %s not found, not converted", name)
            continue
        target = parsing.spark_type(dtype)
        new[name] = parsing.convert(column(name), types[name], target)
        what[name] = target.simpleString()
    return _apply(df, new, on_error, what)


def parse_datetime(
    df: DataFrame, column_name: str, datetime_format: str | None = None, errors: str = "raise"
) -> DataFrame:
    """Parse a text column; bad values fail the job, become null, or leave the column as it is."""
    modes = {"raise": "raise", "coerce": "null", "ignore": "keep"}
    if errors not in modes:
        raise ValueError(f"errors must be one of {sorted(modes)}")
    if column_name not in df.columns:
        logger.warning("column %s not found, not parsed", column_name)
        return df
    if isinstance(df.schema[column_name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df
    parsed = parsing.to_timestamp(column(column_name).cast("string"), datetime_format)
    return _apply(df, {column_name: parsed}, modes[errors], {column_name: "timestamp"})


def create_timestamp(
    df: DataFrame,
    date_column: str,
    time_column: str | None = None,
    new_column: str = "TransactionTimestamp",
    datetime_format: str | None = None,
) -> DataFrame:
    """Add a timestamp from a date and an optional time column; bad values become null.

    With a time column, both source columns leave as text.
    """
    if date_column not in df.columns or (time_column and time_column not in df.columns):
        logger.error("date or time column not found: %s, %s", date_column, time_column)
        return df
    if time_column:
        texts = {c: column(c).cast("string") for c in (date_column, time_column)}
        if isinstance(df.schema[date_column].dataType, (T.TimestampType, T.TimestampNTZType)):
            texts[date_column] = F.date_format(column(date_column), "yyyy-MM-dd")
        stamp = parsing.combine_timestamp(*texts.values(), datetime_format=datetime_format)
        return df.withColumns({**texts, new_column: stamp})
    if isinstance(df.schema[date_column].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return df.withColumn(new_column, column(date_column).cast("timestamp"))
    return df.withColumn(new_column, parsing.to_timestamp(column(date_column).cast("string"), datetime_format))


@dataclass(frozen=True)
class Inferred:
    """What the values of a text column say about its pattern."""

    pattern: str | None
    present: int
    parsed: int
    # Other patterns that read all the same values, some of them to another date.
    ambiguous: tuple[str, ...] = ()


# What a directive leaves of a value's shape: ``E`` eight digits, ``Y`` four, ``9`` any other number, ``a`` letters.
SHAPES = {"%Y": "Y", "%f": "9Y", "%b": "a", "%B": "a", "%p": "a", "%a": "a", "%A": "a"}


def shapes_of(pattern: str) -> set[str]:
    """The shapes that values of a pattern can have."""
    out = {""}
    for part in re.findall(r"%.|[^%]", pattern.replace("%Y%m%d", "\0")):
        if part == "%z":
            ends = ["+Y", "-Y", "+9:9", "-9:9", "a"]
        elif part.startswith("%"):
            ends = list(SHAPES.get(part, "9"))
        else:
            ends = ["E" if part == "\0" else "a" if part.isalpha() else part]
        out = {head + end for head in out for end in ends}
    return out


def shape(c: Column) -> Column:
    """A text with its numbers and words told apart by kind and length only."""
    for found, mark in ((r"[A-Za-z]+", "a"), (r"(?<![0-9])[0-9]{8}(?![0-9])", "E"), (r"(?<![0-9])[0-9]{4}(?![0-9])", "Y"), (r"[0-9]+", "9")):
        c = F.regexp_replace(c, found, mark)
    return c


# How many digits the marks of a shape stand for, where no digit lies beside them.
MARKED = {"E": "[0-9]{8}", "Y": "[0-9]{4}", "9": "(?:[0-9]{1,3}|[0-9]{5,7}|[0-9]{9,})", "a": "[A-Za-z]+"}
# So many rows are looked at for a first guess of the shapes.
FIRST_ROWS = 1000


def has_shape(c: Column, shapes: set[str]) -> Column:
    """Whether ``shape`` of a text is among some shapes, without working it out."""
    forms = ["".join(MARKED.get(mark, re.escape(mark)) for mark in s) for s in sorted(shapes)]
    return c.rlike(rf"\A(?:{'|'.join(forms)})\z") if forms else F.lit(False)


def trimmed(c: Column) -> Column:
    """A text without white space at its ends; one that begins and ends with a plain character is not searched."""
    text = c.cast("string")
    plain = F.left(text, F.lit(1)).between("!", "~") & F.right(text, F.lit(1)).between("!", "~")
    return F.when(plain, text).otherwise(F.btrim(text, F.lit(parsing.WHITESPACE)))


def infer_patterns(
    df: DataFrame, names: list[str], candidates: tuple[str, ...] = parsing.CANDIDATES, day_first: bool = False
) -> dict[str, Inferred]:
    """The strftime pattern of each text column, by all its values, in one scan for all columns, two at most.

    The candidates whose shape occurs are tried on every value. Which shapes
    occur is guessed from the first rows; the scan finds those that lie further
    down, and is repeated with their candidates if there are any. The candidate that reads the
    most values is taken. Where others read as many, but some of them to another
    time, they are named as ``ambiguous`` (05/01 against 01/05, where no day is
    above 12); month-first is taken then, or with ``day_first`` the other. A
    column without a readable value has no pattern.
    """
    known = {p: shapes_of(p) for p in candidates}
    if day_first:
        candidates = tuple(sorted(candidates, key=lambda p: p.startswith(("%m/", "%m-"))))
    every = sorted(set().union(*known.values()))
    raw = df.select(*[column(name).cast("string").alias(f"r{at}") for at, name in enumerate(names)])

    def texts(rows: DataFrame, shapes: list[set[str]]) -> DataFrame:
        """Trimmed texts, and the shapes of those that have none of ``shapes``; what has one needs no trimming."""
        seen = rows.select("*", *[has_shape(F.col(f"r{at}"), found).alias(f"k{at}") for at, found in enumerate(shapes)])
        blanks, kept, others = F.lit(parsing.WHITESPACE), [], []
        for at, found in enumerate(shapes):
            text, usual = F.col(f"t{at}"), F.col(f"k{at}")
            kept += [F.when(usual, F.col(f"r{at}")).otherwise(F.btrim(f"r{at}", blanks)).alias(f"t{at}"), usual]
            others.append(shape(F.when(~usual, F.when(~has_shape(text, found), text))).alias(f"o{at}"))
        return seen.select(*kept).select("*", *others)

    new = [F.collect_set(F.when(F.col(f"o{at}").isin(every), F.col(f"o{at}"))).alias(f"s{at}") for at in range(len(names))]

    def counted(shapes: list[set[str]]):
        tried = [[p for p in candidates if known[p] & found] for found in shapes]
        stamps, wanted = [], list(new)
        for at, patterns in enumerate(tried):
            stamps += [parsing.by_pattern(F.col(f"t{at}"), p).alias(f"p{at}_{n}") for n, p in enumerate(patterns)]
            wanted += [F.count(f"t{at}").alias(f"c{at}")]
            wanted += [F.count(f"p{at}_{n}").alias(f"n{at}_{n}") for n in range(len(patterns))]
            wanted += [
                F.count_if(F.col(f"p{at}_{m}") != F.col(f"p{at}_{n}")).alias(f"d{at}_{m}_{n}")
                for m in range(len(patterns))
                for n in range(m + 1, len(patterns))
                if known[patterns[m]] & known[patterns[n]]
            ]
        return tried, texts(raw, shapes).select("*", *stamps).agg(*wanted).first()

    if not names:
        return {}
    first = texts(raw.limit(FIRST_ROWS), [set() for _ in names]).agg(*new).first()
    shapes = [set(first[f"s{at}"]) for at in range(len(names))]
    tried, found = counted(shapes)
    if any(found[f"s{at}"] for at in range(len(names))):
        tried, found = counted([seen | set(found[f"s{at}"]) for at, seen in enumerate(shapes)])
    found = found.asDict()
    out = {}
    for at, name in enumerate(names):
        present = found[f"c{at}"]
        counts = [found[f"n{at}_{n}"] for n in range(len(tried[at]))]
        most = max(counts, default=0)
        if not most:
            out[name] = Inferred(None, present, 0)
            continue
        best = counts.index(most)
        rivals = [n for n in range(best + 1, len(counts)) if counts[n] == most and found.get(f"d{at}_{best}_{n}")]
        out[name] = Inferred(tried[at][best], present, most, tuple(tried[at][n] for n in rivals))
    return out


def parse_inferred(df: DataFrame, names: list[str], day_first: bool = False) -> DataFrame:
    """Text columns of dates without a declared pattern to timestamps; values of another pattern become null.

    Ambiguous columns are logged. A column without a pattern is left as it is.
    """
    new = {}
    for name, found in infer_patterns(df, [n for n in names if n in df.columns], day_first=day_first).items():
        if found.ambiguous:
            logger.warning("column %s read by %s could also be %s", name, found.pattern, ", ".join(found.ambiguous))
        if found.pattern is None:
            logger.warning("column %s has no known date pattern", name)
            continue
        new[name] = parsing.by_pattern(trimmed(column(name)), found.pattern, found.parsed < found.present)
    return df.withColumns(new) if new else df
