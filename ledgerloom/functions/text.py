"""Cleaning and matching of text values. A null text stays null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerloom.functions.parsing import WHITESPACE

CASES = ("lower", "upper", "title")


def strip(c: Column) -> Column:
    """Remove all white space at both ends, tabs, line ends and no-break spaces included."""
    return F.btrim(c, F.lit(WHITESPACE))


CASED = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"

# Marks a word start inside ``title_case``: a code point no character has, and
# the blank that makes ``initcap`` begin a new word.
WORD_START = "\ufdd0 "


def title_case(c: Column) -> Column:
    """Capital after every character that is not a cased letter, lower case elsewhere.

    ``initcap`` begins words after blanks only, so the other word starts are
    marked first. A text that holds the mark itself takes a slower way.
    """
    marked = F.regexp_replace(F.lower(c), rf"([^{CASED} ])(?=[{CASED}])", "$1" + WORD_START)
    quick = F.replace(F.initcap(marked), F.lit(WORD_START), F.lit(""))
    runs = F.regexp_extract_all(F.lower(c), F.lit(f"([{CASED}]+|[^{CASED}]+)"), F.lit(1))
    by_run = F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")
    return F.when(F.contains(c, F.lit(WORD_START)), by_run).otherwise(quick)


def to_case(c: Column, case: str | None) -> Column:
    """Lower, upper or title case; any other name changes nothing."""
    if case == "lower":
        return F.lower(c)
    if case == "upper":
        return F.upper(c)
    if case == "title":
        return title_case(c)
    return c


def remove_characters(c: Column, characters: str | None) -> Column:
    """Remove each of the given characters wherever it stands."""
    return F.translate(c, characters, "") if characters else c


def clean_text(
    c: Column,
    strip_whitespace: bool = True,
    case: str | None = None,
    remove_chars: str | None = None,
) -> Column:
    """Strip, then case, then removal of characters."""
    out = strip(c) if strip_whitespace else c
    return remove_characters(to_case(out, case), remove_chars)


def contains_ignoring_case(c: Column, text: str) -> Column:
    """Literal substring test without regard to case."""
    return F.contains(F.lower(c), F.lit(text.lower()))
