"""References to columns by their exact names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def quoted(name: str) -> str:
    """The name in quotes, so that dots and blanks in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))
