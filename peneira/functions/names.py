"""Column names as they are, whatever characters they hold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """The name in backticks, so that a full stop in it is no path."""
    return f"`{name.replace('`', '``')}`"


def named(name: str) -> Column:
    """The column of exactly this name."""
    return F.col(quoted(name))
