"""Blank-separated tokens of a file name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def token(col: Column | str, index: int, strict: bool = True) -> Column:
    """0-based ``index``-th token of ``col`` split on single blanks.

    Double blanks yield empty tokens.  A missing token fails the job when
    ``strict`` and is NULL otherwise.
    """
    c = F.col(col) if isinstance(col, str) else col
    parts = F.split(c, " ")
    item = F.try_element_at(parts, F.lit(index + 1))
    if not strict:
        return item
    return F.when(c.isNull() | item.isNotNull(), item).otherwise(
        F.raise_error(F.concat(F.lit(f"file name has no token {index}: "), c))
    )
