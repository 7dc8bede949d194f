"""Publish dates are day/month/year text; reports print dates the same way."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text pattern (one- or two-digit day and month) and
# the printed pattern of report dates; appeals close 15 days after publishing.
PARSE_PATTERN = "d/M/yyyy"
PRINT_PATTERN = "dd/MM/yyyy"
APPEAL_DAYS = 15


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_day(col: Column | str, strict: bool = True) -> Column:
    """``dd/mm/yyyy`` text → date.  Strict: impossible dates fail the job."""
    c = _c(col)
    parsed = F.try_to_date(c, PARSE_PATTERN)
    if not strict:
        return parsed
    return F.when(c.isNull() | parsed.isNotNull(), parsed).otherwise(
        F.raise_error(F.concat(F.lit("not a dd/mm/yyyy date: "), c))
    )


def deadline(col: Column | str, strict: bool = True) -> Column:
    """Last day to apply: publish date + 15 days."""
    return F.date_add(parse_day(col, strict), APPEAL_DAYS)


def format_day(col: Column | str) -> Column:
    return F.date_format(_c(col), PRINT_PATTERN)
