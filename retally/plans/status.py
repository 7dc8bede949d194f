"""Deadline status (J4) and published exam groups (J5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retally.functions.dates import deadline
from retally.specs import GROUP_COLUMNS


def deadline_status(results: DataFrame, end_date_as_text: bool, strict: bool = True) -> DataFrame:
    """Result rows per (subcode, course, semyr, pub_result) with the appeal deadline.

    Ordered by the deadline as a date (not as text); the group keys break ties
    so the order is total.  The annual report prints the deadline as ISO text,
    the semester report keeps it a date.  Partial aggregation runs map-side,
    so one hot group costs one combined row per task, not a skewed shuffle.
    """
    keys = ["subcode", "course", "semyr", "pub_result"]
    counted = results.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    end = deadline("pub_result", strict)
    return (
        counted.withColumn("_end", end)
        .orderBy("_end", *keys)
        .select(*keys, (F.col("_end").cast("string") if end_date_as_text else F.col("_end")).alias("end_date"),
                "row_count")
    )


def published_groups(results: DataFrame, pub_result: str | None = None) -> DataFrame:
    """Distinct (course, subcode, semyr_code) published on ``pub_result``.

    The publish date is compared as text, exactly as stored.  With
    ``pub_result=None`` every publish date is taken and kept as a column:
    one job for all dates instead of one run per date.
    """
    if pub_result is not None:
        return results.where(F.col("pub_result") == F.lit(pub_result)).select(*GROUP_COLUMNS).distinct()
    return results.select("pub_result", *GROUP_COLUMNS).distinct()
