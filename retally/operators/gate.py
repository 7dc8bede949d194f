"""The reconciliation gate: compare paid and accepted counts of a group."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Gate classes.
MISMATCH, MATCH, NONE = "mismatch", "match", "none"


def gate_class(paid: Column, accepted: Column) -> Column:
    """``mismatch`` when the counts differ, ``none`` when both are zero, else ``match``."""
    return (F.when(paid != accepted, F.lit(MISMATCH))
            .when(paid == 0, F.lit(NONE))
            .otherwise(F.lit(MATCH)))


def gate_passes(paid: Column, accepted: Column, rule: str) -> Column:
    """``equal``: counts equal and non-zero.  ``unequal``: both non-zero and different."""
    if rule == "equal":
        return (paid == accepted) & (paid > 0)
    if rule == "unequal":
        return (paid != accepted) & (paid > 0) & (accepted > 0)
    raise ValueError(f"unknown gate rule {rule!r}")
