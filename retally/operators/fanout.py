"""Wide → long over repeated column groups ("slots"), in one pass.

The source statement has one UNION branch per slot, each re-reading and
re-joining both tables (40 branches → 120 scans, 80 joins).  Here:

* ``explode_applied``  turns each wide row into one row per slot it applies
  for (decided by that row's own columns).  A single Generate yields the numbers
  of the applied slots only, so the rows that leave it are the applied papers
  and rows without any vanish there.  Values are read at the row's slot
  afterwards.
* ``slot_case``        reads the *other* side's column group at a row's slot
  with one ``CASE`` (only the matching branch is evaluated), after the join,
  so the other side is never reshaped: it is pruned to the key and the slot
  columns and joined as it is.

So the report is: explode the narrow application side, join once on the row
key with the result side, read paper and code by slot.  All built-in
expressions (JVM side, whole-stage codegen).  No higher-order functions,
whose lambdas Catalyst would copy into several operators.

Per-slot expressions are given as SQL text templates (``Slot -> str``), and
each wide expression is sent to the JVM as one ``expr``: a 40-slot layout is
a handful of driver round trips instead of thousands of Column calls.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retally.specs import Slot

SlotSql = Callable[[Slot], str]


def q(name: str) -> str:
    """Quote an identifier for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def applied_slots(slots: Sequence[Slot], keep: SlotSql) -> str:
    """SQL of the array of slot numbers for which ``keep(slot)`` is true (NULL: not).

    It stands in the Generate itself: a filter on it would let Catalyst infer
    constraints on every slot column, which takes minutes for 40 slots.
    """
    numbers = ", ".join(f"if({keep(s)}, {s.index}, -1)" for s in slots)
    return f"array_remove(array({numbers}), -1)"


def explode_applied(df: DataFrame, slots: Sequence[Slot], keep: SlotSql, values: Mapping[str, SlotSql],
                    keep_columns: Sequence[str], slot_column: str = "slot") -> DataFrame:
    """One row per (input row, slot with ``keep``): ``keep_columns`` + ``slot_column`` + ``values``.

    A NULL keep predicate counts as not applied (SQL ``WHERE`` semantics).
    """
    long = df.select("*", F.expr(f"explode({applied_slots(slots, keep)}) AS _at"))
    return long.select(*keep_columns, F.col("_at").alias(slot_column), *[slot_case(slots, "_at", fn).alias(k) for k, fn in values.items()])


def slot_case(slots: Sequence[Slot], slot_column: str, value: SlotSql) -> Column:
    """``value(slot)`` of the slot named by ``slot_column`` (NULL for an unknown slot)."""
    branches = " ".join(f"WHEN {s.index} THEN {value(s)}" for s in slots)
    return F.expr(f"CASE {q(slot_column)} {branches} END")
