"""Scrutiny reports (J10 annual re-totalling, J11 annual re-valuation,
J12 semester re-totalling, J13 semester re-valuation): one builder, four
parameter rows (``retally.specs.REPORTS``).

Plan, in order of cost:
1. the row filters of the application table (applied, paid in the form) at the scan;
2. the groups that passed the gate, the ``NOT IN`` history exclusion and
   (semester) the captured-payment ``IN``, each where its other side fits a
   broadcast by the planner's estimate: wide rows of other groups, reported or
   unpaid forms go before anything is made of them, without an exchange.  Form
   numbers that do not fit as keys may fit as bitmaps (``form_bitmaps``), which
   are then probed here;
3. one Generate turns each application row into its applied slots (rows with
   none vanish): from here on a row is its 13 header columns, the slot number
   and the marks, so no exchange ever carries the wide slot columns;
4. those of the joins of step 2 whose other side is too large to broadcast, on
   these narrow rows.  They are written as inner / outer joins on distinct keys:
   Catalyst would move semi and anti joins back below the Generate;
5. one equi join with the result table on ``id`` (pruned to ``id`` and the
   paper columns), paper and code read at the row's slot with one ``CASE``;
6. one ``distinct`` over the 16 report columns, which is the source's
   UNION: equal rows of a group collapse.

Because ``subcode`` and ``semyr_code`` are report columns, one distinct over
all groups equals the union of per-group reports; no per-group loop.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retally.functions.casts import to_int
from retally.functions.dates import format_day
from retally.operators.bitmaps import bitmap_bytes, key_bitmaps
from retally.operators.fanout import explode_applied, q, slot_case
from retally.operators.membership import broadcast_limit, fits_broadcast, is_in, not_in
from retally.plans.reconcile import paid_ids
from retally.sources.sinks import checkpointed
from retally.sources.tables import ExamTables
from retally.specs import (APPLIED_STATUS, FLAG_TRUE, HEADER_COLUMNS, PAID_STATUS,
                           ReportSpec, Slot)


def applied_rule(spec: ReportSpec):
    """Slot → SQL predicate on the application row: did the candidate apply for this paper?"""
    if spec.layout == "annual":
        def keep(s: Slot) -> str:
            op = "OR" if s.name in spec.or_slots else "AND"
            return f"{q(s.name)} IS NOT NULL {op} {q(s.name + 'code')} IS NOT NULL"
    else:
        def keep(s: Slot) -> str:
            return f"{q(f'sub{s.subject}')} IS NOT NULL AND {q(f'sub{s.subject}_retotaling')} = '{FLAG_TRUE}'"
    return keep


def reported_forms(tables: ExamTables, spec: ReportSpec, strict: bool = True) -> DataFrame:
    """Form numbers (``form``) in the report's history, NULLs and repeats included."""
    history = tables[spec.history_table]
    if spec.history_types is not None:
        history = history.where(F.col("scrutiny_type").isin(*spec.history_types))
    return history.select(to_int("scanno", strict).alias("form"))


def paid_forms(tables: ExamTables, spec: ReportSpec, strict: bool = True) -> DataFrame:
    """Form numbers (``form``) with a captured payment for the report's purpose."""
    return paid_ids(tables["payment"], spec.purpose, strict=strict).select(F.col("paid_scanno").alias("form"))


def form_bitmaps(tables: ExamTables, forms: DataFrame) -> DataFrame | None:
    """Bitmaps of form numbers, written to the shared folder; None where they are too large to broadcast as well.

    Their size is counted before they are built, and the planner sees the size
    of the written table: no broadcast is forced.
    """
    limit = broadcast_limit(forms)
    if limit <= 0 or bitmap_bytes(forms, "form") > limit:
        return None
    return checkpointed(tables.spark, key_bitmaps(forms, "form"), "bitmaps")


def applied_papers(tables: ExamTables, spec: ReportSpec, groups: DataFrame | None = None,
                   strict: bool = True) -> DataFrame:
    """One narrow row per applied paper that may enter the report: ``id``, header, ``app_date``, ``_slot``, ``marks``."""
    apps = tables[spec.application_table].where(
        (F.col("retotaling_status") == APPLIED_STATUS) & (F.col("payment_status") == PAID_STATUS))
    # (whether the other side is small enough to lie below the fan-out, the step that keeps the rows it allows)
    steps: list[tuple[bool, Callable[[DataFrame, bool], DataFrame]]] = []
    if groups is not None:
        keys = groups.select("subcode", "semyr_code").distinct()
        steps.append((fits_broadcast(keys), lambda df, above: df.join(keys, ["subcode", "semyr_code"])))
    history = reported_forms(tables, spec, strict)
    seen = None if fits_broadcast(history) else form_bitmaps(tables, history)
    steps.append((seen is not None or fits_broadcast(history),
                  lambda df, above: not_in(df, "scanno", history, "form", in_place=above, bitmaps=seen)))
    if spec.payment_semi_join:
        paid = paid_forms(tables, spec, strict)
        captured = None if fits_broadcast(paid) else form_bitmaps(tables, paid)
        steps.append((captured is not None or fits_broadcast(paid),
                      lambda df, above: is_in(df, "scanno", paid, "form", in_place=above, bitmaps=captured)))
    for small, step in steps:
        apps = step(apps, False) if small else apps
    rows = explode_applied(
        apps, spec.slots, applied_rule(spec), {"marks": lambda s: q(s.name + "_th")},
        keep_columns=["id", *HEADER_COLUMNS, "app_date"], slot_column="_slot",
    )
    for small, step in steps:
        rows = rows if small else step(rows, True)
    return rows


def scrutiny_report(tables: ExamTables, spec: ReportSpec, groups: DataFrame | None = None,
                    strict: bool = True) -> DataFrame:
    """The 16-column report of ``spec`` over every group (or only ``groups``' subcode/semyr_code)."""
    slots = spec.slots
    applied = applied_papers(tables, spec, groups, strict)
    papers = tables[spec.result_table].select(
        F.col("id").alias("_rid"), *[c for s in slots for c in (s.name, s.name + "code")])
    joined = applied.join(papers, F.col("id") == F.col("_rid"))
    return joined.select(
        *HEADER_COLUMNS,
        slot_case(slots, "_slot", lambda s: q(s.name)).alias("paper"),
        slot_case(slots, "_slot", lambda s: q(s.name + "code")).alias("papercode"),
        "marks",
        format_day("app_date").alias("app_date"),
        F.lit(spec.scrutiny_type).alias("scrutiny_type"),
    ).distinct()
