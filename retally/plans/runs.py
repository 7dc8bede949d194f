"""Gated runs: the annual job (J16) and the semester job (J17).

The source loops over the exam groups published on a date: per group it
fetches two lists, compares their sizes, and if the gate passes inserts that
group's report.  Here the loop is one plan:

    groups ⟕ paid counts ⟕ accepted counts  →  gate  →  passed groups
    report(applications of passed groups)  ⋈  passed groups

The final join is on (subcode, semyr_code) and keeps the source's bag
semantics: two passing groups that differ only in course each insert the same
report rows.  ``pub_result=None`` runs every publish date at once, with the
date as a leading column.

The gate table (one row per group) is written once to the shared folder and
read back: both uses below read it instead of recomputing the two counts, and
the planner sees its real size, so it is broadcast when small and joined by
sort-merge beyond the threshold.  With the groups broadcast, the report's
distinct shuffles on all 16 columns, not on the group key, so a group holding
a third of all applications is still spread over every task.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retally.plans.reconcile import captured_forms, captured_payments, gate, mismatch
from retally.plans.report import scrutiny_report
from retally.plans.status import published_groups
from retally.sources.manifest import RunManifest
from retally.sources.sinks import checkpointed
from retally.sources.tables import ExamTables
from retally.specs import REPORT_COLUMNS, REPORTS, ReportSpec


def gate_table(tables: ExamTables, spec: ReportSpec, pub_result: str | None = None,
               strict: bool = True, rule: str | None = None, manifest: RunManifest | None = None) -> DataFrame:
    """The gate of every published group, written once under the shared folder (``rule``: see ``gate``)."""
    def build() -> DataFrame:
        groups = published_groups(tables[spec.result_table], pub_result)
        return gate(groups, tables[spec.application_table], _forms(tables, manifest), spec, strict, rule)

    return manifest.table(f"gate_{spec.key}", build) if manifest else checkpointed(tables.spark, build(), f"gate-{spec.key}")


def _forms(tables: ExamTables, manifest: RunManifest | None) -> DataFrame:
    """The parsed payments, a step of the run if it has a manifest."""
    if manifest is None:
        return captured_forms(tables)
    return tables.once("captured_forms", lambda: manifest.table("captured_forms", lambda: captured_payments(tables["payment"])))


def gated_run(tables: ExamTables, spec: ReportSpec, pub_result: str | None = None,
              strict: bool = True, gates: DataFrame | None = None, rule: str | None = None,
              manifest: RunManifest | None = None) -> DataFrame:
    """The report rows of every group that passes its gate (``gates``: a ``gate_table`` to reuse).

    Building the DataFrame runs the gate job (and, once per set of exam tables,
    the payment parse) and writes their tables to the shared folder; the report
    itself is lazy.
    """
    if gates is None:
        gates = gate_table(tables, spec, pub_result, strict, rule, manifest)
    if spec.payment_semi_join:
        tables = tables.sharing("payment", _forms(tables, manifest))
    extra = ["pub_result"] if pub_result is None else []
    passed = gates.where(F.col("passed")).select(*extra, "subcode", "semyr_code")
    report = scrutiny_report(tables, spec, groups=passed, strict=strict)
    return report.join(passed, ["subcode", "semyr_code"]).select(*extra, *REPORT_COLUMNS)


class Run(NamedTuple):
    """What a run writes for one report."""

    gates: DataFrame
    mismatch: DataFrame
    report: DataFrame


def layout_run(tables: ExamTables, layout: str, pub_result: str | None, strict: bool = True,
               rules: dict[str, str] | None = None, manifest: RunManifest | None = None) -> dict[str, Run]:
    """Both reports of a layout, in the source's order; ``rules`` replaces a report's gate rule by its key.

    With a ``manifest`` every table of the run (parsed payments, gates,
    differences, reports) is a step of its own: a run that stopped is taken up
    after its last finished step, without the payment parse if the steps that
    need it are done.
    """
    out = {}
    for key, spec in REPORTS.items():
        if spec.layout != layout:
            continue
        gates = gate_table(tables, spec, pub_result, strict, (rules or {}).get(key), manifest)

        def difference(spec: ReportSpec = spec) -> DataFrame:
            groups = published_groups(tables[spec.result_table], pub_result)
            return mismatch(groups, tables[spec.application_table], _forms(tables, manifest), spec, strict)

        def report(spec: ReportSpec = spec, gates: DataFrame = gates) -> DataFrame:
            return gated_run(tables, spec, pub_result, strict, gates, manifest=manifest)

        if manifest:
            out[key] = Run(gates, manifest.table(f"mismatch_{key}", difference), manifest.table(f"report_{key}", report))
        else:
            out[key] = Run(gates, difference(), report())
    return out


def annual_run(tables: ExamTables, pub_result: str | None, strict: bool = True,
               rules: dict[str, str] | None = None, manifest: RunManifest | None = None) -> dict[str, Run]:
    """The annual script: re-totalling and re-valuation for one publish date."""
    return layout_run(tables, "annual", pub_result, strict, rules, manifest)


def semester_run(tables: ExamTables, pub_result: str | None, strict: bool = True,
                 rules: dict[str, str] | None = None, manifest: RunManifest | None = None) -> dict[str, Run]:
    """The semester script: its two passes for one publish date."""
    return layout_run(tables, "semester", pub_result, strict, rules, manifest)
