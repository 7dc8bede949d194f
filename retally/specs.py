"""Slot layouts and the parameter rows of the four scrutiny reports.

A *slot* is one paper position of a wide result / application row.  The four
reports differ only in data, so one builder serves them all (see
``retally.plans.report``).
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's layout and codes).
#
# Papers per subject in the annual layout, subjects 1..12:
#   3, 3, 4, 4, 4, 4, 3, 3, 3, 3, 3, 3          (40 slots, sub<N>p<M>)
# The semester layout uses paper 1 of subjects 1..12 (12 slots, sub<N>p1).
# Payment purposes: RETOT_ANNUAL, REVAL_ANNUAL, RETOT, REVAL.
# Semester-code suffix in payment notes: "y" (annual), "s" (semester).
# Accepted application: payment_status "0300", retotaling_status "Y".
# Captured payment: status "captured".  Applied semester flag: "true".
# Scrutiny types: "rt" (re-totalling), "rv" (re-valuation).
# Staged report columns, in this order:
#   scanno, ansidrno, enrollment_no, course, semyr_code, name, fname,
#   payment_status, centrename, centrecode, subcode, paper, papercode, marks,
#   app_date, scrutiny_type
# ---------------------------------------------------------------------------
ANNUAL_PAPERS_PER_SUBJECT = (3, 3, 4, 4, 4, 4, 3, 3, 3, 3, 3, 3)
SEMESTER_SUBJECTS = 12

PAID_STATUS = "0300"
APPLIED_STATUS = "Y"
CAPTURED = "captured"
FLAG_TRUE = "true"

REPORT_COLUMNS = (
    "scanno", "ansidrno", "enrollment_no", "course", "semyr_code", "name", "fname",
    "payment_status", "centrename", "centrecode", "subcode", "paper", "papercode", "marks",
    "app_date", "scrutiny_type",
)
HEADER_COLUMNS = REPORT_COLUMNS[:11]
GROUP_COLUMNS = ("course", "subcode", "semyr_code")


@dataclass(frozen=True)
class Slot:
    index: int          # 0-based position in the layout
    subject: int        # N of sub<N>p<M>
    paper: int          # M of sub<N>p<M>

    @property
    def name(self) -> str:
        return f"sub{self.subject}p{self.paper}"


def annual_slots() -> tuple[Slot, ...]:
    out, i = [], 0
    for subject, papers in enumerate(ANNUAL_PAPERS_PER_SUBJECT, start=1):
        for paper in range(1, papers + 1):
            out.append(Slot(i, subject, paper))
            i += 1
    return tuple(out)


def semester_slots() -> tuple[Slot, ...]:
    return tuple(Slot(i, i + 1, 1) for i in range(SEMESTER_SUBJECTS))


def slots_for(layout: str) -> tuple[Slot, ...]:
    return annual_slots() if layout == "annual" else semester_slots()


@dataclass(frozen=True)
class ReportSpec:
    """One scrutiny report: which tables, which keep rule, which gate."""

    key: str
    layout: str                     # "annual" (40 slots) | "semester" (12 slots)
    application_table: str
    result_table: str
    history_table: str
    scrutiny_type: str              # literal of the last report column
    purpose: str                    # payment notes.pay_for
    sem_suffix: str                 # notes.sem = semyr_code || suffix
    history_types: tuple[str, ...] | None   # None: exclude forms reported with any type
    payment_semi_join: bool         # report rows must have a captured payment
    gate: str                       # "equal": paid == accepted > 0; "unequal": both > 0 and differ
    or_slots: tuple[str, ...] = ()  # slots whose applied test is name OR code (annual only)

    @property
    def slots(self) -> tuple[Slot, ...]:
        return slots_for(self.layout)


REPORTS: dict[str, ReportSpec] = {
    "annual_rt": ReportSpec(
        key="annual_rt", layout="annual",
        application_table="result_annual_retotaling", result_table="result_annual",
        history_table="annual_scrutiny_report", scrutiny_type="rt",
        purpose="RETOT_ANNUAL", sem_suffix="y", history_types=("rt",),
        payment_semi_join=False, gate="equal"),
    "annual_rv": ReportSpec(
        key="annual_rv", layout="annual",
        application_table="result_annual_reval", result_table="result_annual",
        history_table="annual_scrutiny_report", scrutiny_type="rv",
        purpose="REVAL_ANNUAL", sem_suffix="y", history_types=("rv",),
        payment_semi_join=False, gate="unequal", or_slots=("sub1p1",)),
    "semester_rt": ReportSpec(
        key="semester_rt", layout="semester",
        application_table="result_retotaling", result_table="result",
        history_table="scrutiny_report", scrutiny_type="rt",
        purpose="RETOT", sem_suffix="s", history_types=None,
        payment_semi_join=True, gate="equal"),
    "semester_rv": ReportSpec(
        key="semester_rv", layout="semester",
        application_table="result_reval", result_table="result",
        history_table="scrutiny_report", scrutiny_type="rv",
        purpose="REVAL", sem_suffix="s", history_types=("rv",),
        payment_semi_join=True, gate="equal"),
}
