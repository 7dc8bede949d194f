"""Report semantics on hand-made rows (FIXTURES.md E1-E7, E14, quirks Q1, Q3, Q4)."""

from retally.plans.report import scrutiny_report
from retally.plans.runs import gated_run
from retally.specs import REPORTS
from tests.fixtures import app_row, pay_row, result_row, rows, tables

R = REPORTS


def _res(id_, **kw):
    return result_row(id_, sub1p1="Maths", sub1p1code="M1", sub1p2="Physics", sub1p2code="P1",
                      sub2p1="Chem", sub2p1code="C1", **kw)


def test_one_row_per_applied_paper_with_result_names(spark):
    t = tables(spark, result_annual=[_res(1)],
               annual_rt=[app_row(1, sub1p1="x", sub1p1code="y", sub1p1_th=33,
                                  sub2p1="x", sub2p1code="y", sub2p1_th=41)])
    got = rows(scrutiny_report(t, R["annual_rt"]), "scanno", "paper", "papercode", "marks", "app_date",
               "scrutiny_type")
    assert got == [(1, "Chem", "C1", 41, "10/07/2024", "rt"), (1, "Maths", "M1", 33, "10/07/2024", "rt")]


def test_e1_equal_slots_collapse(spark):
    # two slots whose result names, codes and marks are equal give one row (UNION)
    t = tables(spark, result_annual=[result_row(1, sub1p1="Maths", sub1p1code="M1", sub1p2="Maths",
                                                sub1p2code="M1")],
               annual_rt=[app_row(1, sub1p1="x", sub1p1code="y", sub1p1_th=5,
                                  sub1p2="x", sub1p2code="y", sub1p2_th=5)])
    assert scrutiny_report(t, R["annual_rt"]).count() == 1


def test_e2_code_missing_drops_except_annual_rv_sub1p1(spark):
    app = app_row(1, sub1p1="x", sub1p1_th=5, sub1p2="x", sub1p2_th=6)      # codes NULL
    t = tables(spark, result_annual=[_res(1)], annual_rt=[app], annual_rv=[app])
    assert scrutiny_report(t, R["annual_rt"]).count() == 0
    got = rows(scrutiny_report(t, R["annual_rv"]), "paper")
    assert got == [("Maths",)]                                                 # OR rule on sub1p1 only


def test_e3_null_result_name_kept(spark):
    t = tables(spark, result_annual=[result_row(1)],                           # no paper names at all
               annual_rt=[app_row(1, sub1p1="x", sub1p1code="y", sub1p1_th=5)])
    assert rows(scrutiny_report(t, R["annual_rt"]), "paper", "papercode") == [(None, None)]


def test_e4_form_without_result_row_dropped(spark):
    t = tables(spark, result_annual=[_res(2)], annual_rt=[app_row(1, sub1p1="x", sub1p1code="y")])
    assert scrutiny_report(t, R["annual_rt"]).count() == 0


def test_status_filters(spark):
    t = tables(spark, result_annual=[_res(1), _res(2)],
               annual_rt=[app_row(1, status="0399", sub1p1="x", sub1p1code="y"),
                          app_row(2, applied="N", sub1p1="x", sub1p1code="y")])
    assert scrutiny_report(t, R["annual_rt"]).count() == 0


def test_e5_semester_flag(spark):
    res = result_row(1, sub1p1="Maths", sub1p1code="M1", sub2p1="Chem", sub2p1code="C1")
    app = app_row(1, sub1="B", sub1_retotaling="true", sub1p1_th=7, sub2="B", sub2_retotaling="false")
    t = tables(spark, result=[res], semester_rt=[app], payment=[pay_row(1, "RETOT", sem="1s")])
    assert rows(scrutiny_report(t, R["semester_rt"]), "paper", "marks") == [("Maths", 7)]


def test_q4_semester_needs_captured_payment_annual_does_not(spark):
    res = result_row(1, sub1p1="Maths", sub1p1code="M1")
    t = tables(spark, result=[res], result_annual=[res],
               semester_rt=[app_row(1, sub1="B", sub1_retotaling="true")],
               annual_rt=[app_row(1, sub1p1="x", sub1p1code="y")],
               payment=[pay_row(1, "RETOT", status="failed")])
    assert scrutiny_report(t, R["semester_rt"]).count() == 0
    assert scrutiny_report(t, R["annual_rt"]).count() == 1


def test_e6_history_types(spark):
    res = result_row(1, sub1p1="Maths", sub1p1code="M1")
    sem_app = app_row(1, sub1="B", sub1_retotaling="true")
    ann_app = app_row(1, sub1p1="x", sub1p1code="y")
    hist = [dict(scanno="1", scrutiny_type="rv")]
    t = tables(spark, result=[res], result_annual=[res], semester_rt=[sem_app], semester_rv=[sem_app],
               annual_rt=[ann_app], payment=[pay_row(1, "RETOT", sem="1s"), pay_row(1, "REVAL", sem="1s")],
               annual_history=hist, semester_history=hist)
    assert scrutiny_report(t, R["annual_rt"]).count() == 1       # other type: kept
    assert scrutiny_report(t, R["semester_rt"]).count() == 0     # semester rt: any type excludes
    assert scrutiny_report(t, R["semester_rv"]).count() == 0     # own type excludes


def test_e7_null_scanno_in_history_empties_report(spark):
    t = tables(spark, result_annual=[_res(1)], annual_rt=[app_row(1, sub1p1="x", sub1p1code="y")],
               annual_history=[dict(scanno=None, scrutiny_type="rt")])
    assert scrutiny_report(t, R["annual_rt"]).count() == 0


def test_e14_groups_differing_in_course_insert_twice(spark):
    res = [_res(1, course="C1"), _res(2, course="C2")]
    apps = [app_row(1, course="C1", sub1p1="x", sub1p1code="y"), app_row(2, course="C2", sub1p1="x", sub1p1code="y")]
    pays = [pay_row(1, "RETOT_ANNUAL", course="C1"), pay_row(2, "RETOT_ANNUAL", course="C2")]
    t = tables(spark, result_annual=res, annual_rt=apps, payment=pays)
    # each group: paid 1 (its course) and accepted 2 (subcode S1 / semyr 1 hold both forms) -> mismatch
    assert gated_run(t, R["annual_rt"], "04/07/2024").count() == 0
    # re-valuation runs on *unequal* non-zero counts: both groups pass, each inserts both rows
    t2 = tables(spark, result_annual=res, annual_rv=apps,
                payment=[pay_row(1, "REVAL_ANNUAL", course="C1"), pay_row(2, "REVAL_ANNUAL", course="C2")])
    assert gated_run(t2, R["annual_rv"], "04/07/2024").count() == 4


def test_e20_no_groups_empty_report(spark):
    t = tables(spark, result_annual=[_res(1)], annual_rt=[app_row(1, sub1p1="x", sub1p1code="y")],
               payment=[pay_row(1, "RETOT_ANNUAL")])
    assert gated_run(t, R["annual_rt"], "01/01/1900").count() == 0
    assert gated_run(t, R["annual_rt"], "04/07/2024").count() == 1
