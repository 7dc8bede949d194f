"""Gate counts and classes (FIXTURES.md E8-E13, quirks Q2, Q5, Q6)."""

from retally.plans.reconcile import gate, mismatch
from retally.plans.status import published_groups
from retally.specs import REPORTS
from tests.fixtures import app_row, pay_row, result_row, rows, tables

RT, RV = REPORTS["annual_rt"], REPORTS["annual_rv"]


def _gate(t, spec):
    g = gate(published_groups(t[spec.result_table], "04/07/2024"), t[spec.application_table], t["payment"], spec)
    return rows(g, "course", "paid_n", "accepted_n", "gate_class", "passed")


def test_e8_captured_but_not_paid_in_form(spark):
    t = tables(spark, result_annual=[result_row(1)], annual_rt=[app_row(1, status="0399")],
               payment=[pay_row(1, "RETOT_ANNUAL")])
    assert _gate(t, RT) == [("C1", 1, 0, "mismatch", False)]


def test_e9_paid_twice_counted_once(spark):
    t = tables(spark, result_annual=[result_row(1)], annual_rt=[app_row(1)],
               payment=[pay_row(1, "RETOT_ANNUAL"), pay_row(1, "RETOT_ANNUAL")])
    assert _gate(t, RT) == [("C1", 1, 1, "match", True)]


def test_e10_two_forms_one_scanno_counted_twice(spark):
    t = tables(spark, result_annual=[result_row(1)], annual_rt=[app_row(1), app_row(2, scanno=1)],
               payment=[pay_row(1, "RETOT_ANNUAL")])
    assert _gate(t, RT) == [("C1", 1, 2, "mismatch", False)]


def test_e11_other_semester_payment_admits_but_does_not_count(spark):
    t = tables(spark, result_annual=[result_row(1)], annual_rt=[app_row(1)],
               payment=[pay_row(1, "RETOT_ANNUAL", sem="2y")])
    assert _gate(t, RT) == [("C1", 0, 1, "mismatch", False)]


def test_e12_both_zero(spark):
    t = tables(spark, result_annual=[result_row(1)])
    assert _gate(t, RT) == [("C1", 0, 0, "none", False)]


def test_e13_reval_runs_on_unequal(spark):
    t = tables(spark, result_annual=[result_row(1)], annual_rv=[app_row(1), app_row(2, scanno=1)],
               payment=[pay_row(1, "REVAL_ANNUAL")])
    assert _gate(t, RV) == [("C1", 1, 2, "mismatch", True)]
    t2 = tables(spark, result_annual=[result_row(1)], annual_rv=[app_row(1)], payment=[pay_row(1, "REVAL_ANNUAL")])
    assert _gate(t2, RV) == [("C1", 1, 1, "match", False)]


def test_mismatch_sides(spark):
    t = tables(spark, result_annual=[result_row(1)], annual_rt=[app_row(1), app_row(2, status="0399")],
               payment=[pay_row(1, "RETOT_ANNUAL"), pay_row(2, "RETOT_ANNUAL"), pay_row(3, "RETOT_ANNUAL"),
                        pay_row(4, "RETOT_ANNUAL", sem="2y")])
    got = rows(mismatch(t["result_annual"], t["result_annual_retotaling"], t["payment"], RT), "scanno", "side")
    assert got == [(2, "paid_only"), (3, "paid_only")]


def test_one_pass_versions_equal_per_purpose_versions(spark):
    """accepted_for_purposes / mismatch_for_purposes equal the per-purpose functions, unioned."""
    from retally.plans.reconcile import accepted_for_purposes, accepted_list, mismatch_for_purposes
    from retally.sources.derived import exam_tables_from_tpch

    t = exam_tables_from_tpch(spark, "/root/testdata/sf0.001")
    specs = list(REPORTS.values())
    one = accepted_for_purposes([(t[s.application_table], s.purpose) for s in specs], t["payment"])
    per = [accepted_list(t[s.application_table], t["payment"], s.purpose) for s in specs]
    want = sorted((tuple(r) for df in per for r in df.collect()), key=repr)
    assert sorted((tuple(r) for r in one.collect()), key=repr) == want

    groups = {"annual": t["result_annual"], "semester": t["result"]}
    one = mismatch_for_purposes(specs, groups, {s.key: t[s.application_table] for s in specs}, t["payment"])
    per = [mismatch(t[s.result_table], t[s.application_table], t["payment"], s) for s in specs]
    want = sorted((tuple(r) for df in per for r in df.collect()), key=repr)
    got = sorted((tuple(r) for r in one.collect()), key=repr)
    assert got == want and len(got) > 0


def _with(row, **changes):
    return {**row, **changes}


def test_payments_of_other_purposes_may_carry_any_text(spark):
    """A text description of another purpose never reaches the cast; one of the own purpose fails loudly (E16)."""
    import pytest

    from retally.plans.reconcile import accepted_for_purposes, mismatch_for_purposes
    from retally.plans.report import scrutiny_report
    from retally.plans.runs import gated_run

    other = _with(pay_row(1, "ADMISSION"), description="Admission fee 2024")
    res = result_row(1, sub1p1="Maths", sub1p1code="M1")
    app, sem = app_row(1, sub1p1="x", sub1p1code="y"), app_row(1, sub1="B", sub1_retotaling="true")

    def made(*extra):
        return tables(spark, result_annual=[res], result=[res], annual_rt=[app], semester_rt=[sem],
                      payment=[pay_row(1, "RETOT_ANNUAL"), pay_row(1, "RETOT", sem="1s"), *extra])

    t = made(other)
    assert _gate(t, RT) == [("C1", 1, 1, "match", True)]
    pairs = [(t[s.application_table], s.purpose) for s in REPORTS.values()]
    assert accepted_for_purposes(pairs, t["payment"]).count() == 2
    groups = {"annual": t["result_annual"], "semester": t["result"]}
    assert mismatch_for_purposes(list(REPORTS.values()), groups, {s.key: t[s.application_table] for s in REPORTS.values()},
                                 t["payment"]).count() == 0
    assert scrutiny_report(t, REPORTS["semester_rt"]).count() == 1
    assert gated_run(t, RT, "04/07/2024").count() == 1
    with pytest.raises(Exception, match="not an integer"):
        scrutiny_report(made(_with(pay_row(1, "RETOT", sem="1s"), description="fee")), REPORTS["semester_rt"]).collect()


def test_null_description_is_an_entry_of_the_list(spark):
    t = tables(spark, result_annual=[result_row(1)], annual_rt=[app_row(1)],
               payment=[pay_row(1, "RETOT_ANNUAL"), _with(pay_row(1, "RETOT_ANNUAL"), description=None),
                        _with(pay_row(1, "RETOT_ANNUAL"), notes="{broken")])
    assert _gate(t, RT) == [("C1", 2, 1, "mismatch", False)]
    from retally.plans.reconcile import paid_counts
    assert rows(paid_counts(t["payment"])) == [("RETOT_ANNUAL", "C1", "1y", 2)]


def test_gate_rule_can_be_chosen(spark):
    t = tables(spark, result_annual=[result_row(1)], annual_rv=[app_row(1)], payment=[pay_row(1, "REVAL_ANNUAL")])
    g = gate(published_groups(t["result_annual"], "04/07/2024"), t["result_annual_reval"], t["payment"], RV, rule="equal")
    assert rows(g, "passed") == [(True,)]
