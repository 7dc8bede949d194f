"""Property test: the single-pass report equals the per-slot UNION form on random tiny tables."""

import datetime as dt

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from oracles.sql import _report_body
from retally.plans.report import scrutiny_report
from retally.sources.tables import ALL_TABLES
from retally.specs import REPORTS, annual_slots
from tests.fixtures import pay_row, tables
from tools.oracle_check import _bag

ANNUAL, SEMESTER = [s.name for s in annual_slots()], list(range(1, 13))
NAMES = st.sampled_from([None, "Maths", "Physics"])
CODES = st.sampled_from([None, "M1", "P1"])
MARKS = st.sampled_from([None, 5, 7])
SOME = 6          # slots filled per form and layout, drawn from all of them


@st.composite
def exam(draw):
    n = draw(st.integers(1, 6))
    annual, semester, annual_results, results, payment = [], [], [], [], []
    for i in range(1, n + 1):
        app = dict(id=i, scanno=draw(st.sampled_from([i, 1, None])), ansidrno="A", enrollment_no="E",
                   course="C", semyr_code="1", name="N", fname="F",
                   payment_status=draw(st.sampled_from(["0300", "0300", "0399"])), centrename="X",
                   centrecode=1, subcode=draw(st.sampled_from(["S1", "S2"])), app_date=dt.date(2024, 7, 1),
                   retotaling_status=draw(st.sampled_from(["Y", "Y", "N"])))
        res = dict(id=i if draw(st.booleans()) or i == 1 else i + 100, course="C", subcode="S1", semyr="1",
                   semyr_code="1", pub_result="04/07/2024")
        form, result = dict(app), dict(res)
        for s in draw(st.lists(st.sampled_from(ANNUAL), min_size=1, max_size=SOME, unique=True)):
            form |= {s: draw(NAMES), s + "code": draw(CODES), s + "_th": draw(MARKS)}
            result |= {s: draw(NAMES), s + "code": draw(CODES)}
        annual.append(form)
        annual_results.append(result)
        form, result = dict(app), dict(res)
        for k in draw(st.lists(st.sampled_from(SEMESTER), min_size=1, max_size=SOME, unique=True)):
            form |= {f"sub{k}": draw(NAMES), f"sub{k}_retotaling": draw(st.sampled_from(["true", "true", "false", None])),
                     f"sub{k}p1_th": draw(MARKS)}
            result |= {f"sub{k}p1": draw(NAMES), f"sub{k}p1code": draw(CODES)}
        semester.append(form)
        results.append(result)
        for purpose in ("RETOT", "REVAL"):
            if draw(st.booleans()):
                payment.append(pay_row(draw(st.sampled_from([i, i, 1])), purpose, "C", "1s", draw(st.sampled_from(["captured", "captured", "failed"]))))
    history = [dict(scanno=draw(st.sampled_from(["1", "2", " 3 ", None])), scrutiny_type=draw(st.sampled_from(["rt", "rv"])))
               for _ in range(draw(st.integers(0, 3)))]
    return annual, semester, annual_results, results, payment, history


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck), database=None)
@given(data=exam())
def test_report_equals_union_form(spark, data):
    annual, semester, annual_results, results, payment, history = data
    t = tables(spark, result_annual=annual_results, result=results, annual_rt=annual, annual_rv=annual, semester_rt=semester,
               semester_rv=semester, payment=payment, annual_history=history, semester_history=history)
    con = duckdb.connect()
    for name in ALL_TABLES:
        con.register(name + "_arrow", t[name].toArrow())     # Arrow keeps nullable int types
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_arrow")
    for key in REPORTS:
        got = scrutiny_report(t, REPORTS[key])
        rel = con.execute(_report_body(key))
        ocols, orows = [d[0] for d in rel.description], rel.fetchall()
        assert _bag(got.columns, [tuple(r) for r in got.collect()]) == _bag(ocols, orows), key
