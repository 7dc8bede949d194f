"""The set-oriented gated run equals a literal group-by-group loop."""

from pyspark.sql import functions as F

from retally.plans.reconcile import accepted_list, paid_list
from retally.plans.report import scrutiny_report
from retally.plans.runs import gated_run
from retally.plans.status import published_groups
from retally.sources.derived import exam_tables_from_tpch
from retally.specs import REPORTS

SF = "/root/testdata/sf0.001"


def _loop(t, spec, date):
    """The source's control flow, one group at a time (test-only, tiny data)."""
    out = []
    groups = published_groups(t[spec.result_table], date).collect()
    for g in groups:
        paid = (paid_list(t["payment"], spec.purpose)
                .where((F.col("course") == g.course) & (F.col("sem") == g.semyr_code + spec.sem_suffix))
                .count())
        acc = (accepted_list(t[spec.application_table], t["payment"], spec.purpose)
               .where((F.col("subcode") == g.subcode) & (F.col("semyr_code") == g.semyr_code)).count())
        run = (paid == acc and paid != 0) if spec.gate == "equal" else (paid != acc and paid != 0 and acc != 0)
        if run:
            rep = scrutiny_report(t, spec).where((F.col("subcode") == g.subcode)
                                                 & (F.col("semyr_code") == g.semyr_code))
            out += [tuple(r) for r in rep.collect()]
    return sorted(out, key=repr)


def test_loop_equivalence_all_reports(spark):
    t = exam_tables_from_tpch(spark, SF)
    date = "01/01/1996"
    for key, spec in REPORTS.items():
        got = sorted((tuple(r) for r in gated_run(t, spec, date).collect()), key=repr)
        assert got == _loop(t, spec, date), key
