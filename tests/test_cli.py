"""The command-line run writes gate, mismatch and report outputs; the report equals the gated run."""

import os

from retally import schemas
from retally.__main__ import main
from retally.plans.runs import gated_run
from retally.sources.derived import exam_tables_from_tpch
from retally.specs import REPORTS

SF = "/root/testdata/sf0.001"


def test_cli_run_semester(spark, tmp_path):
    out = str(tmp_path / "reports")
    assert main(["run", "semester", "--date", "01/01/1996", "--tpch", SF, "--out", out]) == 0
    assert {"gate_semester_rt", "gate_semester_rv", "mismatch_semester_rt", "mismatch_semester_rv",
            "semester_scrutiny_report_retotaling", "semester_scrutiny_report_reval"} <= set(os.listdir(out))
    back = spark.read.schema(schemas.REPORT).option("header", True).csv(f"{out}/semester_scrutiny_report_reval")
    want = gated_run(exam_tables_from_tpch(spark, SF), REPORTS["semester_rv"], "01/01/1996")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_local_sessions_keep_the_ui_off(spark):
    assert spark.conf.get("spark.ui.enabled") == "false"
    from retally.__main__ import _session
    assert _session().conf.get("spark.ui.enabled") == "false"
