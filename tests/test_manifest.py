"""Runs that stop and are taken up again."""

import os

import pytest

from retally.plans import runs
from retally.plans.runs import annual_run, gated_run, semester_run
from retally.session import release_scratch
from retally.sources.derived import exam_tables_from_tpch
from retally.sources.manifest import RunManifest
from retally.sources.snapshot import write_snapshot
from retally.sources.tables import ExamTables
from retally.specs import REPORTS

SF, DATE = "/root/testdata/sf0.001", "01/01/1996"


@pytest.fixture(scope="module")
def snapshot(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("snap"))
    write_snapshot(exam_tables_from_tpch(spark, SF), folder)
    return folder


def rows(df):
    return sorted(map(repr, df.collect()))


def test_a_stopped_run_goes_on_without_the_parse(spark, snapshot, tmp_path, monkeypatch):
    tables, folder = ExamTables.from_parquet(spark, snapshot), str(tmp_path / "run")

    def stopped(*args, **more):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:                      # the run stops after the first gate
        m.setattr(runs, "mismatch", stopped)
        with pytest.raises(KeyboardInterrupt):
            annual_run(tables, DATE, manifest=RunManifest(spark, folder, "annual"))
    again = RunManifest(spark, folder, "annual")
    assert set(again.finished()) == {"captured_forms", "gate_annual_rt"}

    def no_parse(*args, **more):
        raise AssertionError("the payments are parsed a second time")

    monkeypatch.setattr(runs, "captured_payments", no_parse)
    fresh = ExamTables.from_parquet(spark, snapshot)      # as a new process would
    got = annual_run(fresh, DATE, manifest=again)
    assert again.built == ["mismatch_annual_rt", "report_annual_rt", "gate_annual_rv", "mismatch_annual_rv", "report_annual_rv"]
    for key in ("annual_rt", "annual_rv"):
        assert rows(got[key].report) == rows(gated_run(tables, REPORTS[key], DATE))
    third = RunManifest(spark, folder, "annual")
    annual_run(ExamTables.from_parquet(spark, snapshot), DATE, manifest=third)
    assert third.built == []


def test_another_run_key_starts_from_nothing(spark, snapshot, tmp_path):
    tables, folder = ExamTables.from_parquet(spark, snapshot), str(tmp_path / "run")
    semester_run(tables, DATE, manifest=RunManifest(spark, folder, "semester " + DATE))
    other = RunManifest(spark, folder, "semester 01/01/1995")
    assert other.finished() == {}
    other.close()
    assert not os.path.exists(folder)


def test_a_step_that_fails_is_not_entered(spark, tmp_path):
    manifest = RunManifest(spark, str(tmp_path / "run"), "k")
    with pytest.raises(Exception):
        manifest.table("bad", lambda: spark.sql("SELECT raise_error('broken') AS x"))
    assert manifest.finished() == {}
    assert manifest.table("bad", lambda: spark.range(2)).count() == 2
    assert manifest.table("bad", lambda: spark.range(9)).count() == 2


def test_results_of_a_run_survive_the_release_of_scratch(spark, snapshot, tmp_path):
    manifest = RunManifest(spark, str(tmp_path / "run"), "k")
    done = annual_run(ExamTables.from_parquet(spark, snapshot), DATE, manifest=manifest)
    release_scratch(spark)
    assert done["annual_rt"].report.count() > 0
