"""File register (E17), newest drop (E18), payment import, staging and export."""

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from retally import schemas
from retally.plans.ingest import file_register, import_payments, latest_drop, record_files
from retally.sources.sinks import export_report, stage_report
from retally.sources.snapshot import write_snapshot
from tests.fixtures import frame, tables


def _touch(folder, name, text="x", mtime=None):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return path


def test_register_real_folder(spark):
    d = tempfile.mkdtemp(prefix="reg-")
    _touch(d, "admission_approval 12 2024.pdf")
    _touch(d, "admission_approval 7 01-02-2024.pdf")
    _touch(d, "payments 1 2.csv")
    got = sorted((r.lable, r.coll_code, r.date) for r in file_register(spark, d).collect())
    assert got == [("admission_approval", 7, "01-02-2024.pdf"), ("admission_approval", 12, "2024.pdf")]
    assert {r.src_location for r in file_register(spark, d).collect()} == {d}


def test_register_e17_too_few_tokens(spark):
    d = tempfile.mkdtemp(prefix="reg-")
    _touch(d, "admission_approval 12")
    _touch(d, "other_prefix")                 # another first token: skipped, never split further
    with pytest.raises(Exception):
        file_register(spark, d).collect()
    got = [(r.lable, r.coll_code, r.date) for r in file_register(spark, d, strict=False).collect()]
    assert got == [("admission_approval", 12, None)]


def test_record_files_appends(spark):
    d = tempfile.mkdtemp(prefix="reg-")
    _touch(d, "admission_approval 1 a.pdf")
    spark.sql("DROP TABLE IF EXISTS register_t")
    record_files(spark, d, "register_t")
    record_files(spark, d, "register_t")
    assert spark.table("register_t").count() == 2


def test_e18_newest_payment_drop_wins(spark):
    d = tempfile.mkdtemp(prefix="drop-")
    now = time.time()
    hdr = "description,status,notes\n"
    _touch(d, "payments a.csv", hdr + '1,captured,"{""sem"": ""1y""}"\n', now - 300)
    _touch(d, "payments b.csv", hdr + '2,captured,"{""sem"": ""1y""}"\n3,captured,{}\n', now - 100)
    _touch(d, "payments c.csv", hdr + '4,captured,{}\n', now - 200)
    _touch(d, "zz newest other.csv", hdr + '9,captured,{}\n', now)
    got = sorted((r.description, r.notes) for r in latest_drop(spark, d, "payments", schemas.PAYMENT).collect())
    assert got == [("2", '{"sem": "1y"}'), ("3", "{}")]
    spark.sql("DROP TABLE IF EXISTS payment_t")
    import_payments(spark, d, "payment_t")
    assert sorted(r.description for r in spark.table("payment_t").collect()) == ["2", "3"]
    with pytest.raises(FileNotFoundError):
        latest_drop(spark, d, "nothing_like_this")


def _report(spark):
    rows = [dict(scanno=1, ansidrno="A", enrollment_no="E", course="C", semyr_code="1", name="N", fname="F",
                 payment_status="0300", centrename="X", centrecode=3, subcode="S", paper=None, papercode="P",
                 marks=12, app_date="04/07/2024", scrutiny_type="rt"),
            dict(scanno=2, ansidrno="A2", enrollment_no="E2", course="C", semyr_code="1", name="N, with comma",
                 fname="F", payment_status="0300", centrename="X", centrecode=3, subcode="S", paper="Maths",
                 papercode="P", marks=None, app_date="04/07/2024", scrutiny_type="rv")]
    return frame(spark, schemas.REPORT, rows)


def test_export_round_trip(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="exp-"), "report")
    rep = _report(spark)
    export_report(rep, out)
    assert sorted(n for n in os.listdir(out) if n.startswith("scrutiny_type=")) == \
        ["scrutiny_type=rt", "scrutiny_type=rv"]
    back = spark.read.schema(schemas.REPORT).option("header", True).csv(out)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rep.collect()))


def test_stage_report_replaces_by_position(spark):
    spark.sql("DROP TABLE IF EXISTS staging_t")
    rep = _report(spark)
    stage_report(rep, "staging_t")
    stage_report(rep.where("scanno = 1"), "staging_t")      # the reset: only the latest report remains
    assert [r.scanno for r in spark.table("staging_t").collect()] == [1]
    with pytest.raises(ValueError):
        stage_report(rep.select("scanno"), "staging_t")


def test_snapshot_round_trip_bucketed(spark):
    t = tables(spark, result_annual=[dict(id=1, course="C", subcode="S", semyr="1", semyr_code="1",
                                          pub_result="04/07/2024", sub1p1="M", sub1p1code="1")])
    folder = tempfile.mkdtemp(prefix="snap-")
    spark.sql("DROP TABLE IF EXISTS result_annual")
    snap = write_snapshot(t, folder, names=["result_annual", "payment"], buckets=4)
    assert snap["result_annual"].count() == 1 and snap["payment"].count() == 0
    info = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED result_annual").collect()}
    assert info.get("Num Buckets") == "4" and info.get("Bucket Columns") == "[`id`]"


def test_load_snapshot_from_csv_dump(spark, tmp_path):
    """J3: a CSV dump read with explicit schemas gives the same report as the source tables."""
    from retally.plans.report import scrutiny_report
    from retally.sources.derived import exam_tables_from_tpch
    from retally.sources.files import CSV_WRITE
    from retally.sources.snapshot import load_snapshot
    from retally.sources.tables import ALL_TABLES
    from retally.specs import REPORTS

    src = exam_tables_from_tpch(spark, "/root/testdata/sf0.001")
    dump = str(tmp_path / "dump")
    for name in ALL_TABLES:
        src[name].write.options(**CSV_WRITE).csv(f"{dump}/{name}")
    snap = load_snapshot(spark, dump, str(tmp_path / "snap"), fmt="csv")
    for key in ("annual_rv", "semester_rt"):
        want = sorted(map(tuple, scrutiny_report(src, REPORTS[key]).collect()), key=repr)
        got = sorted(map(tuple, scrutiny_report(snap, REPORTS[key]).collect()), key=repr)
        assert got == want and len(got) > 0, key


def test_drop_written_by_pandas_is_read_by_column_name(spark):
    """Other column order, extra columns, quotes and line breaks in values, glob characters in the name, a subfolder."""
    import pandas as pd

    d = tempfile.mkdtemp(prefix="drop-")
    notes = ['{"sem": "1y", "course": "C1", "pay_for": "RETOT_ANNUAL"}', '{"sem": "2y",\n "course": "C \\"x\\"", "pay_for": "REVAL"}']
    frame_ = pd.DataFrame({"id": ["pay_1", "pay_2"], "notes": notes, "status": "captured", "description": ["11", " 12 "], "email": "a@b"})
    frame_.to_csv(f"{d}/payments [1].csv", index=False)
    os.mkdir(f"{d}/year=2024")
    _touch(f"{d}/year=2024", "payments later.csv", "description,status,notes\n99,captured,{}\n", time.time() + 50)
    got = latest_drop(spark, d, "payments", schemas.PAYMENT)
    assert got.columns == ["description", "status", "notes", "id", "email"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(
        (x, "captured", n, i, "a@b") for x, n, i in zip(frame_.description, notes, frame_.id))
    from retally.plans.reconcile import paid_list
    assert sorted(tuple(r) for r in paid_list(got).collect()) == [
        ("RETOT_ANNUAL", "C1", "1y", "11"), ("REVAL", 'C "x"', "2y", " 12 ")]
    _touch(d, "payments z.csv", "description,status\n1,captured\n", time.time() + 99)
    with pytest.raises(ValueError, match="notes"):
        latest_drop(spark, d, "payments", schemas.PAYMENT)


def test_export_keeps_quotes_newlines_and_blanks(spark):
    from retally.sources.sinks import read_export

    out = os.path.join(tempfile.mkdtemp(prefix="exp-"), "report")
    rep = _report(spark).withColumn("name", F.lit(' a "quoted" name,\nnext line \\ '))
    export_report(rep, out)
    assert sorted(map(tuple, read_export(spark, out).collect())) == sorted(map(tuple, rep.collect()))
    import csv
    import glob
    rows = [r for f in glob.glob(f"{out}/*/*.csv") for r in csv.DictReader(open(f, newline=""))]
    assert {r["name"] for r in rows} == {' a "quoted" name,\nnext line \\ '}


def test_dump_options_keep_the_header(spark, tmp_path):
    from retally.sources.snapshot import read_source

    _touch(tmp_path, "h.csv", 'scrutiny_type;scanno\nrt;"1"\n')
    got = read_source(spark, str(tmp_path / "h.csv"), "csv", schemas.HISTORY, {"sep": ";"})
    assert [tuple(r) for r in got.collect()] == [("1", "rt")]
