"""Command line: the end-to-end jobs of the two source scripts.

    python -m retally run annual   --date 04/07/2024 --catalog exams --out /shared/reports
    python -m retally run semester --date 06/08/2024 --snapshot /shared/exam_snapshot --out ...
    python -m retally status annual --catalog exams
    python -m retally snapshot --dump /shared/dump --format csv --out /shared/exam_snapshot --buckets 0
    python -m retally import-payments --folder /shared/drops --table payment
    python -m retally register --folder /shared/admissions --table document_details

Exam tables come from a catalog database (``--catalog``), a parquet snapshot
folder (``--snapshot``) or are derived from TPC-H-like test tables
(``--tpch``).  ``run`` writes, per report: the gate table, the list mismatch,
the report itself as CSV (one folder per scrutiny type) and, with
``--stage``, the staging table.  The session is the one the deployment
configures (``spark-submit``); only without a master a local one is made.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from retally import schemas
from retally.plans import ingest, runs, status
from retally.sources.derived import exam_tables_from_tpch
from retally.sources.files import CSV_WRITE
from retally.sources.ledger import import_newest
from retally.sources.manifest import RunManifest
from retally.sources.sinks import export_report, stage_report
from retally.sources.snapshot import load_snapshot, write_snapshot
from retally.sources.tables import ExamTables
from retally.specs import REPORTS

# Output names of the source scripts' exports and staging tables.
EXPORT_NAMES = {
    "annual_rt": "annual_scrutiny_report_retotaling",
    "annual_rv": "annual_scrutiny_report_reval",
    "semester_rt": "semester_scrutiny_report_retotaling",
    "semester_rv": "semester_scrutiny_report_reval",
}
STAGING_TABLES = {"annual": "annual_scrutiny_report_temp", "semester": "scrutiny_report_temp"}


def _session() -> SparkSession:
    """The active or submitted session; a local one (UI off) when run as plain Python."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from pyspark import SparkConf
    if SparkConf().contains("spark.master"):          # launched by spark-submit
        return SparkSession.builder.appName("retally").getOrCreate()
    from retally.session import local_session
    return local_session()


def _tables(spark: SparkSession, args) -> ExamTables:
    if args.catalog is not None:
        return ExamTables.from_catalog(spark, args.catalog or None)
    if args.snapshot:
        return ExamTables.from_parquet(spark, args.snapshot)
    if args.tpch:
        return exam_tables_from_tpch(spark, args.tpch)
    raise SystemExit("give --catalog, --snapshot or --tpch")


def _add_source(p: argparse.ArgumentParser) -> None:
    p.add_argument("--catalog", help="catalog database holding the exam tables ('' = current)")
    p.add_argument("--snapshot", help="parquet snapshot folder (one dataset per table)")
    p.add_argument("--tpch", help="derive exam tables from TPC-H-like tables in this folder")


def cmd_run(args) -> None:
    spark = _session()
    t = _tables(spark, args)
    script = runs.annual_run if args.layout == "annual" else runs.semester_run
    rules = dict(r.split("=", 1) for r in args.gate)
    if unknown := set(rules) - {k for k, spec in REPORTS.items() if spec.layout == args.layout}:
        raise SystemExit(f"no such report in this layout: {', '.join(sorted(unknown))}")
    source = f"catalog {args.catalog}" if args.catalog is not None else args.snapshot or args.tpch
    run_key = f"{args.layout} {args.date} {sorted(rules.items())} {source}"
    manifest = RunManifest(spark, f"{args.out.rstrip('/')}/_run_{args.layout}", run_key)
    if args.afresh:
        manifest.close()
    for key, done in script(t, args.date, rules=rules, manifest=manifest).items():
        done.gates.write.mode("overwrite").parquet(f"{args.out}/gate_{key}")
        done.mismatch.write.mode("overwrite").parquet(f"{args.out}/mismatch_{key}")
        export_report(done.report, f"{args.out}/{EXPORT_NAMES[key]}")
        if args.stage:
            stage_report(done.report, f"{STAGING_TABLES[args.layout]}_{REPORTS[key].scrutiny_type}")
        print(f"{key}: report written to {args.out}/{EXPORT_NAMES[key]}")
    manifest.close()


def cmd_snapshot(args) -> None:
    spark = _session()
    if args.dump:
        load_snapshot(spark, args.dump, args.out, args.format, args.buckets, by_date=args.by_date)
    else:
        write_snapshot(_tables(spark, args), args.out, buckets=args.buckets, by_date=args.by_date)
    print(f"snapshot written to {args.out}")


def cmd_status(args) -> None:
    spark = _session()
    t = _tables(spark, args)
    table = "result_annual" if args.layout == "annual" else "result"
    rows = status.deadline_status(t[table], end_date_as_text=args.layout == "annual")
    if args.out:
        rows.write.mode("overwrite").options(**CSV_WRITE).csv(args.out)
        return
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():          # every group, a partition at a time
        print("\t".join("" if v is None else str(v) for v in row))


def cmd_import(args) -> None:
    if args.ledger:
        took = import_newest(_session(), args.folder, args.table, args.ledger, args.prefix, schemas.PAYMENT, args.format)
        print(f"{args.table}: {'nothing new' if took is None else took}")
        return
    ingest.import_payments(_session(), args.folder, args.table, args.prefix, args.format)


def cmd_register(args) -> None:
    ingest.record_files(_session(), args.folder, args.table, strict=not args.tolerant)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="retally")
    sub = ap.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("run", help="gate and write the reports of one publish date")
    p.add_argument("layout", choices=["annual", "semester"])
    p.add_argument("--date", required=True, help="publish date as stored, e.g. 04/07/2024")
    p.add_argument("--out", required=True, help="output folder (shared storage)")
    p.add_argument("--gate", action="append", default=[], metavar="REPORT=RULE",
                   help="gate rule of one report, e.g. annual_rv=equal (rules: equal, unequal)")
    p.add_argument("--stage", action="store_true", help="also replace the staging tables")
    p.add_argument("--afresh", action="store_true", help="forget what an earlier run with the same output that stopped has finished")
    _add_source(p)
    p.set_defaults(fn=cmd_run)

    p = sub.add_parser("snapshot", help="bring the exam tables in as a parquet snapshot")
    p.add_argument("--dump", help="dump folder with one dataset per table (read with explicit schemas)")
    p.add_argument("--format", default="parquet", help="format of the dump: parquet, csv, json, orc")
    p.add_argument("--out", required=True)
    p.add_argument("--buckets", type=int, default=None, help="bucket result/application tables by id (0: sized from the data)")
    p.add_argument("--by-date", action="store_true", help="file the result tables by publish date instead")
    _add_source(p)
    p.set_defaults(fn=cmd_snapshot)

    p = sub.add_parser("status", help="deadline status per group")
    p.add_argument("layout", choices=["annual", "semester"])
    p.add_argument("--out", help="write the table there as CSV instead of printing it")
    _add_source(p)
    p.set_defaults(fn=cmd_status)

    p = sub.add_parser("import-payments", help="replace the payment table with the newest drop")
    p.add_argument("--folder", required=True)
    p.add_argument("--table", default="payment")
    p.add_argument("--prefix", default="payments")
    p.add_argument("--format", default=None)
    p.add_argument("--ledger", help="dataset of drops seen: import only a drop that is new and the newest")
    p.set_defaults(fn=cmd_import)

    p = sub.add_parser("register", help="append the admission files of a folder to the register")
    p.add_argument("--folder", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--tolerant", action="store_true")
    p.set_defaults(fn=cmd_register)

    args = ap.parse_args(argv)
    args.fn(args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
