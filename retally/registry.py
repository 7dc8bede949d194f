"""Registered jobs and queries over the test tables.

``JOBS``     name -> (spark, exam tables, sf_dir) -> DataFrame: one job of the
             library, run over whole tables.
``QUERIES``  name -> (spark, sf_dir) -> DataFrame: the same jobs with the exam
             tables derived in-plan from the TPC-H-like tables of ``sf_dir``
             (``retally.sources.derived``).  ``oracles/sql.py`` holds the
             matching DuckDB SQL.

The bench runs ``JOBS`` over a written snapshot of the exam tables instead,
which is how the jobs meet their data in production.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from retally import schemas
from retally.operators.bitmaps import key_bitmaps
from retally.operators.membership import is_in, not_in
from retally.plans import ingest, reconcile, rejects, report, runs, status
from retally.session import scratch_path
from retally.sources.derived import exam_tables_from_tpch
from retally.sources.files import CSV_WRITE
from retally.sources.ledger import import_newest
from retally.sources.sinks import append_table, checkpointed, export_report, read_export, stage_report
from retally.sources.snapshot import dump_tables, load_snapshot, stored_checksums, write_dump, write_snapshot
from retally.sources.tables import RESULT_TABLES, ExamTables
from retally.specs import GROUP_COLUMNS, REPORTS

Job = Callable[[SparkSession, ExamTables, str], DataFrame]
Query = Callable[[SparkSession, str], DataFrame]

# Publish date of the reference run in the tests (first day of 1996).
RUN_DATE = "01/01/1996"


def _union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def register_names(customer: DataFrame) -> DataFrame:
    """File names built from customer rows (test listing for the register).

    "<label> <nation key> <d>-<m>-2024.pdf", label "admission_approval" for
    three market segments and "fee_receipt" for the others.
    """
    label = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "AUTOMOBILE"),
                   F.lit("admission_approval")).otherwise(F.lit("fee_receipt"))
    day = (F.col("c_custkey") % 28 + 1).cast("string")
    month = (F.col("c_custkey") % 12 + 1).cast("string")
    return customer.select(F.concat_ws(" ", label, F.col("c_nationkey").cast("string"),
                                       F.concat(day, F.lit("-"), month, F.lit("-2024.pdf"))).alias("file_name"))


def _file_register(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return ingest.register_entries(register_names(customer), "customer.parquet")


def _latest_drop(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
    # The data folder itself is the drop folder; the newest "orders*" file is read.
    return ingest.latest_drop(spark, sf_dir, prefix="orders")


def _snapshot_load(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
    snap = write_snapshot(t, scratch_path(spark, "snapshot"), names=["result_annual"])
    return snap["result_annual"]


# Columns of the typed drop that ``import_replace`` writes and reads.
ORDER_DROP = StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
                         StructField("o_orderstatus", StringType()), StructField("o_orderpriority", StringType())])


def _csv_drop(rows: DataFrame, folder: str, name: str) -> None:
    """A drop as a folder of CSV part files."""
    rows.write.options(**CSV_WRITE).csv(f"{folder}/{name}")


def _version_rows(spark: SparkSession, table: str) -> DataFrame:
    """The table's rows after its entry is gone: an external table leaves its files."""
    rows, location = spark.table(table), spark.table(table).inputFiles()
    kept = spark.read.schema(rows.schema).parquet(*location)
    spark.sql(f"DROP TABLE {table}")
    return kept


def _import_replace(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
    """A drop of order rows is imported; the next one has text for order keys and fails; the rows stay."""
    folder, ledger = scratch_path(spark, "drops"), scratch_path(spark, "ledger")
    table, path = f"retally_import_{uuid.uuid4().hex}", scratch_path(spark, "imports")
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(*ORDER_DROP.names)
    _csv_drop(rows, folder, "payments 1.csv")
    import_newest(spark, folder, table, ledger, schema=ORDER_DROP, path=path)
    spoilt = F.when(F.col("o_custkey") % 2 == 0, F.lit("n/a")).otherwise(F.col("o_orderkey").cast("string"))
    _csv_drop(rows.withColumn("o_orderkey", spoilt), folder, "payments 2.csv")
    try:
        import_newest(spark, folder, table, ledger, schema=ORDER_DROP, path=path)
    except PySparkException:
        return _version_rows(spark, table)
    raise AssertionError("a drop with text for order keys was imported")


def _drop_ledger(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
    """The payments by the ledger: an older drop, then the newer one, then nothing new."""
    folder, ledger = scratch_path(spark, "drops"), scratch_path(spark, "ledger")
    table, path = f"retally_payment_{uuid.uuid4().hex}", scratch_path(spark, "imports")
    payment = t["payment"].select(*schemas.PAYMENT.names)
    _csv_drop(payment.withColumn("status", F.lit("attempted")), folder, "payments of May.csv")
    import_newest(spark, folder, table, ledger, schema=schemas.PAYMENT, path=path)
    _csv_drop(payment.select("notes", "description", F.lit("x").alias("email"), "status"), folder, "payments of April.csv")
    import_newest(spark, folder, table, ledger, schema=schemas.PAYMENT, path=path)
    if import_newest(spark, folder, table, ledger, schema=schemas.PAYMENT, path=path) is not None:
        raise AssertionError("a drop was imported twice")
    return _version_rows(spark, table).select(*schemas.PAYMENT.names)


def _snapshot_tables(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
    """All nine tables dumped as parquet and as CSV, loaded and checked: rows and checksum of each stored table.

    The tables are derived for the parquet dump; the CSV dump is written from that one.
    """
    out = []
    for fmt in ("parquet", "csv"):
        dump, target = scratch_path(spark, "dump"), scratch_path(spark, "snapshot")
        write_dump(t, dump, fmt)
        if fmt == "parquet":
            t = dump_tables(spark, dump)
        loaded = load_snapshot(spark, dump, target, fmt, by_date=fmt == "csv")
        out.append(stored_checksums(loaded).select(F.lit(fmt).alias("fmt"), "table_name", "rows", "checksum"))
    return _union_all(out)


def _published_dated(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
    """Groups of the run date from result tables that are filed by publish date."""
    snap = write_snapshot(t, scratch_path(spark, "dated"), names=RESULT_TABLES, by_date=True)
    return _union_all([status.published_groups(snap[n], RUN_DATE).select(F.lit(n).alias("table_name"), *GROUP_COLUMNS)
                       for n in RESULT_TABLES])


def _report_export(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "export")
    export_report(report.scrutiny_report(t, REPORTS["annual_rt"]), path)
    return read_export(spark, path)


def _staged_report(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
    """The staging table after the reset: written for one report, then replaced by the next, by position."""
    table, path = f"retally_staging_{uuid.uuid4().hex}", scratch_path(spark, "staging")
    stage_report(report.scrutiny_report(t, REPORTS["semester_rv"]), table, path)
    stage_report(report.scrutiny_report(t, REPORTS["semester_rt"]), table, path)
    return _version_rows(spark, table)


def _register_append(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
    """The register after two appends: the files of even and of odd colleges."""
    table, path = f"retally_register_{uuid.uuid4().hex}", scratch_path(spark, "register")
    entries = _file_register(spark, t, sf_dir)
    for half in (0, 1):
        append_table(entries.where(F.col("coll_code") % 2 == half), table, path)
    rows = spark.read.schema(schemas.FILE_REGISTER).parquet(path)
    spark.sql(f"DROP TABLE {table}")
    return rows


def _deadline(table: str, as_text: bool) -> Job:
    return lambda spark, t, sf_dir: status.deadline_status(t[table], end_date_as_text=as_text)


def _published(table: str) -> Job:
    return lambda spark, t, sf_dir: status.published_groups(t[table])


def _paid_list(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
    return reconcile.paid_list(t["payment"])


def _paid_counts(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
    return reconcile.paid_counts(t["payment"])


def _purposes(t: ExamTables) -> list[tuple[DataFrame, str]]:
    return [(t[s.application_table], s.purpose) for s in REPORTS.values()]


def _accepted_list(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
    return reconcile.accepted_for_purposes(_purposes(t), t["payment"])


def _accepted_counts(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
    return reconcile.accepted_counts_for_purposes(_purposes(t), t["payment"])


def _gate(key: str) -> Job:
    spec = REPORTS[key]

    def run(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
        groups = status.published_groups(t[spec.result_table])      # every publish date
        return reconcile.gate(groups, t[spec.application_table], reconcile.captured_forms(t), spec)

    return run


def _lists(compare) -> Job:
    """``compare`` over both lists of all four reports."""
    def run(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
        specs = list(REPORTS.values())
        groups = {"annual": t["result_annual"], "semester": t["result"]}
        # Written, so that Spark sees how small they are: the wide tables then meet them without a shuffle on group keys.
        groups = {k: checkpointed(spark, g.select(*GROUP_COLUMNS).distinct(), "groups") for k, g in groups.items()}
        return compare(specs, groups, {s.key: t[s.application_table] for s in specs}, reconcile.captured_forms(t))

    return run


def _payment_rejects(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
    return rejects.payment_rejects(t["payment"])


def _report(key: str) -> Job:
    return lambda spark, t, sf_dir: report.scrutiny_report(t, REPORTS[key])


def _open_forms(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
    """Application rows not yet reported and, in semester reports, paid: both tests by bitmaps of form numbers."""
    out = []
    for key, spec in REPORTS.items():
        reported, paid = report.reported_forms(t, spec), report.paid_forms(t, spec)
        rows = not_in(t[spec.application_table], "scanno", reported, "form",
                      bitmaps=checkpointed(spark, key_bitmaps(reported, "form"), "bitmaps"))
        if spec.payment_semi_join:
            rows = is_in(rows, "scanno", paid, "form", bitmaps=checkpointed(spark, key_bitmaps(paid, "form"), "bitmaps"))
        out.append(rows.select(F.lit(key).alias("report"), "id", "scanno"))
    return _union_all(out)


def _null_history(spark: SparkSession, t: ExamTables, sf_dir: str) -> DataFrame:
    """Both annual reports over a history with one NULL form number of type rv: it empties the rv report alone."""
    history = t["annual_scrutiny_report"].unionByName(
        spark.createDataFrame([(None, "rv")], schemas.HISTORY))
    t = t.with_table("annual_scrutiny_report", history)
    return _union_all([report.scrutiny_report(t, REPORTS[k]) for k in ("annual_rt", "annual_rv")])


def _gated(key: str, pub_result: str | None) -> Job:
    return lambda spark, t, sf_dir: runs.gated_run(t, REPORTS[key], pub_result)


JOBS: dict[str, Job] = {
    "file_register": _file_register,
    "latest_drop": _latest_drop,
    "import_replace": _import_replace,
    "drop_ledger": _drop_ledger,
    "snapshot_load": _snapshot_load,
    "snapshot_tables": _snapshot_tables,
    "published_groups_dated": _published_dated,
    "report_export": _report_export,
    "staged_report": _staged_report,
    "register_append": _register_append,
    "deadline_status_annual": _deadline("result_annual", True),
    "deadline_status_semester": _deadline("result", False),
    "published_groups_annual": _published("result_annual"),
    "published_groups_semester": _published("result"),
    "paid_list": _paid_list,
    "paid_counts": _paid_counts,
    "accepted_list": _accepted_list,
    "accepted_counts": _accepted_counts,
    "recon_gate_annual_rt": _gate("annual_rt"),
    "recon_gate_annual_rv": _gate("annual_rv"),
    "recon_gate_semester_rt": _gate("semester_rt"),
    "recon_gate_semester_rv": _gate("semester_rv"),
    "recon_mismatch": _lists(reconcile.mismatch_for_purposes),
    "recon_equal": _lists(reconcile.list_equality),
    "payment_rejects": _payment_rejects,
    "scrutiny_annual_rt": _report("annual_rt"),
    "scrutiny_annual_rv": _report("annual_rv"),
    "scrutiny_semester_rt": _report("semester_rt"),
    "scrutiny_semester_rv": _report("semester_rv"),
    "scrutiny_null_history": _null_history,
    "open_forms": _open_forms,
    "gated_annual_rt": _gated("annual_rt", RUN_DATE),
    "gated_annual_rv": _gated("annual_rv", RUN_DATE),
    "gated_semester_rt": _gated("semester_rt", RUN_DATE),
    "gated_semester_rv": _gated("semester_rv", RUN_DATE),
    "gated_annual_rt_all_dates": _gated("annual_rt", None),
    "gated_annual_rv_all_dates": _gated("annual_rv", None),
    "gated_semester_rt_all_dates": _gated("semester_rt", None),
    "gated_semester_rv_all_dates": _gated("semester_rv", None),
}


# Jobs that read every table: what the derived tables share is stored once.
READ_ALL = ("snapshot_tables",)


def _derived(job: Job, stored: bool) -> Query:
    return lambda spark, sf_dir: job(spark, exam_tables_from_tpch(spark, sf_dir, stored), sf_dir)


QUERIES: dict[str, Query] = {name: _derived(job, name in READ_ALL) for name, job in JOBS.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gated annual re-totalling run (the source's main entry) on derived tables."""
    return QUERIES["gated_annual_rt"](spark, sf_dir)
