"""Exam tables derived from the TPC-H-like test tables.

The test data has no exam tables, so they are computed from ``orders``,
``customer``, ``nation``, ``lineitem`` and ``part`` with deterministic rules:
an order is a candidate's result row, its lines are papers, the part picks the
paper slot.  The SQL oracle derives the same tables independently.

Rules (fixed values of the test recipe):

* header per order: id = o_orderkey, scanno = int(o_orderkey),
  ansidrno = "A"||o_custkey, enrollment_no = "E"||o_custkey, name = c_name,
  fname = "F"||c_mktsegment, centrename = n_name, centrecode = n_nationkey,
  course = o_orderpriority, subcode = "S"||least(first digit of the priority, 4),
  so one subcode holds two courses,
  semyr = semyr_code = text of (year(o_orderdate) % 3 + 1),
  pub_result = "01/01/"||year, spelt "1/1/"||year in odd years for courses 2 and 4, app_date = date(o_orderdate),
  payment_status = "0399" when o_orderkey % 7 = 0 and the course starts with
  "1", else "0300"; retotaling_status = "N" when o_orderstatus = "P", else "Y".
* a line sits in slot l_partkey % 40 (annual) or l_partkey % 12 (semester);
  per slot: paper = max(p_name), code = max(text of l_partkey),
  marks = max(int(l_quantity)); semester applications: subject = max(p_brand),
  flag = "true" when max(l_quantity) > 25 else "false"; annual applications
  blank the paper name of lines with l_partkey % 9 = 0.
* a line is applied for when (l_partkey + l_linenumber) % 2 = 0.
* result tables: every order with lines, all lines.  Re-totalling
  applications: orders with o_orderkey % 3 = 0, the lines applied for;
  re-valuation: o_orderkey % 3 = 1, the lines applied for.
* payment: per application with retotaling_status "Y", one row per purpose
  of its kind (annual and semester); status "captured", except scanno % 5 = 4
  ("attempted"); scanno % 13 = 0 pays twice.  Further captured rows as a real
  payment table has them: scanno % 17 = 0 a payment of another purpose with a
  text description, scanno % 19 = 0 of course 3 one of its annual purpose without a
  description, scanno % 23 = 0 one with notes that are not JSON.
* history: orders with o_orderkey % 15 = 0 or % 11 = 0; type "rt" for even
  keys, "rv" for odd ones; scanno kept as text.

Every order takes part; the splits are an assignment rule, not a sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retally.functions.notes import payment_notes
from retally.operators.membership import planned_bytes
from retally.sources.sinks import clustered
from retally.sources.tables import ExamTables
from retally.specs import Slot, annual_slots, semester_slots


def _read(spark: SparkSession, sf_dir: str, name: str, cols: list[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*cols)


def _header(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    customer = _read(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    nation = _read(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    year = F.year("o_orderdate")
    semyr = (year % 3 + 1).cast("string")
    course = F.col("o_orderpriority")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderkey").cast("int").alias("scanno"),
            F.concat(F.lit("A"), F.col("o_custkey").cast("string")).alias("ansidrno"),
            F.concat(F.lit("E"), F.col("o_custkey").cast("string")).alias("enrollment_no"),
            F.col("c_name").alias("name"),
            F.concat(F.lit("F"), F.col("c_mktsegment")).alias("fname"),
            F.col("n_name").alias("centrename"),
            F.col("n_nationkey").cast("int").alias("centrecode"),
            course.alias("course"),
            F.concat(F.lit("S"), F.least(F.substring(course, 1, 1), F.lit("4"))).alias("subcode"),
            semyr.alias("semyr"),
            semyr.alias("semyr_code"),
            F.concat(F.when((year % 2 == 1) & F.substring(course, 1, 1).isin("2", "4"), F.lit("1/1/")).otherwise(F.lit("01/01/")),
                     year.cast("string")).alias("pub_result"),
            F.col("o_orderdate").cast("date").alias("app_date"),
            F.when((F.col("o_orderkey") % 7 == 0) & course.startswith("1"), F.lit("0399"))
            .otherwise(F.lit("0300")).alias("payment_status"),
            F.when(F.col("o_orderstatus") == "P", F.lit("N")).otherwise(F.lit("Y"))
            .alias("retotaling_status"),
        )
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _read(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"])
    part = _read(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand"])
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "p_name", "p_brand",
        F.col("l_partkey").cast("string").alias("code"),
        F.col("l_quantity").cast("int").alias("qty"),
        ((F.col("l_partkey") + F.col("l_linenumber")) % 2 == 0).alias("_applied"),
        F.when(F.col("l_partkey") % 9 != 0, F.col("p_name")).alias("_blanked"),
    )


# Lines are held by part number modulo this: both slot layouts (40 and 12) follow from the remainder.
COMMON_MODULUS = 120


def _grouped_lines(lines: DataFrame) -> DataFrame:
    """The lines of an order with one part number modulo ``COMMON_MODULUS`` as one row of maxima, applied for or not apart.

    All tables take maxima over such lines, so theirs are maxima of these.  An order has at
    most a few hundred rows, however many lines it has.
    """
    maxima = ["p_name", "_blanked", "p_brand", "code", "qty", "l_quantity"]
    return (lines.withColumn("l_partkey", F.col("l_partkey") % COMMON_MODULUS)
            .groupBy("l_orderkey", "l_partkey", "_applied").agg(*[F.max(c).alias(c) for c in maxima]))


def _pivot(lines: DataFrame, modulus: int, values: list[Column]) -> DataFrame:
    """One row per order with a map ``slot -> struct(v0, v1, ...)`` of per-slot maxima.

    The per-(order, slot) aggregation combines map-side, so even an order
    holding a third of all lines is reduced before the shuffle; the map then
    holds at most ``modulus`` entries per order, a bound set by the layout.
    """
    per_slot = (
        lines.withColumn("_slot", (F.col("l_partkey") % modulus).cast("int"))
        .groupBy("l_orderkey", "_slot")
        .agg(*[F.max(v).alias(f"v{i}") for i, v in enumerate(values)])
    )
    fields = F.struct(*[f"v{i}" for i in range(len(values))])
    return per_slot.groupBy("l_orderkey").agg(
        F.map_from_entries(F.collect_list(F.struct("_slot", fields))).alias("_slots"))


def _slot_value(slot: Slot, i: int) -> str:
    """SQL for value ``i`` of ``slot`` in the map built by ``_pivot`` (NULL when the slot is empty)."""
    return f"_slots[{slot.index}].v{i}"


def _with_header(header: DataFrame, pivot: DataFrame, header_cols: list[str], slot_cols: list[str]) -> DataFrame:
    """Header columns + slot columns given as SQL text (one driver call for all of them)."""
    return (header.select(*header_cols)
            .join(pivot, F.col("id") == F.col("l_orderkey"))
            .selectExpr(*header_cols, *slot_cols))


RESULT_HEADER = ["id", "course", "subcode", "semyr", "semyr_code", "pub_result"]
APPLICATION_HEADER = [
    "id", "scanno", "ansidrno", "enrollment_no", "course", "semyr_code", "name", "fname",
    "payment_status", "centrename", "centrecode", "subcode", "app_date", "retotaling_status",
]


MAX_STORED_BUCKETS = 1 << 15         # Spark refuses more than 100,000
STORED_BYTES = 32 * 1024 * 1024       # of the lines' files, to a bucket of the stored parts


def exam_tables_from_tpch(spark: SparkSession, sf_dir: str, stored: bool = False) -> ExamTables:
    """All nine exam tables, derived lazily from the TPC-H-like tables in ``sf_dir``.

    With ``stored`` the joined headers and lines that the tables share are written once,
    bucketed by order: for jobs that read most tables, which then neither repeat the
    joins nor shuffle.  Without, each table is derived from the files.
    """
    state: dict[str, DataFrame] = {}

    def buckets() -> int:
        size = planned_bytes(spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet"))
        return max(min(64, spark.sparkContext.defaultParallelism), min(MAX_STORED_BUCKETS, -(-size // STORED_BYTES)))

    def header() -> DataFrame:
        if "header" not in state:
            made = _header(spark, sf_dir)
            state["header"] = clustered(made, "id", buckets(), "headers") if stored else made
        return state["header"]

    def lines() -> DataFrame:
        if "lines" not in state:
            made = _lines(spark, sf_dir)
            state["lines"] = clustered(_grouped_lines(made), "l_orderkey", buckets(), "lines") if stored else made
        return state["lines"]

    def applied_lines(residue: int) -> DataFrame:
        return lines().where((F.col("l_orderkey") % 3 == residue) & F.col("_applied"))

    def result_table(slots: tuple[Slot, ...], modulus: int) -> DataFrame:
        piv = _pivot(lines(), modulus, [F.col("p_name"), F.col("code")])
        cols = []
        for s in slots:
            cols += [f"{_slot_value(s, 0)} AS {s.name}", f"{_slot_value(s, 1)} AS {s.name}code"]
        return _with_header(header(), piv, RESULT_HEADER, cols)

    def annual_application(residue: int) -> DataFrame:
        piv = _pivot(applied_lines(residue), 40, [F.col("_blanked"), F.col("code"), F.col("qty")])
        cols = []
        for s in annual_slots():
            cols += [f"{_slot_value(s, 0)} AS {s.name}", f"{_slot_value(s, 1)} AS {s.name}code",
                     f"{_slot_value(s, 2)} AS {s.name}_th"]
        return _with_header(header(), piv, APPLICATION_HEADER, cols)

    def semester_application(residue: int) -> DataFrame:
        piv = _pivot(applied_lines(residue), 12, [F.col("p_brand"), F.col("l_quantity"), F.col("qty")])
        cols = []
        for s in semester_slots():
            cols += [
                f"{_slot_value(s, 0)} AS sub{s.subject}",
                f"CASE WHEN {_slot_value(s, 1)} > 25 THEN 'true' ELSE 'false' END AS sub{s.subject}_retotaling",
                f"{_slot_value(s, 2)} AS {s.name}_th",
            ]
        return _with_header(header(), piv, APPLICATION_HEADER, cols)

    def payment() -> DataFrame:
        # One pass over the applicants of both kinds: each yields its rows as one array.
        kind = F.col("id") % 3
        applied = (lines().where(((F.col("l_orderkey") % 3).isin(0, 1)) & F.col("_applied"))
                   .select("l_orderkey").distinct())
        applicants = (header().where(F.col("retotaling_status") == "Y")
                      .join(applied, F.col("id") == F.col("l_orderkey"), "left_semi"))
        scanno = F.col("scanno")
        form = scanno.cast("string")

        def row(description: Column, status: Column, notes: Column) -> Column:
            return F.struct(description.alias("description"), status.alias("status"), notes.alias("notes"))

        def notes(pay_for: str, suffix: str) -> Column:
            return payment_notes(F.concat(F.col("semyr_code"), F.lit(suffix)), F.col("course"), F.lit(pay_for))

        status = F.when(scanno % 5 == 4, F.lit("attempted")).otherwise(F.lit("captured"))
        captured, nothing = F.lit("captured"), F.lit(None).cast("string")

        def own(annual: str, semester: str) -> Column:
            return F.array(row(form, status, notes(annual, "y")), row(form, status, notes(semester, "s")))

        def when(condition: Column, extra: Column) -> Column:
            return F.when(condition, F.array(extra)).otherwise(F.array().cast("array<struct<description:string,status:string,notes:string>>"))

        first = F.when(kind == 0, own("RETOT_ANNUAL", "RETOT")).otherwise(own("REVAL_ANNUAL", "REVAL"))
        annual = F.when(kind == 0, notes("RETOT_ANNUAL", "y")).otherwise(notes("REVAL_ANNUAL", "y"))
        rows = F.concat(
            first, F.when(scanno % 13 == 0, first).otherwise(F.array().cast("array<struct<description:string,status:string,notes:string>>")),
            when(scanno % 17 == 0, row(F.concat(F.lit("Admission fee "), F.col("semyr_code")), captured, notes("ADMISSION", "y"))),
            when((scanno % 19 == 0) & F.col("course").startswith("3"), row(nothing, captured, annual)),
            when(scanno % 23 == 0, row(form, captured, F.concat(F.lit('{"sem": '), F.col("semyr_code")))))
        return applicants.select(F.inline(rows))

    def history() -> DataFrame:
        orders = _read(spark, sf_dir, "orders", ["o_orderkey"])
        k = F.col("o_orderkey")
        return orders.where((k % 15 == 0) | (k % 11 == 0)).select(
            k.cast("string").alias("scanno"),
            F.when(k % 2 == 0, F.lit("rt")).otherwise(F.lit("rv")).alias("scrutiny_type"),
        )

    loaders = {
        "result_annual": lambda: result_table(annual_slots(), 40),
        "result": lambda: result_table(semester_slots(), 12),
        "result_annual_retotaling": lambda: annual_application(0),
        "result_annual_reval": lambda: annual_application(1),
        "result_retotaling": lambda: semester_application(0),
        "result_reval": lambda: semester_application(1),
        "payment": payment,
        "annual_scrutiny_report": history,
        "scrutiny_report": history,
    }
    return ExamTables(spark, loaders)
