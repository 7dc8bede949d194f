"""DuckDB CTEs that derive the exam tables from the TPC-H-like views.

Written independently of the Spark derivation (``retally.sources.derived``)
from the same stated rules, with layouts and codes as literals of its own; the two must agree for the oracle check to mean
anything.  Conditional aggregation uses ``FILTER (WHERE ...)``.
"""

from __future__ import annotations

# Fixed values of the layouts: papers per subject (annual), subjects (semester).
ANNUAL = [(n, m) for n, papers in enumerate([3, 3, 4, 4, 4, 4, 3, 3, 3, 3, 3, 3], start=1) for m in range(1, papers + 1)]
SEMESTER = [(n, 1) for n in range(1, 13)]
APPLIED_FOR = "(l_partkey + l_linenumber) % 2 = 0"

HEADER = """hdr AS (
  SELECT o.o_orderkey AS id,
         CAST(o.o_orderkey AS INTEGER) AS scanno,
         'A' || CAST(o.o_custkey AS VARCHAR) AS ansidrno,
         'E' || CAST(o.o_custkey AS VARCHAR) AS enrollment_no,
         c.c_name AS name,
         'F' || c.c_mktsegment AS fname,
         n.n_name AS centrename,
         CAST(n.n_nationkey AS INTEGER) AS centrecode,
         o.o_orderpriority AS course,
         'S' || CASE WHEN substr(o.o_orderpriority, 1, 1) = '5' THEN '4' ELSE substr(o.o_orderpriority, 1, 1) END AS subcode,
         CAST(year(o.o_orderdate) % 3 + 1 AS VARCHAR) AS semyr,
         CAST(year(o.o_orderdate) % 3 + 1 AS VARCHAR) AS semyr_code,
         CASE WHEN year(o.o_orderdate) % 2 = 1 AND substr(o.o_orderpriority, 1, 1) IN ('2', '4') THEN '1/1/' ELSE '01/01/' END
           || CAST(year(o.o_orderdate) AS VARCHAR) AS pub_result,
         CAST(o.o_orderdate AS DATE) AS app_date,
         CASE WHEN o.o_orderkey % 7 = 0 AND o.o_orderpriority LIKE '1%' THEN '0399' ELSE '0300' END AS payment_status,
         CASE WHEN o.o_orderstatus = 'P' THEN 'N' ELSE 'Y' END AS retotaling_status
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

LINES = """lines AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity, p.p_name, p.p_brand
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""

RESULT_HEADER = "h.id, h.course, h.subcode, h.semyr, h.semyr_code, h.pub_result"
APP_HEADER = ("h.id, h.scanno, h.ansidrno, h.enrollment_no, h.course, h.semyr_code, h.name, h.fname, "
              "h.payment_status, h.centrename, h.centrecode, h.subcode, h.app_date, h.retotaling_status")


def _table(name: str, header: str, columns: list[str], lines: str) -> str:
    body = ",\n         ".join(columns)
    return (f"{name} AS (\n  SELECT {header}, x.* EXCLUDE (l_orderkey)\n"
            f"  FROM hdr h JOIN (SELECT l_orderkey,\n         {body}\n  FROM lines WHERE {lines} GROUP BY l_orderkey) x\n"
            f"  ON x.l_orderkey = h.id\n)")


def _best(value: str, modulus: int, place: int) -> str:
    return f"max({value}) FILTER (WHERE l_partkey % {modulus} = {place})"


def _result_table(name: str, slots: list[tuple[int, int]], modulus: int) -> str:
    columns = []
    for place, (n, m) in enumerate(slots):
        columns += [f"{_best('p_name', modulus, place)} AS sub{n}p{m}",
                    f"{_best('CAST(l_partkey AS VARCHAR)', modulus, place)} AS sub{n}p{m}code"]
    return _table(name, RESULT_HEADER, columns, "TRUE")


def _annual_application(name: str, residue: int) -> str:
    columns = []
    for place, (n, m) in enumerate(ANNUAL):
        columns += [f"{_best('CASE WHEN l_partkey % 9 <> 0 THEN p_name END', 40, place)} AS sub{n}p{m}",
                    f"{_best('CAST(l_partkey AS VARCHAR)', 40, place)} AS sub{n}p{m}code",
                    f"{_best('CAST(l_quantity AS INTEGER)', 40, place)} AS sub{n}p{m}_th"]
    return _table(name, APP_HEADER, columns, f"l_orderkey % 3 = {residue} AND {APPLIED_FOR}")


def _semester_application(name: str, residue: int) -> str:
    columns = []
    for place, (n, m) in enumerate(SEMESTER):
        columns += [f"{_best('p_brand', 12, place)} AS sub{n}",
                    f"CASE WHEN {_best('l_quantity', 12, place)} > 25 THEN 'true' ELSE 'false' END AS sub{n}_retotaling",
                    f"{_best('CAST(l_quantity AS INTEGER)', 12, place)} AS sub{n}p{m}_th"]
    return _table(name, APP_HEADER, columns, f"l_orderkey % 3 = {residue} AND {APPLIED_FOR}")


PAYMENT = f"""applicant AS (
  SELECT * FROM hdr WHERE retotaling_status = 'Y' AND id % 3 IN (0, 1)
    AND EXISTS (SELECT 1 FROM lines WHERE l_orderkey = id AND {APPLIED_FOR})
),
payment_once AS (
  SELECT CAST(h.scanno AS VARCHAR) AS description,
         CASE WHEN h.scanno % 5 = 4 THEN 'attempted' ELSE 'captured' END AS status,
         json_object('sem', h.semyr_code || p.suffix, 'course', h.course, 'pay_for', p.pay_for)::VARCHAR AS notes,
         h.scanno
  FROM applicant h
  JOIN (VALUES (0, 'RETOT_ANNUAL', 'y'), (0, 'RETOT', 's'), (1, 'REVAL_ANNUAL', 'y'), (1, 'REVAL', 's'))
       AS p(residue, pay_for, suffix) ON h.id % 3 = p.residue
),
payment AS (
  SELECT description, status, notes FROM payment_once
  UNION ALL
  SELECT description, status, notes FROM payment_once WHERE scanno % 13 = 0
  UNION ALL
  SELECT 'Admission fee ' || semyr_code, 'captured',
         json_object('sem', semyr_code || 'y', 'course', course, 'pay_for', 'ADMISSION')::VARCHAR FROM applicant WHERE scanno % 17 = 0
  UNION ALL
  SELECT NULL, 'captured', json_object('sem', semyr_code || 'y', 'course', course, 'pay_for',
         CASE WHEN id % 3 = 0 THEN 'RETOT_ANNUAL' ELSE 'REVAL_ANNUAL' END)::VARCHAR FROM applicant WHERE scanno % 19 = 0 AND course LIKE '3%'
  UNION ALL
  SELECT CAST(scanno AS VARCHAR), 'captured', '{{"sem": ' || semyr_code FROM applicant WHERE scanno % 23 = 0
)"""

HISTORY = """annual_scrutiny_report AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS scanno,
         CASE WHEN o_orderkey % 2 = 0 THEN 'rt' ELSE 'rv' END AS scrutiny_type
  FROM orders WHERE o_orderkey % 15 = 0 OR o_orderkey % 11 = 0
),
scrutiny_report AS (SELECT * FROM annual_scrutiny_report)"""


def exam_ctes() -> str:
    """``WITH`` body defining all nine exam tables (unused ones are not run)."""
    parts = [
        HEADER,
        LINES,
        _result_table("result_annual", ANNUAL, 40),
        _result_table("result", SEMESTER, 12),
        _annual_application("result_annual_retotaling", 0),
        _annual_application("result_annual_reval", 1),
        _semester_application("result_retotaling", 0),
        _semester_application("result_reval", 1),
        PAYMENT,
        HISTORY,
    ]
    return ",\n".join(parts)


def with_exam(sql_body: str, extra_ctes: str = "") -> str:
    ctes = exam_ctes() + (",\n" + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{sql_body}"
