"""DuckDB oracle SQL for every registered query with a SQL form.

Tables, codes and rules are literals of this module, so a wrong parameter row
of the engine shows as a mismatch.  Reports unfold the paper slots with a
lateral ``VALUES`` list; list membership is ``IN`` / ``NOT IN`` with subqueries
and the gate counts are correlated.  The Spark side uses joins and aggregates
over all groups at once.
"""

from __future__ import annotations

from oracles.derive_sql import ANNUAL, SEMESTER, with_exam

# Per report the application, result and history tables, scrutiny type, payment purpose, semester
# suffix, history types that exclude a form (None: any), whether a captured payment is required, the gate comparison.
RULES = {
    "annual_rt": ("result_annual_retotaling", "result_annual", "annual_scrutiny_report", "rt", "RETOT_ANNUAL", "y", "'rt'", False, "="),
    "annual_rv": ("result_annual_reval", "result_annual", "annual_scrutiny_report", "rv", "REVAL_ANNUAL", "y", "'rv'", False, "<>"),
    "semester_rt": ("result_retotaling", "result", "scrutiny_report", "rt", "RETOT", "s", None, True, "="),
    "semester_rv": ("result_reval", "result", "scrutiny_report", "rv", "REVAL", "s", "'rv'", True, "="),
}
ALL_PURPOSES = "'RETOT_ANNUAL', 'REVAL_ANNUAL', 'RETOT', 'REVAL'"

# Captured payments with readable notes; anything else is on no list.
CAPTURED = """(SELECT description, notes->>'pay_for' AS pay_for, notes->>'course' AS course, notes->>'sem' AS sem
 FROM (SELECT description, CASE WHEN json_valid(notes) THEN notes END AS notes FROM payment WHERE status = 'captured') valid)"""


def _paid_ids(purpose: str) -> str:
    return f"SELECT CAST(CASE WHEN pay_for = '{purpose}' THEN description END AS INTEGER) FROM {CAPTURED} WHERE pay_for = '{purpose}'"


def _accepted(key: str) -> str:
    table, purpose = RULES[key][0], RULES[key][4]
    return (f"SELECT '{purpose}' AS pay_for, subcode, semyr_code, scanno FROM {table} "
            f"WHERE payment_status = '0300' AND retotaling_status = 'Y' AND scanno IN ({_paid_ids(purpose)})")


PAID_LIST = with_exam(f"SELECT DISTINCT pay_for, course, sem, description FROM {CAPTURED} WHERE pay_for IN ({ALL_PURPOSES})")

PAID_COUNTS = with_exam(f"""
SELECT pay_for, course, sem, count(*) AS paid_n
FROM (SELECT DISTINCT pay_for, course, sem, description FROM {CAPTURED} WHERE pay_for IN ({ALL_PURPOSES}))
GROUP BY pay_for, course, sem""")

ACCEPTED = "\nUNION ALL\n".join(_accepted(k) for k in RULES)
ACCEPTED_LIST = with_exam(ACCEPTED)
ACCEPTED_COUNTS = with_exam(
    f"SELECT pay_for, subcode, semyr_code, count(*) AS accepted_n FROM ({ACCEPTED}) GROUP BY pay_for, subcode, semyr_code")


def _gates(key: str, date: str | None = None) -> str:
    """Every published group with both counts, its class and whether it passes."""
    _, results, _, _, purpose, suffix, _, _, compare = RULES[key]
    where = f"WHERE pub_result = '{date}'" if date else ""
    return f"""
SELECT pub_result, course, subcode, semyr_code, paid_n, accepted_n,
       CASE WHEN paid_n <> accepted_n THEN 'mismatch' WHEN paid_n = 0 THEN 'none' ELSE 'match' END AS gate_class,
       paid_n {compare} accepted_n AND paid_n <> 0 AND accepted_n <> 0 AS passed
FROM (SELECT pub_result, course, subcode, semyr_code FROM {results} {where} GROUP BY ALL) AS published
CROSS JOIN LATERAL (
  SELECT count(*) AS paid_n FROM (SELECT DISTINCT description FROM {CAPTURED} c
  WHERE c.pay_for = '{purpose}' AND c.course = published.course AND c.sem = published.semyr_code || '{suffix}') listed) AS paid
CROSS JOIN LATERAL (
  SELECT count(*) AS accepted_n FROM ({_accepted(key)}) x
  WHERE x.subcode = published.subcode AND x.semyr_code = published.semyr_code) AS accepted"""


def _difference(key: str) -> str:
    _, results, _, _, purpose, suffix, *_ = RULES[key]
    groups = f"(SELECT course, subcode, semyr_code FROM {results} GROUP BY ALL) g"
    paid = (f"SELECT g.course, g.subcode, g.semyr_code, CAST(p.description AS INTEGER) AS scanno FROM {groups} "
            f"JOIN (SELECT * FROM {CAPTURED} WHERE pay_for = '{purpose}') p ON p.course = g.course AND p.sem = g.semyr_code || '{suffix}'")
    accepted = (f"SELECT g.course, g.subcode, g.semyr_code, x.scanno FROM {groups} "
                f"JOIN ({_accepted(key)}) x ON x.subcode = g.subcode AND x.semyr_code = g.semyr_code")
    return f"""SELECT '{purpose}' AS pay_for, *, 'paid_only' AS side FROM (({paid}) EXCEPT ({accepted}))
UNION ALL SELECT '{purpose}', *, 'accepted_only' FROM (({accepted}) EXCEPT ({paid}))"""


RECON_MISMATCH = with_exam("\nUNION ALL\n".join(_difference(k) for k in RULES))


def _deadline(table: str, end: str) -> str:
    day = "CAST(strptime(pub_result, '%d/%m/%Y') AS DATE) + 15"
    return with_exam(f"SELECT subcode, course, semyr, pub_result, {end.format(day)} AS end_date, count(*) AS row_count "
                     f"FROM {table} GROUP BY subcode, course, semyr, pub_result ORDER BY {day}")


def _published(table: str) -> str:
    return with_exam(f"SELECT pub_result, course, subcode, semyr_code FROM {table} GROUP BY pub_result, course, subcode, semyr_code")


def _report_body(key: str, history: str | None = None) -> str:
    """The report over every group: one row per applied paper, equal rows once."""
    table, results, recorded, kind, purpose, _, types, needs_payment, _ = RULES[key]
    papers = []
    for n, m in ANNUAL if key.startswith("annual") else SEMESTER:
        if key.startswith("semester"):
            applied = f"form.sub{n} IS NOT NULL AND form.sub{n}_retotaling = 'true'"
        else:
            either = "OR" if key == "annual_rv" and (n, m) == (1, 1) else "AND"
            applied = f"form.sub{n}p{m} IS NOT NULL {either} form.sub{n}p{m}code IS NOT NULL"
        papers.append(f"(res.sub{n}p{m}, res.sub{n}p{m}code, form.sub{n}p{m}_th, {applied})")
    earlier = f"SELECT CAST(scanno AS INTEGER) FROM {history or recorded}" + (f" WHERE scrutiny_type IN ({types})" if types else "")
    where = f"paper.applied AND form.payment_status = '0300' AND form.retotaling_status = 'Y' AND form.scanno NOT IN ({earlier})"
    if needs_payment:
        where += f" AND form.scanno IN ({_paid_ids(purpose)})"
    listed = ",\n  ".join(papers)
    return f"""SELECT DISTINCT form.scanno, form.ansidrno, form.enrollment_no, form.course, form.semyr_code, form.name, form.fname,
  form.payment_status, form.centrename, form.centrecode, form.subcode, paper.title AS paper, paper.code AS papercode,
  paper.marks, strftime(form.app_date, '%d/%m/%Y') AS app_date, '{kind}' AS scrutiny_type
FROM {table} AS form JOIN {results} AS res ON res.id = form.id
CROSS JOIN LATERAL (VALUES {listed}) AS paper(title, code, marks, applied)
WHERE {where}"""


def _report_sql(key: str) -> str:
    return with_exam(_report_body(key))


def _gated_sql(key: str, date: str | None) -> str:
    lead = "" if date else "passing.pub_result, "
    return with_exam(f"""
SELECT {lead}report.* FROM report
JOIN (SELECT * FROM ({_gates(key, date)}) gates WHERE passed) AS passing
  ON passing.subcode = report.subcode AND passing.semyr_code = report.semyr_code""",
                     extra_ctes=f"report AS (\n{_report_body(key)}\n)")


NULL_HISTORY = "(SELECT scanno, scrutiny_type FROM annual_scrutiny_report UNION ALL SELECT NULL, 'rv')"

FILE_REGISTER = """
WITH names AS (
  SELECT (CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN 'admission_approval'
               ELSE 'fee_receipt' END)
         || ' ' || CAST(c_nationkey AS VARCHAR)
         || ' ' || CAST(c_custkey % 28 + 1 AS VARCHAR) || '-' || CAST(c_custkey % 12 + 1 AS VARCHAR) || '-2024.pdf'
         AS file_name
  FROM customer)
SELECT split_part(file_name, ' ', 1) AS lable, CAST(split_part(file_name, ' ', 2) AS INTEGER) AS coll_code,
       split_part(file_name, ' ', 3) AS date, 'customer.parquet' AS src_location
FROM names WHERE split_part(file_name, ' ', 1) = 'admission_approval'"""

LATEST_DROP = "SELECT * FROM orders"
IMPORT_REPLACE = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders"
DROP_LEDGER = with_exam("SELECT description, status, notes FROM payment")

PAYMENT_REJECTS = with_exam(f"""
SELECT description, notes, reason FROM (
  SELECT description, notes, CASE
    WHEN pay_for IS NULL AND NOT readable THEN 'notes unreadable'
    WHEN pay_for IS NULL THEN 'no purpose'
    WHEN pay_for NOT IN ({ALL_PURPOSES}) THEN NULL
    WHEN course IS NULL THEN 'no course'
    WHEN sem IS NULL THEN 'no semester'
    WHEN description IS NULL THEN 'no form number'
    WHEN TRY_CAST(description AS INTEGER) IS NULL THEN 'form number is no integer' END AS reason
  FROM (SELECT description, notes, readable, doc->>'pay_for' AS pay_for, doc->>'course' AS course, doc->>'sem' AS sem
        FROM (SELECT description, notes, coalesce(json_valid(notes), FALSE) AS readable, CASE WHEN json_valid(notes) THEN notes END AS doc
              FROM payment WHERE status = 'captured') once) fields) reasons
WHERE reason IS NOT NULL""")


def _equality(key: str) -> str:
    _, results, _, _, purpose, suffix, *_ = RULES[key]
    paid = (f"SELECT CAST(p.description AS INTEGER) FROM {CAPTURED} p WHERE p.pay_for = '{purpose}' "
            f"AND p.course = g.course AND p.sem = g.semyr_code || '{suffix}'")
    accepted = f"SELECT x.scanno FROM ({_accepted(key)}) x WHERE x.subcode = g.subcode AND x.semyr_code = g.semyr_code"
    return f"""SELECT '{purpose}' AS pay_for, course, subcode, semyr_code, paid_size, accepted_size,
  paid_size = accepted_size AND in_both = paid_size AS lists_equal
FROM (SELECT course, subcode, semyr_code FROM {results} GROUP BY ALL) g
CROSS JOIN LATERAL (SELECT count(*) AS paid_size FROM (SELECT DISTINCT * FROM ({paid}) a) b) p
CROSS JOIN LATERAL (SELECT count(*) AS accepted_size FROM (SELECT DISTINCT * FROM ({accepted}) a) b) q
CROSS JOIN LATERAL (SELECT count(*) AS in_both FROM (({paid}) INTERSECT ({accepted})) b) r"""


RECON_EQUAL = with_exam("\nUNION ALL\n".join(_equality(k) for k in RULES))

# Columns of the nine tables, in order, for the checksums.
RESULT_COLUMNS = ["id", "course", "subcode", "semyr", "semyr_code", "pub_result"]
FORM_COLUMNS = ["id", "scanno", "ansidrno", "enrollment_no", "course", "semyr_code", "name", "fname", "payment_status", "centrename",
                "centrecode", "subcode", "app_date", "retotaling_status"]


def _paper_columns(slots: list[tuple[int, int]], *patterns: str) -> list[str]:
    return [p.format(n=n, m=m) for n, m in slots for p in patterns]


TABLE_COLUMNS = {
    "result_annual": RESULT_COLUMNS + _paper_columns(ANNUAL, "sub{n}p{m}", "sub{n}p{m}code"),
    "result": RESULT_COLUMNS + _paper_columns(SEMESTER, "sub{n}p{m}", "sub{n}p{m}code"),
    **{t: FORM_COLUMNS + _paper_columns(ANNUAL, "sub{n}p{m}", "sub{n}p{m}code", "sub{n}p{m}_th")
       for t in ("result_annual_retotaling", "result_annual_reval")},
    **{t: FORM_COLUMNS + _paper_columns(SEMESTER, "sub{n}", "sub{n}_retotaling", "sub{n}p{m}_th") for t in ("result_retotaling", "result_reval")},
    "annual_scrutiny_report": ["scanno", "scrutiny_type"], "scrutiny_report": ["scanno", "scrutiny_type"],
    "payment": ["description", "status", "notes"],
}


def _summed(table: str, columns: list[str]) -> str:
    text = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns)
    return (f"SELECT '{table}' AS table_name, count(*) AS rows, "
            f"CAST(coalesce(sum(CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)), 0) AS VARCHAR) AS checksum FROM {table}")


SNAPSHOT_TABLES = with_exam("SELECT fmt, summed.* FROM (VALUES ('csv'), ('parquet')) f(fmt), (\n"
                            + "\nUNION ALL\n".join(_summed(t, c) for t, c in TABLE_COLUMNS.items()) + ") summed")

PUBLISHED_DATED = with_exam("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, course, subcode, semyr_code FROM {t} WHERE pub_result = '01/01/1996' GROUP BY ALL" for t in ("result_annual", "result")))

SNAPSHOT_LOAD = with_exam("SELECT * FROM result_annual")

def _open_forms(key: str) -> str:
    """Application rows whose form is in no earlier report and, in semester reports, paid."""
    table, _, recorded, _, purpose, _, types, needs_payment, _ = RULES[key]
    earlier = f"SELECT CAST(scanno AS INTEGER) FROM {recorded}" + (f" WHERE scrutiny_type IN ({types})" if types else "")
    paid = f" AND scanno IN ({_paid_ids(purpose)})" if needs_payment else ""
    return f"SELECT '{key}' AS report, id, scanno FROM {table} WHERE scanno NOT IN ({earlier}){paid}"


ORACLES: dict[str, str] = {
    "file_register": FILE_REGISTER,
    "latest_drop": LATEST_DROP,
    "import_replace": IMPORT_REPLACE,
    "drop_ledger": DROP_LEDGER,
    "snapshot_load": SNAPSHOT_LOAD,
    "snapshot_tables": SNAPSHOT_TABLES,
    "published_groups_dated": PUBLISHED_DATED,
    "report_export": _report_sql("annual_rt"),
    "staged_report": _report_sql("semester_rt"),
    "register_append": FILE_REGISTER,
    "deadline_status_annual": _deadline("result_annual", "CAST({} AS VARCHAR)"),
    "deadline_status_semester": _deadline("result", "{}"),
    "published_groups_annual": _published("result_annual"),
    "published_groups_semester": _published("result"),
    "paid_list": PAID_LIST,
    "paid_counts": PAID_COUNTS,
    "accepted_list": ACCEPTED_LIST,
    "accepted_counts": ACCEPTED_COUNTS,
    "recon_gate_annual_rt": with_exam(_gates("annual_rt")),
    "recon_gate_annual_rv": with_exam(_gates("annual_rv")),
    "recon_gate_semester_rt": with_exam(_gates("semester_rt")),
    "recon_gate_semester_rv": with_exam(_gates("semester_rv")),
    "recon_mismatch": RECON_MISMATCH,
    "recon_equal": RECON_EQUAL,
    "payment_rejects": PAYMENT_REJECTS,
    "scrutiny_annual_rt": _report_sql("annual_rt"),
    "scrutiny_annual_rv": _report_sql("annual_rv"),
    "scrutiny_semester_rt": _report_sql("semester_rt"),
    "scrutiny_semester_rv": _report_sql("semester_rv"),
    "scrutiny_null_history": with_exam(_report_body("annual_rt", NULL_HISTORY + " h") + "\nUNION ALL\n" + _report_body("annual_rv", NULL_HISTORY + " h")),
    "open_forms": with_exam("\nUNION ALL\n".join(_open_forms(k) for k in RULES)),
    "gated_annual_rt": _gated_sql("annual_rt", "01/01/1996"),
    "gated_annual_rv": _gated_sql("annual_rv", "01/01/1996"),
    "gated_semester_rt": _gated_sql("semester_rt", "01/01/1996"),
    "gated_semester_rv": _gated_sql("semester_rv", "01/01/1996"),
    "gated_annual_rt_all_dates": _gated_sql("annual_rt", None),
    "gated_annual_rv_all_dates": _gated_sql("annual_rv", None),
    "gated_semester_rt_all_dates": _gated_sql("semester_rt", None),
    "gated_semester_rv_all_dates": _gated_sql("semester_rv", None),
}
