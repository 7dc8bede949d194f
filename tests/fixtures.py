"""Tiny hand-made exam tables for unit tests (schemas from ``retally.schemas``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from retally import schemas
from retally.sources.tables import ExamTables


def frame(spark: SparkSession, schema, rows: list[dict]) -> DataFrame:
    names = schema.names
    unknown = {k for r in rows for k in r} - set(names)
    assert not unknown, f"unknown columns {unknown}"
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def result_row(id_, course="C1", subcode="S1", semyr="1", pub="04/07/2024", **slots) -> dict:
    return dict(id=id_, course=course, subcode=subcode, semyr=semyr, semyr_code=semyr, pub_result=pub, **slots)


def app_row(id_, scanno=None, course="C1", subcode="S1", semyr="1", status="0300", applied="Y",
            app_date=dt.date(2024, 7, 10), **slots) -> dict:
    return dict(id=id_, scanno=id_ if scanno is None else scanno, ansidrno=f"A{id_}", enrollment_no=f"E{id_}",
                course=course, semyr_code=semyr, name=f"N{id_}", fname=f"F{id_}", payment_status=status,
                centrename="CEN", centrecode=7, subcode=subcode, app_date=app_date, retotaling_status=applied,
                **slots)


def pay_row(scanno, pay_for, course="C1", sem="1y", status="captured") -> dict:
    import json
    return dict(description=str(scanno), status=status,
                notes=json.dumps({"sem": sem, "course": course, "pay_for": pay_for}))


def tables(spark: SparkSession, *, result_annual=(), result=(), annual_rt=(), annual_rv=(), semester_rt=(),
           semester_rv=(), payment=(), annual_history=(), semester_history=()) -> ExamTables:
    S = schemas
    return ExamTables.from_frames(spark, {
        "result_annual": frame(spark, S.RESULT_ANNUAL, list(result_annual)),
        "result": frame(spark, S.RESULT_SEMESTER, list(result)),
        "result_annual_retotaling": frame(spark, S.APPLICATION_ANNUAL, list(annual_rt)),
        "result_annual_reval": frame(spark, S.APPLICATION_ANNUAL, list(annual_rv)),
        "result_retotaling": frame(spark, S.APPLICATION_SEMESTER, list(semester_rt)),
        "result_reval": frame(spark, S.APPLICATION_SEMESTER, list(semester_rv)),
        "payment": frame(spark, S.PAYMENT, list(payment)),
        "annual_scrutiny_report": frame(spark, S.HISTORY, list(annual_history)),
        "scrutiny_report": frame(spark, S.HISTORY, list(semester_history)),
    })


def rows(df: DataFrame, *cols: str) -> list[tuple]:
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
