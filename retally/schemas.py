"""Explicit schemas of the source tables the jobs read or write (no inference)."""

from __future__ import annotations

from pyspark.sql.types import (DateType, IntegerType, LongType, StringType, StructField, StructType)

from retally.specs import Slot, annual_slots, semester_slots

_S, _I = StringType(), IntegerType()

PAYMENT = StructType([
    StructField("description", _S), StructField("status", _S), StructField("notes", _S),
])

HISTORY = StructType([StructField("scanno", _S), StructField("scrutiny_type", _S)])

FILE_REGISTER = StructType([
    StructField("lable", _S), StructField("coll_code", _I), StructField("date", _S),
    StructField("src_location", _S),
])

REPORT = StructType([
    StructField("scanno", _I), StructField("ansidrno", _S), StructField("enrollment_no", _S),
    StructField("course", _S), StructField("semyr_code", _S), StructField("name", _S),
    StructField("fname", _S), StructField("payment_status", _S), StructField("centrename", _S),
    StructField("centrecode", _I), StructField("subcode", _S), StructField("paper", _S),
    StructField("papercode", _S), StructField("marks", _I), StructField("app_date", _S),
    StructField("scrutiny_type", _S),
])

_RESULT_HEADER = [
    StructField("id", LongType()), StructField("course", _S), StructField("subcode", _S),
    StructField("semyr", _S), StructField("semyr_code", _S), StructField("pub_result", _S),
]
_APPLICATION_HEADER = [
    StructField("id", LongType()), StructField("scanno", _I), StructField("ansidrno", _S),
    StructField("enrollment_no", _S), StructField("course", _S), StructField("semyr_code", _S),
    StructField("name", _S), StructField("fname", _S), StructField("payment_status", _S),
    StructField("centrename", _S), StructField("centrecode", _I), StructField("subcode", _S),
    StructField("app_date", DateType()), StructField("retotaling_status", _S),
]


def _paper_fields(slots: tuple[Slot, ...]) -> list[StructField]:
    return [f for s in slots for f in (StructField(s.name, _S), StructField(s.name + "code", _S))]


RESULT_ANNUAL = StructType(_RESULT_HEADER + _paper_fields(annual_slots()))
RESULT_SEMESTER = StructType(_RESULT_HEADER + _paper_fields(semester_slots()))
APPLICATION_ANNUAL = StructType(_APPLICATION_HEADER + [
    f for s in annual_slots()
    for f in (StructField(s.name, _S), StructField(s.name + "code", _S), StructField(s.name + "_th", _I))
])
APPLICATION_SEMESTER = StructType(_APPLICATION_HEADER + [
    f for s in semester_slots()
    for f in (StructField(f"sub{s.subject}", _S), StructField(f"sub{s.subject}_retotaling", _S),
              StructField(s.name + "_th", _I))
])

BY_TABLE = {
    "result_annual": RESULT_ANNUAL,
    "result": RESULT_SEMESTER,
    "result_annual_retotaling": APPLICATION_ANNUAL,
    "result_annual_reval": APPLICATION_ANNUAL,
    "result_retotaling": APPLICATION_SEMESTER,
    "result_reval": APPLICATION_SEMESTER,
    "payment": PAYMENT,
    "annual_scrutiny_report": HISTORY,
    "scrutiny_report": HISTORY,
}
