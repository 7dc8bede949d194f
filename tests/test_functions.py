"""Dates (E15), casts (E16), tokens (E17) and payment notes (E19)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from retally.functions import deadline, format_day, note_field, parse_day, to_int, token


def _one(spark, col, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(col.alias("x")).first().x


def test_deadline_accepts_short_and_long_forms(spark):
    for text, want in (("4/7/2024", dt.date(2024, 7, 19)), ("04/07/2024", dt.date(2024, 7, 19)),
                       ("28/12/2023", dt.date(2024, 1, 12))):
        assert _one(spark, deadline("v"), text) == want


def test_impossible_date_fails_strict_and_is_null_tolerant(spark):
    with pytest.raises(Exception):
        _one(spark, parse_day("v"), "31/02/2024")
    assert _one(spark, parse_day("v", strict=False), "31/02/2024") is None


def test_format_day(spark):
    assert _one(spark, format_day("v"), dt.date(2024, 7, 4), "date") == "04/07/2024"


def test_to_int_strict_and_tolerant(spark):
    assert _one(spark, to_int("v"), " 42 ") == 42
    with pytest.raises(Exception):
        _one(spark, to_int("v"), "abc")
    assert _one(spark, to_int("v", strict=False), "abc") is None
    assert _one(spark, to_int("v"), None) is None


def test_tokens(spark):
    assert _one(spark, token("v", 2), "admission_approval 12 2024.pdf") == "2024.pdf"
    assert _one(spark, token("v", 1), "admission_approval  12 x") == ""          # double blank
    with pytest.raises(Exception):
        _one(spark, token("v", 2), "admission_approval 12")
    assert _one(spark, token("v", 2, strict=False), "admission_approval 12") is None


def test_notes_never_match_when_malformed(spark):
    df = spark.createDataFrame([('{"sem": "1y"}',), ('{"sem": null}',), ("not json",), ('{}',)], "n string")
    got = [r.s for r in df.select(note_field("n", "sem").alias("s")).collect()]
    assert got == ["1y", None, None, None]
    assert df.where(note_field(F.col("n"), "sem") == "1y").count() == 1
