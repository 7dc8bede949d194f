"""Captured payments that can not be placed on any list, with the reason (Q11).

The lists read a payment by its notes; one with unreadable notes, or of a known
purpose without what its list needs, is on no list.  ``payment_rejects`` says
which and why, ``watched`` counts them while the payments are parsed for
another purpose, and ``check_rejects`` fails a run that lost too many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from retally.functions.casts import to_int
from retally.functions.notes import NOTE_KEYS, note_fields
from retally.specs import CAPTURED, REPORTS

PURPOSES = tuple(s.purpose for s in REPORTS.values())

# Reasons, the first that fits.
NOT_JSON, NO_PURPOSE, NO_COURSE, NO_SEM = "notes unreadable", "no purpose", "no course", "no semester"
NO_FORM, BAD_FORM = "no form number", "form number is no integer"


class TooManyRejects(ValueError):
    """More captured payments than allowed are on no list."""


def parsed(payment: DataFrame) -> DataFrame:
    """Captured payments with their note fields and ``readable``: whether the notes are a JSON object."""
    fields = payment.where(F.col("status") == CAPTURED).select("*", *note_fields("notes", NOTE_KEYS))
    return fields.withColumn("readable", F.coalesce(F.get_json_object("notes", "$").startswith("{"), F.lit(False)))


def reject_reason() -> Column:
    """Why a parsed captured payment is on no list; NULL if it is on one or its purpose is none of ours."""
    ours = F.col("pay_for").isin(*PURPOSES)
    return (F.when(~F.col("readable"), F.lit(NOT_JSON))
            .when(F.col("pay_for").isNull(), F.lit(NO_PURPOSE))
            .when(ours & F.col("course").isNull(), F.lit(NO_COURSE))
            .when(ours & F.col("sem").isNull(), F.lit(NO_SEM))
            .when(ours & F.col("description").isNull(), F.lit(NO_FORM))
            .when(ours & to_int("description", strict=False).isNull(), F.lit(BAD_FORM)))


def payment_rejects(payment: DataFrame) -> DataFrame:
    """(description, notes, reason) of every captured payment that is on no list although it should be."""
    return (parsed(payment).withColumn("reason", reject_reason()).where(F.col("reason").isNotNull())
            .select("description", "notes", "reason"))


def watched(payment: DataFrame, observation: Observation) -> DataFrame:
    """Captured payments with their fields; running the plan counts them and the rejects."""
    return (parsed(payment).withColumn("reason", reject_reason())
            .observe(observation, F.count("*").alias("captured"), F.count("reason").alias("rejected")))


def check_rejects(observation: Observation, allowed: float | None) -> dict[str, int]:
    """The counts of a finished ``watched`` plan; fails if the share of rejects is above ``allowed``."""
    counts = observation.get
    if allowed is not None and counts["rejected"] > allowed * counts["captured"]:
        raise TooManyRejects(f"{counts['rejected']} of {counts['captured']} captured payments are on no list "
                             f"(allowed: {allowed:.2%}); payment_rejects lists them")
    return counts
