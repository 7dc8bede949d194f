"""File register (J1) and latest payment-drop import (J2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retally import schemas
from retally.functions.casts import to_int
from retally.functions.tokens import token
from retally.sources.files import list_files, newest_path, read_drop
from retally.sources.sinks import append_table, replace_table

# Fixed value: first token of the file names the register records.
REGISTER_LABEL = "admission_approval"


def register_entries(names: DataFrame, src_location: Column | str, name_column: str = "file_name",
                     strict: bool = True) -> DataFrame:
    """Register rows for the names whose first blank-separated token is the label.

    (lable, coll_code, date, src_location) = tokens 0, 1 (as int) and 2 (kept
    whole, extension included) of the name, plus the folder.  Names with too
    few tokens fail when ``strict`` and give NULLs otherwise; names with
    another first token are skipped before any further token is read.
    """
    loc = F.lit(src_location) if isinstance(src_location, str) else src_location
    picked = names.where(token(name_column, 0, strict=False) == REGISTER_LABEL)
    return picked.select(
        token(name_column, 0, strict).alias("lable"),
        to_int(token(name_column, 1, strict), strict).alias("coll_code"),
        token(name_column, 2, strict).alias("date"),
        loc.alias("src_location"),
    )


def file_register(spark: SparkSession, folder: str, strict: bool = True) -> DataFrame:
    """Register rows for the entries of ``folder``."""
    return register_entries(list_files(spark, folder), F.lit(folder), strict=strict)


def record_files(spark: SparkSession, folder: str, table: str, strict: bool = True) -> None:
    """Append the register rows of ``folder`` to ``table``."""
    append_table(file_register(spark, folder, strict), table)


def latest_drop(spark: SparkSession, folder: str, prefix: str = "payments", schema=None,
                fmt: str | None = None) -> DataFrame:
    """Rows of the newest file in ``folder`` whose name starts with ``prefix``."""
    path = newest_path(spark, folder, prefix)
    if path is None:
        raise FileNotFoundError(f"no file starting with {prefix!r} in {folder}")
    return read_drop(spark, path, schema, fmt)


def import_payments(spark: SparkSession, folder: str, table: str = "payment", prefix: str = "payments",
                    fmt: str | None = None, path: str | None = None) -> None:
    """Replace ``table`` with the newest payment drop, all its columns (fails loudly if there is none
    or a payment column is missing)."""
    replace_table(latest_drop(spark, folder, prefix, schemas.PAYMENT, fmt), table, path)
