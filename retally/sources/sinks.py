"""Writing tables and reports.

* ``replace_table``  — make a finished DataFrame the content of a table (the
  payment import, the staging reset), see ``sources.versions``.
* ``append_table``   — append rows, columns found by name (the file register).
* ``stage_report``   — replace the staging table by a finished report, by column
  *position*, as ``INSERT INTO t SELECT ...`` does, after checking the arity.
* ``export_report``  — the report file: CSV with a header, one folder per
  scrutiny type.
* ``checkpointed``   — cut a long lineage by writing to the shared folder.
* ``clustered``      — the same in buckets by a key, one file each.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from retally import schemas
from retally.session import scratch_path
from retally.sources.files import CSV_READ, CSV_WRITE
from retally.sources.versions import replace_table
from retally.specs import REPORT_COLUMNS


def append_table(df: DataFrame, table: str, path: str | None = None, fmt: str = "parquet") -> None:
    """Append rows to ``table``, made at first use.

    Columns are found by name, whatever their order; a column that either side
    lacks fails before anything is written.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        names = spark.table(table).columns
        if sorted(names) != sorted(df.columns):
            raise ValueError(f"{table} has the columns {', '.join(names)}, the rows have {', '.join(df.columns)}")
        df.select(*[F.col(f"`{n}`") for n in names]).write.insertInto(table)
        return
    writer = df.write.mode("append").format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def _is_text(field: StructField) -> bool:
    return isinstance(field.dataType, StringType)


def stage_report(report: DataFrame, table: str, path: str | None = None) -> str:
    """Replace the staging table with ``report`` (the reset and the insert in one switch); returns its folder.

    The report's columns go by position into the staged columns and are cast to
    their types, as in ``INSERT INTO ... SELECT``.  A report that fails to be
    written leaves the staging table as it was.
    """
    if len(report.columns) != len(REPORT_COLUMNS):
        raise ValueError(f"a staged report has {len(REPORT_COLUMNS)} columns, got {len(report.columns)}")
    wrong = [f"{c.name} ({f.name})" for c, f in zip(report.schema, schemas.REPORT) if _is_text(c) and not _is_text(f)]
    if wrong:
        raise TypeError(f"text can not go into the columns {', '.join(wrong)}")
    placed = report.toDF(*REPORT_COLUMNS)
    return replace_table(placed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.REPORT]), table, path)


def export_report(report: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write the report as files, one folder per scrutiny type, header row included."""
    writer = report.write.mode("overwrite").partitionBy("scrutiny_type")
    if fmt == "csv":
        writer.options(**CSV_WRITE).csv(path)
    else:
        writer.format(fmt).save(path)


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """An exported CSV report, every value as it was written."""
    return spark.read.schema(schemas.REPORT).options(**CSV_READ).csv(path)


def checkpointed(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """Materialise ``df`` as parquet under the shared folder and read it back.

    Survives executor loss (the files are on shared storage) and cuts the
    lineage, unlike a local checkpoint.
    """
    path = scratch_path(spark, purpose)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def clustered(df: DataFrame, key: str, buckets: int, purpose: str) -> DataFrame:
    """``checkpointed``, in ``buckets`` by ``key``: groups and joins on the key read it without a shuffle.

    The catalog entry only tells Spark of the buckets and goes at once; the files are scratch.
    """
    spark = df.sparkSession
    table, path = f"retally_{purpose}_{uuid.uuid4().hex}", scratch_path(spark, purpose)
    df.repartition(buckets, key).write.bucketBy(buckets, key).format("parquet").option("path", path).saveAsTable(table)
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")         # an external table leaves its files
    return rows
