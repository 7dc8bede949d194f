"""File register (J1) and newest payment drop (J2) as checkpointed file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from retally import schemas
from retally.plans.ingest import register_entries
from retally.session import shared_dir
from retally.sources.files import read_drop
from retally.sources.sinks import replace_table

# Fixed schema of the binaryFile source.
BINARY_FILE = StructType([
    StructField("path", StringType()), StructField("modificationTime", TimestampType()),
    StructField("length", LongType()), StructField("content", BinaryType()),
])


def _checkpoint(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return checkpoint or f"{shared_dir(spark)}/retally/streams/{name}"


def register_stream(spark: SparkSession, folder: str, table: str, checkpoint: str | None = None,
                    strict: bool = True, available_now: bool = True) -> StreamingQuery:
    """Append register rows for files new to ``folder`` since the last run (file content never read)."""
    names = (spark.readStream.format("binaryFile").schema(BINARY_FILE).load(folder)
             .select(F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name")))
    rows = register_entries(names, F.lit(folder), strict=strict)
    writer = rows.writeStream.option("checkpointLocation", _checkpoint(spark, f"register-{table}", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.outputMode("append").toTable(table)


# Table property that names the drop a payment table holds: "<modification time in microseconds> <path>".
DROP_PROPERTY = "retally.drop"


def _held_drop(spark: SparkSession, table: str) -> tuple[int, str]:
    """(modification time, path) of the drop that ``table`` holds; (-1, "") if none."""
    if not spark.catalog.tableExists(table):
        return -1, ""
    for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect():
        if row["key"] == DROP_PROPERTY:
            at, path = row["value"].split(" ", 1)
            return int(at), path
    return -1, ""


def payment_drop_stream(spark: SparkSession, folder: str, table: str = "payment", prefix: str = "payments",
                        fmt: str | None = None, checkpoint: str | None = None,
                        available_now: bool = True) -> StreamingQuery:
    """Replace ``table`` with the newest ``prefix*`` drop among the files new since the last run.

    The stream carries file names and times only; the newest file of a batch
    is read once, by column name, as ``import_payments`` does.  The table
    remembers its drop, so an older file that arrives later changes nothing and
    a batch replayed after a failure gives the same table.
    """
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", f"{prefix}*").load(folder)
             .select("path", F.unix_micros("modificationTime").alias("at")))

    def replace(batch: DataFrame, batch_id: int) -> None:
        newest = batch.agg(F.max(F.struct("at", "path")).alias("n")).first()["n"]
        session = batch.sparkSession
        if newest is None or (newest["at"], newest["path"]) <= _held_drop(session, table):
            return
        replace_table(read_drop(session, newest["path"], schemas.PAYMENT, fmt), table)
        value = f"{newest['at']} {newest['path']}".replace("'", "\\'")
        session.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{DROP_PROPERTY}' = '{value}')")
        spark.catalog.refreshTable(table)   # the batch runs in a cloned session

    writer = files.writeStream.option("checkpointLocation", _checkpoint(spark, f"drops-{table}", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.foreachBatch(replace).start()
