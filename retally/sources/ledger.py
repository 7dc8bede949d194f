"""The drop ledger: which drops of a folder were seen, and which one each import took.

A *drop* is a file, or a folder of part files as Spark writes them, directly in
the drop folder.  The ledger is a small dataset with a row per drop seen: path,
modification time, length, and whether it was imported.  A drop is new if this
triple is not in the ledger, so a file that was written anew under its old name
is new too.  Choosing the drop to import is an anti join of the listing with
the ledger and one maximum; nothing but the chosen path comes to the driver.

Order of an import: read the newest new drop, replace the table (all or
nothing, ``sources.versions``), then add the new drops to the ledger.  A run
that dies in between does the same again and ends with the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType, TimestampType

from retally.session import path_exists
from retally.sources.files import list_drops, read_drop
from retally.sources.sinks import checkpointed
from retally.sources.versions import replace_table

LEDGER = StructType([
    StructField("path", StringType()), StructField("modificationTime", TimestampType()), StructField("length", LongType()),
    StructField("imported", BooleanType()),
])
KEY = ("path", "modificationTime", "length")


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows (none before the first import)."""
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def new_drops(listing: DataFrame, seen: DataFrame) -> DataFrame:
    """Drops of the listing that the ledger does not hold as they are now."""
    return listing.join(seen.select(*KEY), list(KEY), "left_anti")


def newest_new(listing: DataFrame, seen: DataFrame) -> DataFrame:
    """The newest drop as one row (path, modificationTime, length) if it is new; no row otherwise.

    An older drop that arrives late never replaces a newer one: the maximum is
    taken over new drops and those that were imported.
    """
    place = F.struct("modificationTime", "path", "length")
    fresh = new_drops(listing, seen).select(place.alias("at"), F.lit(True).alias("fresh"))
    taken = seen.where("imported").select(place.alias("at"), F.lit(False).alias("fresh"))
    newest = fresh.unionByName(taken).agg(F.max(F.struct("at", "fresh")).alias("newest"))
    return newest.where("newest.fresh").select("newest.at.*")


def record(drops: DataFrame, ledger: str, imported: str | None) -> None:
    """Add drops to the ledger; ``imported`` is the path of the one that the table now holds."""
    rows = drops.select(*KEY, (F.col("path") == F.lit(imported)).alias("imported"))
    rows.coalesce(1).write.mode("append").parquet(ledger)        # a row per drop: one small file per import


def import_newest(spark: SparkSession, folder: str, table: str, ledger: str, prefix: str = "payments",
                  schema: StructType | None = None, fmt: str | None = None, path: str | None = None) -> str | None:
    """Replace ``table`` with the newest drop if it is new; returns its path (None: nothing newer came).

    A drop that can not be read whole leaves the table and the ledger as they
    were, so the next run tries again.
    """
    listing, seen = list_drops(spark, folder, prefix), read_ledger(spark, ledger)
    # the listing is fixed before the import: a drop that arrives meanwhile is new in the next run
    fresh = checkpointed(spark, new_drops(listing, seen), "new-drops")
    chosen = newest_new(fresh, seen).first()
    if chosen is not None:
        replace_table(read_drop(spark, chosen["path"], schema, fmt), table, path)
    record(fresh, ledger, None if chosen is None else chosen["path"])
    return None if chosen is None else chosen["path"]
