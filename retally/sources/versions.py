"""Replacing a table without a moment in which it is missing or half written.

A replaced table is an external table over the newest of its *version* folders.
``replace_table`` writes the new rows to a folder of their own and only then
lets the catalog point to it:

* same columns and format: one ``ALTER TABLE ... SET LOCATION``, a single change
  in the catalog.  Readers see the old rows or the new ones;
* other columns (a payment drop brings what its file holds), or a table that
  was not made here: the new table is registered under a name of its own, and
  two renames exchange the entries.  A failure in between renames the old one
  back, and ``recover`` does the same after a crash of the driver.

A write that fails leaves the table as it was; its folder is removed.  The
version before the current one is kept, because running queries may still read
its files; older ones are removed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from retally.session import delete_path

KEPT_VERSIONS = 2                  # the current one and the one before
OLD = "__replaced"                 # suffix of the entry that waits while names are exchanged


def _quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.replace("`", "").split("."))


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    """Location and provider of a table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").collect()
    return {r["col_name"]: r["data_type"] for r in rows if r["col_name"] in ("Location", "Provider", "Type")}


def versions_folder(spark: SparkSession, table: str, path: str | None = None) -> str:
    """Folder of a table's versions: ``path``, or beside the tables of the warehouse."""
    if path:
        return path.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.replace('`', '').replace('.', '/')}__versions"


def _version_folders(spark: SparkSession, folder: str) -> list[str]:
    """Existing version folders, oldest first (their names grow)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]
    return [f"{folder}/{n}" for n in sorted(names) if n.startswith("v")]


def _next_version(spark: SparkSession, folder: str) -> str:
    before = _version_folders(spark, folder)
    number = int(before[-1].rsplit("/v", 1)[1].split("-")[0]) + 1 if before else 1
    return f"{folder}/v{number:010d}-{uuid.uuid4().hex[:8]}"


def recover(spark: SparkSession, table: str) -> None:
    """Undo an exchange of names that a crash cut short."""
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(table + OLD):
        spark.sql(f"ALTER TABLE {_quoted(table + OLD)} RENAME TO {_quoted(table)}")


def _exchange(spark: SparkSession, table: str, location: str, fmt: str) -> None:
    """Register ``location`` under the table's name in place of the present entry."""
    fresh = f"{table}__{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {_quoted(fresh)} USING {fmt} LOCATION '{location}'")
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(table + OLD)}")
    spark.sql(f"ALTER TABLE {_quoted(table)} RENAME TO {_quoted(table + OLD)}")
    try:
        spark.sql(f"ALTER TABLE {_quoted(fresh)} RENAME TO {_quoted(table)}")
    except BaseException:
        recover(spark, table)
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(fresh)}")
        raise
    spark.sql(f"DROP TABLE {_quoted(table + OLD)}")


def replace_table(df: DataFrame, table: str, path: str | None = None, fmt: str = "parquet") -> str:
    """Make ``df`` the content of ``table``; returns the folder of the new version.

    ``path`` is the folder that holds the versions (default: in the warehouse).
    ``df`` may read the table itself.
    """
    spark = df.sparkSession
    recover(spark, table)
    folder = versions_folder(spark, table, path)
    location = _next_version(spark, folder)
    try:
        df.write.format(fmt).save(location)
    except BaseException:
        delete_path(spark, location)
        raise
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {_quoted(table)} USING {fmt} LOCATION '{location}'")
    else:
        now = _described(spark, table)
        written = spark.read.format(fmt).load(location).schema
        same = [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in written]
        if same and now.get("Provider") == fmt and now.get("Type") == "EXTERNAL":
            spark.sql(f"ALTER TABLE {_quoted(table)} SET LOCATION '{location}'")
        else:
            _exchange(spark, table, location, fmt)
    spark.catalog.refreshTable(table)
    for old in _version_folders(spark, folder)[:-KEPT_VERSIONS]:
        delete_path(spark, old)
    return location
