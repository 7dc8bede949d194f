"""Intermediate tables in the cluster's shared folder.

Operators that need a result twice, or that cut a long lineage, write it as
parquet below the folder named by ``spark.checkpoint.dir`` and read it back:
the files outlive any executor.  ``release`` removes what a session wrote; it
also runs when the driver's interpreter ends.
"""

from __future__ import annotations

import atexit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retally.session import scratch_path

_WRITTEN: list[tuple[SparkSession, str]] = []
_TABLES: list[tuple[SparkSession, str]] = []

# ASCII white space [\x20\x09-\x0D]: the word separators of every operator here.
WHITE = " \t\n\x0b\x0c\r"


def fresh_path(spark: SparkSession, purpose: str) -> str:
    path = scratch_path(spark, f"llm-{purpose}")
    _WRITTEN.append((spark, path))
    return path


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the table read back."""
    path = fresh_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete one scratch folder through the Hadoop file system it lies in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release() -> None:
    """Remove every scratch folder written by operators of this process.

    Call it once the results are stored elsewhere: DataFrames returned by the
    operators read these folders when they are executed.
    """
    while _TABLES:
        spark, table = _TABLES.pop()
        try:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        except Exception:  # the session has ended, and its catalog entry with it
            continue
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        try:
            remove(spark, path)
        except Exception:  # the session has ended; its deployment cleans the folder
            continue


atexit.register(release)


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array (null text: none), JVM side."""
    spaced = F.translate(F.coalesce(text, F.lit("")), WHITE, " " * len(WHITE))
    return F.array_remove(F.split(spaced, " "), "")


def without_white(text: Column) -> Column:
    """The text without any ASCII white space (null: empty)."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def read_documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_bytes(df: DataFrame, text: str = "text") -> int:
    return int(df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0)


MAX_PARTS = 40_000       # Spark refuses more than 100,000 buckets, and shuffle blocks grow with mappers times reducers


def part_count(size: int, parallelism: int, target_bytes: int = 16 * 1024 * 1024) -> int:
    """Partitions for ``size`` bytes of text: about ``target_bytes`` each, no fewer than the parallelism (up to 64).

    From ``MAX_PARTS`` on (640 GB) partitions grow instead of their number, to
    2.5 GB at 100 TB: tasks stream their rows in batches, so their memory stays.
    """
    return max(2, min(MAX_PARTS, -(-size // target_bytes)), min(64, parallelism))


def parts_for(df: DataFrame, text: str = "text", target_bytes: int = 16 * 1024 * 1024) -> int:
    return part_count(text_bytes(df, text), df.sparkSession.sparkContext.defaultParallelism, target_bytes)


def bucketed(df: DataFrame, key: str, buckets: int, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder, bucketed by ``key``: joins on it read it without a shuffle.

    Without a shuffle before the write, too: every task files its rows by bucket.
    """
    spark = df.sparkSession
    path = fresh_path(spark, purpose)
    table = "retally_" + path.rsplit("/", 1)[1]
    df.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(table)
    _TABLES.append((spark, table))
    return spark.table(table)
