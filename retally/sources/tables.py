"""The exam tables a job reads, wherever they live.

Jobs take an ``ExamTables`` and ask it for tables by their source names, so the
same plan runs over catalog tables, a parquet snapshot folder, or tables
derived from other data.  Nothing is read until a plan needs it, and every
read is a lazy DataFrame (column pruning and filters reach the scan).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from retally import schemas
from retally.session import path_exists

# Source table names.
RESULT_TABLES = ("result_annual", "result")
APPLICATION_TABLES = (
    "result_annual_retotaling", "result_annual_reval", "result_retotaling", "result_reval",
)
HISTORY_TABLES = ("annual_scrutiny_report", "scrutiny_report")
PAYMENT_TABLE = "payment"
ALL_TABLES = RESULT_TABLES + APPLICATION_TABLES + HISTORY_TABLES + (PAYMENT_TABLE,)


class ExamTables:
    """Named, lazily built DataFrames.  Each table is built once per instance."""

    def __init__(self, spark: SparkSession, loaders: Mapping[str, Callable[[], DataFrame]]):
        self.spark = spark
        self._loaders = dict(loaders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name not in self._loaders:
                raise KeyError(f"unknown exam table {name!r}")
            self._built[name] = self._loaders[name]()
        return self._built[name]

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table derived from the others, built at first use and shared by all jobs over this instance."""
        if name not in self._built:
            self._built[name] = build()
        return self._built[name]

    def names(self) -> tuple[str, ...]:
        return tuple(self._loaders)

    def with_table(self, name: str, df: DataFrame) -> ExamTables:
        loaders = dict(self._loaders)
        loaders[name] = lambda: df
        return ExamTables(self.spark, loaders)

    def sharing(self, name: str, df: DataFrame) -> ExamTables:
        """These tables with ``name`` replaced; what is already built stays shared."""
        other = self.with_table(name, df)
        other._built = {**self._built, name: df}
        return other

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> ExamTables:
        return cls(spark, {k: (lambda v=v: v) for k, v in frames.items()})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str | None = None) -> ExamTables:
        prefix = f"{database}." if database else ""
        return cls(spark, {t: (lambda t=t: spark.table(prefix + t)) for t in ALL_TABLES})

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str) -> ExamTables:
        """One parquet dataset per table under ``folder`` (a snapshot, see ``sources.snapshot``).

        Tables written in buckets are read as bucketed: joins on ``id`` need no
        shuffle.  Result tables filed by publish date are read so.
        """
        folder = folder.rstrip("/")
        counts = {r["name"]: r["buckets"] for r in _bucket_counts(spark, folder)}

        def load(name: str) -> DataFrame:
            path = f"{folder}/{name}"
            if name in counts:
                return _bucketed(spark, path, counts[name])
            return read_dated(spark, path, name) if name in RESULT_TABLES else spark.read.parquet(path)

        return cls(spark, {t: (lambda t=t: load(t)) for t in ALL_TABLES})


def read_dated(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A result table, filed by publish date or not: the date stays text, columns keep their order."""
    schema = schemas.BY_TABLE[name]
    return spark.read.schema(schema).parquet(path).select(*schema.names)


# Dataset beside the tables of a snapshot: (name, buckets) of those written in buckets.
BUCKET_COUNTS = "bucket_counts"


def _bucket_counts(spark: SparkSession, folder: str) -> list:
    """At most one row per wide table; none for a folder without the dataset."""
    if not path_exists(spark, f"{folder}/{BUCKET_COUNTS}"):
        return []
    return spark.read.schema("name string, buckets int").parquet(f"{folder}/{BUCKET_COUNTS}").collect()


def _bucketed(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The files of a bucketed table as a catalog table of this session that knows its buckets."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    name = f"retally_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (id) SORTED BY (id) INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")
    return spark.table(name)
