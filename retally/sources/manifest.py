"""The manifest of a run: which of its tables are finished, so that a restarted run goes on from there.

A run is a row of steps, each a table written once under the run's folder.  A
step's name and folder enter the manifest after its write has ended; a step that
is in the manifest is read, any other is built anew (what a broken attempt left
is in a folder of its own and is removed at the end).  The manifest belongs to
one ``run_key``, the text of everything that decides the result: a run with
another key starts from nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retally.session import delete_path, path_exists

ENTRY = "run_key string, name string, path string, place long"


class RunManifest:
    def __init__(self, spark: SparkSession, folder: str, run_key: str):
        self.spark, self.folder, self.run_key = spark, folder.rstrip("/"), run_key
        self.built: list[str] = []           # steps that this process ran itself

    @property
    def _entries(self) -> str:
        return f"{self.folder}/_manifest"

    def finished(self) -> dict[str, str]:
        """Finished steps of this run and their folders (a few rows: one per step)."""
        if not path_exists(self.spark, self._entries):
            return {}
        rows = self.spark.read.schema(ENTRY).parquet(self._entries).where(F.col("run_key") == self.run_key).collect()
        return {r["name"]: r["path"] for r in sorted(rows, key=lambda r: r["place"])}

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table of a step: read if it is finished, else built, written and entered."""
        done = self.finished()
        if name not in done:
            path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
            build().write.parquet(path)
            entry = self.spark.createDataFrame([(self.run_key, name, path, len(done))], ENTRY)
            entry.coalesce(1).write.mode("append").parquet(self._entries)
            self.built.append(name)
            done[name] = path
        return self.spark.read.parquet(done[name])

    def close(self) -> None:
        """Remove the run's tables and its manifest: call it when the results are stored elsewhere."""
        delete_path(self.spark, self.folder)
