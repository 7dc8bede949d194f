"""Session helpers.

Library code never creates a session: every job takes the caller's
``SparkSession``.  ``local_session`` is for tests, the bench and the CLI; on a
cluster the deployment supplies the session and its configuration.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs are written against.  AQE re-plans joins from runtime sizes
# (broadcast only below the threshold, sort-merge above it), splits skewed join
# partitions and coalesces small shuffle partitions.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    # Partition sizing: scans split at 256 MiB, shuffle partitions coalesced
    # by AQE towards 128 MiB, skewed join partitions split beyond 5x median.
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    # The annual application row has 134 columns; above the default of 100
    # fields whole-stage codegen is switched off for the fan-out stage
    # (measured ~25% slower report at sf0.1).
    "spark.sql.codegen.maxFields": "300",
}


def cluster_conf(input_bytes: int, shuffle_bytes_per_partition: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` of source data on a cluster.

    The initial shuffle partition count is sized so that even a shuffle as
    large as the input stays near ``shuffle_bytes_per_partition`` per task
    (spill-free on a few GiB of executor memory); AQE then coalesces the
    smaller shuffles of the same job.  E.g. 100 TB -> about 745,000
    partitions; raise ``shuffle_bytes_per_partition`` where executors have the
    memory for fewer and larger ones.
    """
    parts = max(200, -(-input_bytes // shuffle_bytes_per_partition))
    return {
        **ENGINE_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
    }

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "retally",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**ENGINE_CONF, **LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # a fresh warehouse per local session: managed tables never land in the working tree
    builder = builder.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="retally-wh-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


# Columns up to which a stage's rows are read and written by one generated method (see ``split_rows``).
ONE_METHOD_FIELDS = 25


@contextmanager
def split_rows(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside handle wide rows operator by operator, by code that is split into methods.

    Whole-stage code reads and writes all columns of a row in one method.  From
    some 50 columns on the JVM compiles that late or, beyond 8000 bytes, never:
    the 86 columns of a CSV dump took ten times the CPU.
    """
    name = "spark.sql.codegen.maxFields"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), ONE_METHOD_FIELDS)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    Set by the deployment and read here.  Where it is unset, a folder in the
    warehouse is registered, which executors reach as well.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current.rstrip("/")
    sc.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/retally-scratch")
    return sc.getCheckpointDir().rstrip("/")


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unused location under the shared folder; ``release_scratch`` removes what is written there."""
    path = f"{shared_dir(spark)}/retally/{purpose}/{uuid.uuid4().hex}"
    _SCRATCH.append((spark, path))
    return path


def release_scratch(spark: SparkSession | None = None) -> None:
    """Remove the intermediate tables of this process (of one session's, if given).

    Call it when results are stored elsewhere: DataFrames of gates, gated runs
    and parsed payments read these folders.  It also runs when the driver's
    interpreter ends.
    """
    for item in list(_SCRATCH):
        if spark is None or item[0] is spark:
            _SCRATCH.remove(item)
            try:
                delete_path(*item)
            except Exception:  # the session has ended; its deployment cleans the folder
                continue


atexit.register(release_scratch)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder or file through the Hadoop file system it lies in (nothing there: nothing happens)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
