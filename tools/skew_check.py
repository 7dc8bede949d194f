"""Skew check: one exam group holding every application.

    python tools/skew_check.py [sf_dir]

Rewrites the application table of a snapshot so that all forms fall into one
(subcode, semyr_code) group, runs the annual re-totalling report and the
accepted counts, and reads Spark's event log (written to a fresh scratch
folder; no UI) to report, per shuffle-reading stage, the share of records
read by the busiest task.  A naive plan that partitions the applications by
group key is run for contrast.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from retally.plans.reconcile import accepted_counts  # noqa: E402
from retally.plans.report import scrutiny_report  # noqa: E402
from retally.session import local_session, scratch_path  # noqa: E402
from retally.sources.derived import exam_tables_from_tpch  # noqa: E402
from retally.sources.snapshot import write_snapshot  # noqa: E402
from retally.specs import REPORTS  # noqa: E402


def _lines(path: str):
    """Lines of an event-log file, plain or zstd-compressed (Spark 4 rolls and compresses logs)."""
    if path.endswith((".zstd", ".zst")):
        import io

        import zstandard
        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path) as f:
            yield from f


def _task_reads(log_dir: str) -> dict[tuple[int, str], list[int]]:
    """(stage id, job group) -> shuffle records read per task, from the event log."""
    reads: dict[tuple[int, str], list[int]] = defaultdict(list)
    stage_group: dict[int, str] = {}
    for path in sorted(glob.glob(f"{log_dir}/**/*", recursive=True)):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                grp = (ev.get("Properties") or {}).get("spark.job.description", "")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = grp
            elif kind == "SparkListenerTaskEnd":
                m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                n = m.get("Total Records Read", 0)
                if n:
                    sid = ev["Stage ID"]
                    reads[(sid, stage_group.get(sid, ""))].append(n)
    return reads


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="skew-events-")
    spark = local_session(8, 32, app="retally-skew", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    snap = write_snapshot(exam_tables_from_tpch(spark, sf_dir), scratch_path(spark, "skew"))
    spec = REPORTS["annual_rt"]
    hot = snap[spec.application_table].withColumn("subcode", F.lit("S1")).withColumn("semyr_code", F.lit("1"))
    t = snap.with_table(spec.application_table, hot)

    runs = {
        "report": lambda: scrutiny_report(t, spec),
        "accepted_counts": lambda: accepted_counts(t[spec.application_table], t["payment"], spec.purpose),
        "naive_by_group": lambda: hot.repartition("subcode", "semyr_code").groupBy("subcode", "semyr_code", "scanno")
        .count(),
    }
    for name, build in runs.items():
        spark.sparkContext.setJobDescription(name)
        build().write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    print("| job | stage | tasks | records read | busiest task | share |")
    print("|---|---|---|---|---|---|")
    for (sid, grp), per_task in sorted(_task_reads(log_dir).items()):
        total = sum(per_task)
        if total < 1000 or grp not in runs:      # skip the snapshot build and tiny stages
            continue
        top = max(per_task)
        print(f"| {grp} | {sid} | {len(per_task)} | {total} | {top} | {top / total:.0%} |")


if __name__ == "__main__":
    main(sys.argv)
