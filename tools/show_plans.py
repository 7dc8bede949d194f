"""Print the physical plan (tree part of ``explain("formatted")``) of jobs over a snapshot.

    python tools/show_plans.py [sf_dir] [job ...]

Each job is executed first through its own query execution (rows are counted
on the driver; this is a diagnostics tool for test scales), so the adaptive
plan shown is the final one, with the join strategies AQE picked from runtime
sizes.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from retally.registry import JOBS  # noqa: E402
from retally.session import local_session, scratch_path  # noqa: E402
from retally.sources.derived import exam_tables_from_tpch  # noqa: E402
from retally.sources.snapshot import write_snapshot  # noqa: E402


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in argv[1:] if not a.startswith("/")] or ["scrutiny_annual_rt", "gated_semester_rv"]
    spark = local_session(8, 16)
    snap = write_snapshot(exam_tables_from_tpch(spark, sf_dir), scratch_path(spark, "plans"), buckets=16)
    for name in names:
        df = JOBS[name](spark, snap, sf_dir)
        rows = len(df.collect())
        mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        text = df._jdf.queryExecution().explainString(mode)
        tree = text.split("\n\n\n")[0]
        print(f"### {name} ({rows} rows)\n\n```\n{tree.rstrip()}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
