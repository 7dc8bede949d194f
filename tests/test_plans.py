"""Plan shape: constant scans in the slot count, no Python UDFs, no nested loops, pushdown."""

from retally.plans.report import scrutiny_report
from retally.registry import QUERIES
from retally.sources.derived import exam_tables_from_tpch
from retally.sources.snapshot import write_snapshot
from retally.specs import REPORTS

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scan_lines(plan: str) -> list[str]:
    return [ln for ln in plan.splitlines() if "FileScan parquet" in ln]


def test_report_scans_each_wide_table_once(spark, tmp_path):
    """The union-per-slot form scans both wide tables once per slot (40 / 12 times); ours once."""
    snap = write_snapshot(exam_tables_from_tpch(spark, SF), str(tmp_path / "snap"))
    for key in ("annual_rt", "annual_rv", "semester_rt", "semester_rv"):
        scans = _scan_lines(_plan(scrutiny_report(snap, REPORTS[key])))
        applications = [ln for ln in scans if "retotaling_status" in ln]
        results = [ln for ln in scans if "sub1p1code" in ln and "retotaling_status" not in ln]
        assert len(applications) == 1 and len(results) == 1, (key, scans)


def test_no_python_udf_and_no_nested_loop_anywhere(spark):
    for name, fn in QUERIES.items():
        if name in ("snapshot_load", "report_export", "snapshot_tables", "import_replace", "drop_ledger", "published_groups_dated"):
            continue                                    # these write files while being built
        plan = _plan(fn(spark, SF))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "NestedLoopJoin",
                    "CartesianProduct"):
            assert bad not in plan, (name, bad)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    snap = write_snapshot(exam_tables_from_tpch(spark, SF), str(tmp_path / "snap"),
                          names=["result_annual_retotaling", "result_annual", "annual_scrutiny_report"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = _plan(scrutiny_report(snap, REPORTS["annual_rt"]))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    app_scan = [ln for ln in _scan_lines(plan) if "retotaling_status" in ln][0]
    assert "EqualTo(payment_status,0300)" in app_scan and "EqualTo(retotaling_status,Y)" in app_scan
    assert "pub_result" not in app_scan                   # pruned: the report never reads it
    hist_scan = [ln for ln in _scan_lines(plan) if "scrutiny_type" in ln][0]
    assert "EqualTo(scrutiny_type,rt)" in hist_scan


GROUP_KEYS = {"subcode", "semyr_code", "course", "pub_result"}


def test_no_unaggregated_shuffle_on_group_keys(spark, tmp_path):
    """A hot exam group must not land in one task: every exchange keyed only by group
    columns carries partial aggregates (one combined row per task), never raw rows."""
    from retally.plans.runs import gated_run
    snap = write_snapshot(exam_tables_from_tpch(spark, SF), str(tmp_path / "snap"))
    for key in REPORTS:
        df = gated_run(snap, REPORTS[key], "01/01/1996")
        df.write.format("noop").mode("overwrite").save()
        lines = _plan(df).splitlines()
        for i, ln in enumerate(lines):
            if "Exchange hashpartitioning(" not in ln:
                continue
            inner = ln.split("hashpartitioning(", 1)[1]
            keys = {k.split("#")[0].strip() for k in inner.split(")")[0].split(",")[:-1]}
            if keys and keys <= GROUP_KEYS:
                assert "partial_" in lines[i + 1] or "HashAggregate" in lines[i + 1], (key, ln, lines[i + 1])


def _no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")


def _restore(spark):
    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(k, str(32 * 1024 * 1024))


def _depth(line: str) -> int:
    return len(line) - len(line.lstrip(" :+-"))


def test_reports_never_exchange_the_wide_application_rows(spark, tmp_path):
    """Without broadcasts, the application scan reaches its first exchange only as narrow fanned-out rows."""
    snap = write_snapshot(exam_tables_from_tpch(spark, SF), str(tmp_path / "snap"))
    _no_broadcast(spark)
    try:
        for key, spec in REPORTS.items():
            plan = scrutiny_report(snap, spec)._jdf.queryExecution().executedPlan()
            lines = plan.toString().splitlines()
            at = next(i for i, ln in enumerate(lines) if "FileScan parquet" in ln and "retotaling_status" in ln)
            above, depth = [], _depth(lines[at])
            for ln in lines[:at][::-1]:                     # the scan's ancestors, nearest first
                if _depth(ln) < depth:
                    above.append(ln)
                    depth = _depth(ln)
            first = next(i for i, ln in enumerate(above) if "Exchange" in ln)
            assert any("Generate explode" in ln for ln in above[:first]), (key, above[:first])
    finally:
        _restore(spark)


def test_payments_are_scanned_once(spark, tmp_path):
    from retally.plans.reconcile import accepted_counts_for_purposes, accepted_for_purposes

    snap = write_snapshot(exam_tables_from_tpch(spark, SF), str(tmp_path / "snap"))
    pairs = [(snap[s.application_table], s.purpose) for s in REPORTS.values()]
    _no_broadcast(spark)
    try:
        for df in (accepted_for_purposes(pairs, snap["payment"]), accepted_counts_for_purposes(pairs, snap["payment"])):
            scans = [ln for ln in _scan_lines(_plan(df)) if "notes" in ln]
            assert len(scans) == 1, scans
    finally:
        _restore(spark)


def test_gates_of_all_reports_parse_the_payments_once(spark, tmp_path):
    from retally.plans.reconcile import captured_forms
    from retally.plans.runs import annual_run, semester_run

    snap = write_snapshot(exam_tables_from_tpch(spark, SF), str(tmp_path / "snap"))
    forms = captured_forms(snap)
    for run in (annual_run, semester_run):
        for done in run(snap, "01/01/1996").values():
            assert not [ln for ln in _scan_lines(_plan(done.report)) + _scan_lines(_plan(done.mismatch)) if "notes" in ln]
            assert done.gates.count() > 0
    assert captured_forms(snap) is forms


def test_a_bucketed_snapshot_is_known_as_bucketed_in_a_later_session(spark, tmp_path):
    """Read back by folder, the result side of the report join is not exchanged."""
    from retally.sources.tables import ExamTables

    names = ["result_annual", "result_annual_retotaling", "annual_scrutiny_report"]
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")
    write_snapshot(exam_tables_from_tpch(spark, SF), str(tmp_path / "snap"), names=names, buckets=8)
    again = ExamTables.from_parquet(spark, str(tmp_path / "snap"))
    _no_broadcast(spark)
    try:
        df = scrutiny_report(again, REPORTS["annual_rt"])
        lines = _plan(df).splitlines()
        at = next(i for i, ln in enumerate(lines) if "FileScan parquet" in ln and "sub1p1code" in ln and "retotaling_status" not in ln)
        above, depth = [], _depth(lines[at])
        for ln in lines[:at][::-1]:
            if _depth(ln) < depth:
                above.append(ln)
                depth = _depth(ln)
        join = next(i for i, ln in enumerate(above) if "SortMergeJoin" in ln)
        assert not any("Exchange" in ln for ln in above[:join]), above[:join]
        assert df.count() > 0
    finally:
        _restore(spark)
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def _generated_rows(df) -> int:
    """Rows that left the fan-out's Generate in an executed plan."""
    df.write.format("noop").mode("overwrite").save()
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = df.select("*")
        again.collect()
        nodes, total = [again._jdf.queryExecution().executedPlan()], 0
        while nodes:
            node = nodes.pop()
            if node.toString().splitlines()[0].lstrip("*() 0123456789").startswith("Generate explode"):
                total += node.metrics().apply("numOutputRows").value()
            nodes += [node.children().apply(k) for k in range(node.children().size())]
        return total
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_generate_yields_applied_papers_only(spark, tmp_path):
    """Rows out of the Generate are the papers applied for, not 40 (12) per form."""
    from retally.plans.report import applied_papers

    snap = write_snapshot(exam_tables_from_tpch(spark, SF), str(tmp_path / "snap"))
    for key, spec in REPORTS.items():
        df = applied_papers(snap, spec)
        assert _generated_rows(df) == df.count() > 0, key            # broadcasts: the exclusions lie below


def test_gate_lies_below_the_generate_where_it_is_small(spark, tmp_path):
    from retally.plans.report import applied_papers
    from retally.plans.runs import gate_table

    snap = write_snapshot(exam_tables_from_tpch(spark, SF), str(tmp_path / "snap"))
    spec = REPORTS["annual_rt"]
    gates = gate_table(snap, spec, "01/01/1996")
    passed = gates.where("passed")

    def ancestors_of_application_scan(df):
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        at = next(i for i, ln in enumerate(lines) if "FileScan parquet" in ln and "retotaling_status" in ln)
        above, depth = [], _depth(lines[at])
        for ln in lines[:at][::-1]:
            if _depth(ln) < depth:
                above.append(ln)
                depth = _depth(ln)
        return above

    small = ancestors_of_application_scan(applied_papers(snap, spec, passed))
    join, generate = (next(i for i, ln in enumerate(small) if word in ln) for word in ("Join [subcode", "Generate"))
    assert join < generate and not any("Exchange" in ln for ln in small[:generate])
    _no_broadcast(spark)
    try:
        large = ancestors_of_application_scan(applied_papers(snap, spec, passed))
    finally:
        _restore(spark)
    generate = next(i for i, ln in enumerate(large) if "Generate" in ln)
    assert not any("Join" in ln or "Exchange" in ln for ln in large[:generate])
