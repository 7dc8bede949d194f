"""Bitmaps of form numbers: exact membership, NULL rules, the reports over them."""

from hypothesis import given, settings
from hypothesis import strategies as st

from retally.operators import membership
from retally.operators.bitmaps import ROW_BYTES, bitmap_bytes, key_bitmaps
from retally.operators.membership import is_in, not_in
from retally.plans import report
from retally.plans.report import scrutiny_report
from retally.sources.derived import exam_tables_from_tpch
from retally.sources.snapshot import write_snapshot
from retally.specs import REPORTS

EDGES = [-(2**31), -32769, -32768, -32767, -9, -8, -1, 0, 1, 2, 7, 8, 9, 32767, 32768, 32769, 65536, 65537, 2**31 - 1]
KEYS = st.lists(st.one_of(st.none(), st.sampled_from(EDGES), st.integers(-(2**31), 2**31 - 1)), max_size=12)


def _keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k int")


def _order(values):
    return sorted(values, key=lambda v: (v is None, v))


def test_every_edge_and_its_neighbours(spark):
    near = sorted({v + d for v in EDGES for d in (-1, 0, 1) if -(2**31) <= v + d < 2**31})
    rows, members = _keys(spark, near), _keys(spark, EDGES + EDGES[:5])
    bits = key_bitmaps(members, "k")
    assert [r.k for r in is_in(rows, "k", members, "k", bitmaps=bits).orderBy("k").collect()] == EDGES
    assert [r.k for r in not_in(rows, "k", members, "k", bitmaps=bits).orderBy("k").collect()] == [v for v in near if v not in EDGES]


def test_a_full_bucket(spark):
    rows = spark.range(0, 70_000).selectExpr("CAST(id AS INT) AS k")
    odd = rows.where("k % 2 = 1")
    bits = key_bitmaps(odd, "k")
    assert is_in(rows, "k", odd, "k", bitmaps=bits).selectExpr("count(*)", "min(k % 2)").first()[:] == (35_000, 1)
    assert not_in(rows, "k", odd, "k", bitmaps=bits).selectExpr("count(*)", "max(k % 2)").first()[:] == (35_000, 0)
    assert bitmap_bytes(odd, "k") == bits.count() * ROW_BYTES == 3 * ROW_BYTES


@settings(max_examples=8, deadline=None)
@given(KEYS, KEYS)
def test_same_rows_as_the_joins(spark, rows, members):
    df, sub = _keys(spark, rows), _keys(spark, members)
    for rule in (is_in, not_in):
        got = rule(df, "k", sub, "k", bitmaps=key_bitmaps(sub, "k")).collect()
        assert _order(r.k for r in got) == _order(r.k for r in rule(df, "k", sub, "k").collect()), rule


def _late(monkeypatch):
    """No list of form numbers fits a broadcast by its keys, as with a very long history."""
    monkeypatch.setattr(report, "fits_broadcast", lambda df: False)


def test_reports_over_bitmaps_and_where_they_lie(spark, tmp_path, monkeypatch):
    tables = write_snapshot(exam_tables_from_tpch(spark, "/root/testdata/sf0.001"), str(tmp_path / "snap"))
    want = {key: sorted(map(str, scrutiny_report(tables, spec).collect())) for key, spec in REPORTS.items()}
    _late(monkeypatch)
    for key, spec in REPORTS.items():
        df = scrutiny_report(tables, spec)
        assert sorted(map(str, df.collect())) == want[key] != [], key
        applied = report.applied_papers(tables, spec)
        plan = applied._jdf.queryExecution().executedPlan().toString()
        above, below = plan.split("Generate", 1)
        assert "bit_bucket" not in above.split("Subquery")[0] and "bit_bucket" in below, key
        rows = below.split("Subquery")[0]
        assert "Exchange hashpartitioning" not in rows and "BroadcastHashJoin" in rows, key


def test_a_null_in_the_history_empties_the_report(spark, tmp_path, monkeypatch):
    tables = exam_tables_from_tpch(spark, "/root/testdata/sf0.001")
    history = tables["annual_scrutiny_report"]
    holed = tables.with_table("annual_scrutiny_report", history.unionByName(spark.createDataFrame([(None, "rv")], history.schema)))
    _late(monkeypatch)
    assert scrutiny_report(holed, REPORTS["annual_rv"]).count() == 0
    assert scrutiny_report(holed, REPORTS["annual_rt"]).count() > 0


def test_sparse_numbers_keep_the_join(spark, monkeypatch):
    tables = exam_tables_from_tpch(spark, "/root/testdata/sf0.001")
    sparse = spark.range(0, 100).selectExpr("CAST(id * 40000 AS INT) AS form")
    monkeypatch.setattr(report, "broadcast_limit", lambda df: 50 * ROW_BYTES)
    assert report.form_bitmaps(tables, sparse) is None
    monkeypatch.setattr(report, "broadcast_limit", lambda df: membership.broadcast_limit(df) or ROW_BYTES * 200)
    assert report.form_bitmaps(tables, sparse).count() == 100
