"""SQL IN / NOT IN semantics of the membership joins, incl. the NULL rules."""

from pyspark.sql import functions as F

from retally.operators.membership import is_in, not_in


def _keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k int")


def test_not_in_plain(spark):
    df = _keys(spark, [1, 2, 3])
    assert sorted(r.k for r in not_in(df, "k", _keys(spark, [2, 5]), "k").collect()) == [1, 3]


def test_not_in_null_in_subquery_removes_everything(spark):
    df = _keys(spark, [1, 2, 3])
    assert not_in(df, "k", _keys(spark, [2, None]), "k").count() == 0


def test_not_in_null_probe_kept_only_when_subquery_empty(spark):
    df = _keys(spark, [1, None])
    assert sorted(r.k for r in not_in(df, "k", _keys(spark, [7]), "k").collect()) == [1]
    empty = _keys(spark, []).where(F.lit(False))
    got = [r.k for r in not_in(df, "k", empty, "k").collect()]
    assert sorted(got, key=lambda v: (v is None, v)) == [1, None]


def test_not_in_matches_spark_sql(spark):
    df = _keys(spark, [1, 2, 3, None])
    for sub in ([2], [2, None], [], [None]):
        s = _keys(spark, sub)
        df.createOrReplaceTempView("p")
        s.createOrReplaceTempView("s")
        want = sorted((r.k for r in spark.sql("SELECT k FROM p WHERE k NOT IN (SELECT k FROM s)").collect()),
                      key=lambda v: (v is None, v))
        got = sorted((r.k for r in not_in(df, "k", s, "k").collect()), key=lambda v: (v is None, v))
        assert got == want, sub


def test_not_in_plan_has_no_nested_loop(spark):
    df = _keys(spark, [1, 2])
    plan = not_in(df, "k", _keys(spark, [2]), "k")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_is_in_ignores_nulls_and_duplicates(spark):
    df = _keys(spark, [1, 2, None])
    got = sorted(r.k for r in is_in(df, "k", _keys(spark, [2, 2, None]), "k").collect())
    assert got == [2]
