"""The fan-out operator on its own: applied slots only, NULL keep = not applied, CASE lookup."""

from pyspark.sql import functions as F

from retally.operators.fanout import explode_applied, q, slot_case
from retally.specs import Slot

SLOTS = (Slot(0, 1, 1), Slot(1, 1, 2), Slot(2, 2, 1))


def test_explode_applied_and_slot_case(spark):
    df = spark.createDataFrame(
        [(1, "a", None, "c", 10, 20, 30), (2, None, None, None, 1, 2, 3), (3, None, "b", "b", 7, 8, 9)],
        "id int, sub1p1 string, sub1p2 string, sub2p1 string, m0 int, m1 int, m2 int")
    marks = {0: "m0", 1: "m1", 2: "m2"}
    long = explode_applied(df, SLOTS, lambda s: f"{q(s.name)} IS NOT NULL", {"marks": lambda s: marks[s.index]},
                           keep_columns=["id"], slot_column="_slot")
    got = sorted((r.id, r._slot, r.marks) for r in long.collect())
    assert got == [(1, 0, 10), (1, 2, 30), (3, 1, 8), (3, 2, 9)]          # id 2 applies for nothing
    named = long.join(df.select(F.col("id").alias("rid"), *[s.name for s in SLOTS]), F.col("id") == F.col("rid"))
    names = sorted((r.id, r.p) for r in named.select("id", slot_case(SLOTS, "_slot", lambda s: q(s.name))
                                                     .alias("p")).collect())
    assert names == [(1, "a"), (1, "c"), (3, "b"), (3, "b")]


def test_null_keep_is_not_applied(spark):
    df = spark.createDataFrame([(1, None, "x", "true")], "id int, sub1p1 string, sub1p2 string, f string")
    long = explode_applied(df, SLOTS[:2], lambda s: f"{q(s.name)} = 'x'", {}, keep_columns=["id"])
    assert [r.slot for r in long.collect()] == [1]
