"""Scratch tables in the shared folder, and words as every operator reads them."""

import os

from pyspark.sql import functions as F

from retally.llm import shared
from retally.llm.shared import bucketed, materialise, parts_for, release, words_of


def _exists(path):
    return os.path.exists(path.removeprefix("file:").replace("//", "/"))


def test_release_removes_what_operators_wrote(spark):
    table = materialise(spark.range(3).toDF("a"), "test")
    path = shared._WRITTEN[-1][1]
    assert table.count() == 3 and _exists(path)
    kept = bucketed(spark.range(10).toDF("b"), "b", 4, "test")
    name = shared._TABLES[-1][1]
    assert kept.count() == 10 and spark.catalog.tableExists(name)
    release()
    assert not _exists(path) and not spark.catalog.tableExists(name) and not shared._WRITTEN


def test_words(spark):
    rows = [(" a\tb\n\x0bc\x0c\r d ",), ("",), (None,), ("é\u00a0x",)]
    got = [r.w for r in spark.createDataFrame(rows, "t string").select(words_of(F.col("t")).alias("w")).collect()]
    assert got == [["a", "b", "c", "d"], [], [], ["é\u00a0x"]]


def test_parts_grow_with_the_text(spark):
    few = spark.createDataFrame([("a",)], "text string")
    many = spark.range(40).select(F.repeat(F.lit("x"), 1_000_000).alias("text"))
    assert parts_for(few, target_bytes=100_000) < parts_for(many, target_bytes=100_000) == 400


def test_partitions_are_bounded_at_any_size():
    from retally.llm.shared import MAX_PARTS, part_count

    assert part_count(0, 8) == 8 and part_count(10**9, 8) == 60
    for size in (10**12, 2 * 10**12, 10**14, 10**16):                 # 1 TB to 10 PB
        assert part_count(size, 6000) <= MAX_PARTS < 100_000


def test_plans_for_100_terabytes_stay_within_what_spark_accepts():
    from retally.llm.shared import part_count
    from retally.llm.substring import _Plan

    plan = _Plan(10**14)
    assert part_count(10**14, 6000) < 100_000                          # buckets of the stored batches
    assert plan.batch_bytes < 2**28 and plan.ranges < 10**6
