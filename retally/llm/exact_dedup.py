"""Exact dedup by content sort.

1. Text is normalised by deleting ASCII white space.  A range repartition on
   (first characters, SHA-256, length of the original text descending, id)
   with sampled splitters lays all rows out in one global order.  The key is
   bounded, so the sample the driver keeps does not grow with text length, and
   it ends in the id, so a group of copies of any size is cut between
   partitions wherever its share is large: no group meets in one task.
2. Spark's external sort orders every partition by the same key.
3. One pass over each sorted partition compares neighbouring rows' whole
   normalised texts (vectorised, batch by batch).  A run of equal texts starts
   with the row that stays: the longest original, then the smallest id.
4. Only a partition's first and last run can continue in a neighbour.  Those
   two runs per partition are kept apart with their text, compared in full
   with the next partition's first, and chained; the corrected keeper and size
   go back to the rows of these runs by a join on (partition, run).

Defined results: a null text is an empty one; equal texts with one id (repeated
rows) are separate rows of one group and one of them stays; a null id sorts
last; an empty table gives an empty result.  Only the named columns and those
in ``carry`` are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from retally.llm.shared import materialise, parts_for, without_white

PREFIX_CHARS = 24      # length of the text prefix in the sort key


def _ordered(docs: DataFrame, id_col: str, text_col: str, carry: list[str], parts: int | None) -> DataFrame:
    """Rows in content order.  Where the carried row holds the text, the normalised text is made
    from it again after the shuffle, so that every text travels once."""
    carried = text_col in carry
    text = F.col(f"`{text_col}`")
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.char_length(F.coalesce(text, F.lit(""))).alias("chars"),
        without_white(text).alias("norm"),
    )
    keyed = keyed.select(
        "row", "id", "chars", F.substring("norm", 1, PREFIX_CHARS).alias("prefix"),
        F.unhex(F.sha2(F.encode("norm", "UTF-8"), 256)).alias("sha"), *([] if carried else ["norm"]))
    key = [F.col("prefix"), F.col("sha"), F.col("chars").desc(), F.col("id").asc_nulls_last()]
    ordered = keyed.repartitionByRange(parts or parts_for(docs, text_col), *key).sortWithinPartitions(*key)
    return ordered.select("row", "id", "sha", without_white(F.col("row").getField(text_col)).alias("norm") if carried else "norm")


def _compare(batches: Iterator[pa.RecordBatch], schema: pa.Schema, only_first: bool) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal neighbours in one sorted partition.

    Yields a row per input row (or per run, with ``only_first``: then at once,
    its size unknown) and two edge rows: the partition's first run (edge 1)
    and last run (edge 2).  Held back until the partition ends are ids and
    digests only, never the texts.
    """
    pid = TaskContext.get().partitionId()
    run, last_text, head_text = -1, None, None
    runs, ids, digests, rows = [], [], [], []
    keeps: list[int | None] = []
    sizes: list[int] = []

    def block(n, edge, run, first, row, sha, keep, size, text=None):
        return pa.record_batch([pa.array(np.full(n, pid, np.int32)), pa.array(np.full(n, edge, np.int32)),
                                pa.array(run, pa.int64()), pa.array(first, pa.bool_()), row, sha,
                                pa.array(keep, pa.int64()), pa.array(size, pa.int64()),
                                pa.array([text] * n, pa.string())], schema=schema)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        norm, row = batch.column("norm"), batch.column("row").cast(schema.field("row").type)
        starts = np.ones(n, dtype=bool)
        starts[0] = last_text is None or norm[0].as_py() != last_text
        if n > 1:
            starts[1:] = pc.not_equal(norm.slice(1), norm.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        number = run + np.cumsum(starts)
        if head_text is None:
            head_text = norm[0].as_py()
        keeps += batch.column("id").filter(pa.array(starts)).to_pylist()
        sizes += [0] * (len(keeps) - len(sizes))
        for r, c in zip(*np.unique(number, return_counts=True)):
            sizes[r] += int(c)
        if only_first:
            got = pa.array(starts)
            m = int(starts.sum())
            if m:
                yield block(m, 0, number[starts], [True] * m, row.filter(got), batch.column("sha").filter(got),
                            [None] * m, [None] * m)
        else:
            runs.append(number), ids.append(starts), digests.append(batch.column("sha")), rows.append(row)
        run, last_text = int(number[-1]), norm[n - 1].as_py()
    if run < 0:
        return
    if not only_first:
        keep_of, size_of = np.array([-1 if k is None else k for k in keeps]), np.array(sizes)
        none = np.array([k is None for k in keeps])
        for number, first, sha, row in zip(runs, ids, digests, rows):
            yield block(len(number), 0, number, first, row, sha,
                        pa.array(keep_of[number], mask=none[number]), size_of[number])
    void = pa.nulls(1, schema.field("row").type)
    for edge, r, text in ((1, 0, head_text), (2, run, last_text)):
        yield block(1, edge, [r], [False], void, pa.nulls(1, schema.field("sha").type), [keeps[r]], [sizes[r]], text)


def _passed(docs: DataFrame, id_col: str, text_col: str, carry: list[str], only_first: bool, parts: int | None) -> DataFrame:
    ordered = _ordered(docs, id_col, text_col, carry, parts)
    out = T.StructType([
        T.StructField("pid", T.IntegerType()), T.StructField("edge", T.IntegerType()),
        T.StructField("run", T.LongType()), T.StructField("first", T.BooleanType()),
        T.StructField("row", ordered.schema["row"].dataType), T.StructField("sha", T.BinaryType()),
        T.StructField("keep", T.LongType()), T.StructField("size", T.LongType()),
        T.StructField("text", T.StringType())])
    arrow = to_arrow_schema(out)
    return materialise(ordered.mapInArrow(lambda it: _compare(it, arrow, only_first), out), "content-sort")


def _continued(passed: DataFrame) -> DataFrame:
    """Runs that cross partitions: (pid, run) -> keeper and size of the whole group, and whether it starts there.

    At most two rows per partition, so bounded by the number of partitions.
    The texts at the borders are compared in full, each pair in its own row;
    only flags and counts are put in order afterwards.
    """
    edges = passed.where("edge > 0")
    thin = (edges.groupBy("pid").agg(F.max("run").alias("last"))
            .withColumn("before", F.lag("pid").over(Window.orderBy("pid"))))
    tails = edges.where("edge = 2").select(F.col("pid").alias("before"), F.col("text").alias("tail_text"))
    heads = edges.where("edge = 1").select("pid", "text").join(thin, "pid").join(tails, "before")
    joined = heads.where(F.col("text") == F.col("tail_text")).select("pid", F.lit(True).alias("goes_on"))
    parts = (edges.dropDuplicates(["pid", "run"]).select("pid", "run", "keep", "size")
             .join(joined, "pid", "left")
             .withColumn("starts", (F.col("run") > 0) | F.col("goes_on").isNull()))
    order = Window.orderBy("pid", "run")
    chained = parts.withColumn("chain", F.sum(F.col("starts").cast("int")).over(order))
    whole = chained.groupBy("chain").agg(F.min_by("keep", F.struct("pid", "run")).alias("all_keep"),
                                         F.sum("size").alias("all_size"), F.count("*").alias("n"))
    return (chained.join(whole.where("n > 1"), "chain")
            .select("pid", "run", "all_keep", "all_size", F.col("starts").alias("is_start"), F.lit(True).alias("crosses")))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
                 parts: int | None = None) -> DataFrame:
    """Every row with its group of equal texts.

    Returns the ``carry`` columns (default: the id), ``keep_id``, ``group_size``,
    ``kept`` and ``text_sha256`` (lowercase hex of the normalised text).
    """
    carry = carry or [id_col]
    passed = _passed(docs, id_col, text_col, carry, False, parts)
    cross = materialise(_continued(passed), "exact-cross")       # two rows per partition at most; the planner sees its size
    rows = passed.where("edge = 0").join(cross, ["pid", "run"], "left")
    return rows.select(
        *[F.col("row").getField(c).alias(c) for c in carry],
        F.when(F.col("crosses"), F.col("all_keep")).otherwise(F.col("keep")).alias("keep_id"),
        F.when(F.col("crosses"), F.col("all_size")).otherwise(F.col("size")).alias("group_size"),
        (F.col("first") & F.coalesce("is_start", F.lit(True))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """The rows that stay, with all columns of ``docs``: one per group of equal texts."""
    passed = _passed(docs, id_col, text_col, docs.columns, True, parts)
    cross = materialise(_continued(passed).where(~F.col("is_start")).select("pid", "run"), "exact-cross")
    return (passed.where("edge = 0").join(cross, ["pid", "run"], "left_anti")
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
