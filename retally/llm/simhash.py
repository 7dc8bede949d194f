"""SimHash near-dedup with covering locality-sensitive hashing.

Fingerprint: words of the whole text in lower case (A-Z only), k-word shingles
with repeats, XXH64 (seed 42) of each; a bit is set when over half of the
shingle hashes have it.

Search: every distinct fingerprint is laid into 2**(r+1) - 1 tables.  Bit
position i carries the label 1 + i mod (2**(r+1) - 1), a non-zero vector of
r+1 bits; table v keeps the positions whose label has odd parity with v
(Pagh, "CoveringLSH", 2016).  Any r positions leave some v with even parity on
all of them, so two fingerprints that differ in at most r bits agree in some
table: no linked pair is lost.  For r = 3 and 64 bits that is 15 tables with
keys of about 34 bits.

Links: the members of one table entry are compared with vectorised XOR and
popcount; only a spanning set of the linked pairs leaves the task (the same
components).  An entry with more than ``ENTRY`` members is cut into blocks and
every pair of blocks is a unit of its own, so no entry meets in one task and
none is capped.  Copies are collapsed before (one row per fingerprint), so a
hot group costs one row here.

Defined results: a null or blank text has fingerprint zero and is linked like
any other; repeated rows share their fingerprint and component; a null id can
not name a component and takes part with the others' smallest id (null if it
is alone); an empty table gives an empty result.  Only the named columns and
those in ``carry`` or ``row_key`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retally.llm.components import components
from retally.llm.shared import materialise

BITS = 64
ENTRY = 2048        # members compared as one unit
CHUNK = 65536       # shingles hashed at once
SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of one whole text as an unsigned 64-bit number (0 without words)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    starts, ends = starts[:len(words) - width + 1], ends[width - 1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        part = [digest(line[a:b], SEED) for a, b in zip(starts[at:at + CHUNK].tolist(), ends[at:at + CHUNK].tolist())]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, carry: list[str], text_col: str = "text", shingle: int = 3) -> DataFrame:
    """The ``carry`` columns and ``fp``: the fingerprint as a signed 64-bit number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(batch.num_columns - 1)], np.uint64)
            yield pa.record_batch([*batch.columns[:-1], pa.array(fp.view(np.int64))], names=[*carry, "fp"])

    kept = docs.select(*[F.col(c) for c in carry], F.col(text_col).alias("_text"))
    schema = kept.drop("_text").schema.add("fp", "long")
    return kept.mapInArrow(run, schema)


def masks(radius: int) -> list[int]:
    """The covering bit masks of ``BITS`` positions for a radius."""
    labels = 2 ** (radius + 1) - 1
    return [sum(1 << i for i in range(BITS) if bin((1 + i % labels) & v).count("1") % 2) for v in range(1, labels + 1)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def spanning_links(left: np.ndarray, right: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that span the same components as all pairs within ``radius`` between the two blocks.

    ``left is right`` for the pairs inside one block.  Breadth first: each
    reached fingerprint is compared with those not reached yet.
    """
    same = left is right
    values = left if same else np.concatenate([left, right])
    side = np.zeros(len(values), bool)
    if not same:
        side[len(left):] = True
    rest = np.arange(len(values))
    links: list[tuple[int, int]] = []
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(values[rest] ^ values[at]) <= radius
            if not same:
                near &= side[rest] != side[at]
            found = rest[near]
            if len(found):
                links += [(int(values[at]), int(values[f])) for f in found]
                queue += found.tolist()
                rest = rest[~near]
    return links


def _entries(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows (unit key, block, fp) to spanning links, one unit at a time."""
    key, fps, blocks = None, [], []

    def links() -> pa.RecordBatch | None:
        values = np.concatenate(fps).view(np.uint64)
        block = np.concatenate(blocks)
        first = values[block == block[0]]
        second = values[block != block[0]]
        found = spanning_links(first, first if not len(second) else second, radius)
        if not found:
            return None
        pair = np.array(found, np.uint64).view(np.int64)
        return pa.record_batch([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        unit = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("table", "key", "one", "two")])
        block, fp = batch.column("block").to_numpy(), batch.column("fp").to_numpy()
        cuts = [0, *(np.flatnonzero((unit[:, 1:] != unit[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            now = tuple(unit[:, a].tolist())
            if now != key:
                if key is not None and sum(map(len, fps)) > 1 and (out := links()) is not None:
                    yield out
                key, fps, blocks = now, [], []
            fps.append(fp[a:b])
            blocks.append(block[a:b])
    if key is not None and sum(map(len, fps)) > 1 and (out := links()) is not None:
        yield out


def similar_links(distinct_fps: DataFrame, radius: int = 3, entry: int = ENTRY) -> DataFrame:
    """Spanning links (a, b) of the pairs of distinct fingerprints at most ``radius`` bits apart."""
    tables = F.array(*[F.struct(F.lit(t).alias("table"), F.lit(_signed(m)).alias("mask")) for t, m in enumerate(masks(radius))])
    keyed = (distinct_fps.select("fp", F.explode(tables).alias("x"))
             .select(F.col("x.table").alias("table"), F.col("fp").bitwiseAND(F.col("x.mask")).alias("key"), "fp"))
    # Entries over the size of a unit: their number of blocks, known before anything is gathered.
    large = materialise(keyed.groupBy("table", "key").count().where(F.col("count") > entry)
                        .select("table", "key", F.ceil(F.col("count") / entry).cast("int").alias("n")), "simhash-large")
    cut = (keyed.join(large, ["table", "key"], "left")
           .withColumn("n", F.coalesce("n", F.lit(1)))
           .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")))
    # Block i meets block j in the unit (min, max); alone it is the unit (i, i).
    units = (cut.select("table", "key", "fp", "block", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
             .select("table", "key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
                     "block", "fp"))
    order = ["table", "key", "one", "two"]
    return (units.repartition(*order).sortWithinPartitions(*order, "block", "fp")
            .mapInArrow(lambda it: _entries(it, radius), "a long, b long"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                radius: int = 3, row_key: str | None = None) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id``.

    With ``row_key``, a column that tells rows of one id apart, also that
    column and ``first``: whether the row is its component's smallest by id
    (null last) and row key.  Rows alike in both are first together.
    """
    key = [F.col(row_key).alias("row_key")] if row_key else []
    fps = materialise(fingerprints(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"), *key),
                                   ["id", "row_key"] if row_key else ["id"], "t", shingle), "simhash-fp")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row_key") if row_key else F.col("id")
    classes = materialise(fps.groupBy("fp").agg(F.min(order).alias("least")), "simhash-classes")
    links = materialise(similar_links(classes.select("fp"), radius).distinct(), "simhash-links")
    linked = materialise(components(links), "simhash-components")
    named = linked.join(classes.withColumnRenamed("fp", "node"), "node")
    least = materialise(named.groupBy("component").agg(F.min("least").alias("chosen")), "simhash-least")
    by_fp = materialise(linked.join(least, "component").select(F.col("node").alias("fp"), "chosen")
                        .unionByName(classes.join(linked.select(F.col("node").alias("fp")), "fp", "left_anti")
                                     .select("fp", F.col("least").alias("chosen"))), "simhash-groups")
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    if not row_key:
        return fps.join(by_fp, "fp").select(F.col("id").alias(id_col), fingerprint, F.col("chosen").alias("component_id"))
    return fps.join(by_fp, "fp").select(
        F.col("id").alias(id_col), F.col("row_key").alias(row_key), fingerprint, F.col("chosen.id").alias("component_id"),
        (F.col("id").eqNullSafe(F.col("chosen.id")) & F.col("row_key").eqNullSafe(F.col("chosen.row_key"))).alias("first"))
