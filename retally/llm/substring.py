"""Substring dedup with fixed-block anchors.

A repeat of ``WINDOW`` words holds a whole block of ``BLOCK`` words of the text
it repeats, when blocks lie back to back from each document's first word and
``WINDOW >= 2 * BLOCK - 1``.  So:

1. Documents are range-partitioned by id and written in order as batches of a
   few MB (one row each, words joined by one space, compressed), bucketed by
   batch, so later passes read them without another shuffle of texts.
2. Anchors: every batch sends the hashes of all its rolling BLOCK-word windows,
   each distinct hash once, flagged where it starts a reference block, sorted
   and delta coded by hash range.  A range is read by one task, which reports
   back the windows that meet a reference block elsewhere.
3. Extension: around every hit a batch forms the WINDOW-word windows that hold
   it (the hit extended by up to ``WINDOW - BLOCK`` words to either side) and
   sends their 128-bit hashes the same way.  Batches are numbered in document
   order, so the first batch of a hash holds its first occurrence, and the
   others hear that theirs is a repeat.
4. Each batch marks the words covered by repeated windows; runs of covered
   words are the maximal repeats (``spans``).

A hash that many windows share costs one entry per batch, however often it
comes, so frequent words, lines and passages do not gather anywhere.  Sizes:
a batch and a hash range grow with the square root of the corpus once it
passes some billions of words, which keeps their product, the number of
shuffled pieces, in proportion to the corpus.

Equality of two windows rests on 128 bits: two rolling polynomials with
different multipliers over the XXH3 hashes of their words.  The chance that any
two different windows of a corpus of 10**13 words agree by accident is about
10**-13.  The shorter anchor hashes only select.

Defined results: a null or blank text has no words and nothing removed; a null
id sorts last; rows that repeat an id are separate documents in the order of a
text hash; an empty table gives an empty result.  Only the named columns are
read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retally.llm.shared import bucketed, materialise, parts_for, text_bytes

WINDOW, BLOCK = 20, 10
BATCH_BYTES = 4 * 1024 * 1024
RANGE_WORDS = 1_000_000        # distinct windows a hash range holds, about
PIECE_WORDS = 64               # and at least so many per batch and range
SPARE_BITS = 13                # anchor hashes: bits beyond those that number the corpus's words
MULTIPLIER, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def rolling(words: np.ndarray, width: int, multiplier: np.uint64 = MULTIPLIER) -> np.ndarray:
    """Polynomial hash of every ``width`` consecutive word hashes (modulo 2**64)."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    total, done, at = None, 0, words
    span, left = 1, width                     # ``at`` hashes ``span`` words

    def power(n: int) -> np.uint64:
        return np.uint64(pow(int(multiplier), n, 1 << 64))

    while left:
        if left & 1:
            part = at[done:] * power(done) if done else at
            total = part if total is None else total[:len(part)] + part
            done += span
        left >>= 1
        if left:
            at = at[:-span] + at[span:] * power(span)
            span *= 2
    return total[:len(words) - width + 1]


class Batch:
    """Words of one stored batch and their window hashes."""

    def __init__(self, payload: bytes):
        raw = zstandard.ZstdDecompressor().decompress(payload)
        self.texts = raw.split(b"\n")[:-1]
        self.words = raw.split()
        self.counts = np.array([t.count(b" ") + 1 if t else 0 for t in self.texts], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.counts)))
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        self.left = np.repeat(self.starts[1:], self.counts) - np.arange(len(self.words))   # words up to the text's end

    def positions(self, width: int) -> np.ndarray:
        return np.flatnonzero(self.left >= width)

    def blocks(self, at: np.ndarray) -> np.ndarray:
        first = np.repeat(self.starts[:-1], self.counts)
        return (at - first[at]) % BLOCK == 0

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of all BLOCK-word windows."""
        at = self.positions(BLOCK)
        return at, _mixed(rolling(self.hashes, BLOCK)[at])

    def candidates(self, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and both hashes of the WINDOW-word windows that hold a hit."""
        at = self.positions(WINDOW)
        upto = np.concatenate(([0], np.cumsum(hit)))
        at = at[upto[at + WINDOW - BLOCK + 1] > upto[at]]
        if not len(at):
            return at, np.empty(0, np.uint64), np.empty(0, np.uint64)
        return at, _mixed(rolling(self.hashes, WINDOW)[at]), rolling(self.hashes, WINDOW, SECOND)[at]


def _distinct(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, where each comes first, and which pair each row is."""
    order = np.lexsort((two, one))                 # stable: equal pairs stay in text order
    one, two = one[order], two[order]
    starts = np.ones(len(one), bool)
    starts[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    which = np.empty(len(one), np.int64)
    which[order] = np.cumsum(starts) - 1
    return one[starts], two[starts], order[starts], which


def _ranges(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Bounds of the hash ranges in sorted distinct hashes."""
    number = ((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return np.searchsorted(number, np.arange(ranges + 1, dtype=np.uint64))


def _packed(values: np.ndarray, check: np.ndarray | None, *flags: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte plane by byte plane, their check numbers as they are, and bit flags."""
    gaps = np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(
        len(values).to_bytes(8, "little") + gaps.tobytes() + (b"" if check is None else check.tobytes())
        + b"".join(np.packbits(f).tobytes() for f in flags))


def _unpacked(data: bytes, checked: bool, flags: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(raw, np.uint8, 8 * n, 8).reshape(8, n)
    values, at = np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel()), 8 + 8 * n
    check = np.frombuffer(raw, np.uint64, n, at) if checked else np.zeros(n, np.uint64)
    at += 8 * n * checked
    bits = np.frombuffer(raw, np.uint8, -1, at).reshape(flags, -1) if n and flags else np.zeros((flags, 0), np.uint8)
    return values, check, [np.unpackbits(b, count=n).astype(bool) for b in bits]


PIECES = pa.schema([("range", pa.int64()), ("batch", pa.int64()), ("data", pa.binary())])


def _pieces(batch: int, hashes: np.ndarray, ranges: int, drop_bits: int, check: np.ndarray | None, *flags: np.ndarray) -> pa.Table:
    bounds = _ranges(hashes, ranges)
    kept = [(r, int(a), int(b)) for r, (a, b) in enumerate(zip(bounds, bounds[1:])) if b > a]
    values = hashes >> np.uint64(drop_bits)
    return pa.table([pa.array([r for r, _, _ in kept], pa.int64()), pa.array([batch] * len(kept), pa.int64()),
                     pa.array([_packed(values[a:b], None if check is None else check[a:b], *[f[a:b] for f in flags])
                               for _, a, b in kept], pa.binary())], schema=PIECES)


def _per_range(rows: Iterator[pa.RecordBatch], checked: bool, flags: int, decide) -> Iterator[pa.RecordBatch]:
    """Read each hash range whole and report ``decide``'s bits back to its batches."""
    def answer(found: list[tuple[int, bytes]], number: int) -> pa.RecordBatch:
        opened = [_unpacked(data, checked, flags) for _, data in found]
        values, checks = (np.concatenate([o[k] for o in opened]) for k in (0, 1))
        order = np.lexsort((checks, values)) if checked else np.argsort(values, kind="stable")
        one, two = values[order], checks[order]
        starts = np.ones(len(values), bool)
        starts[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        bits = np.empty(len(values), bool)
        bits[order] = decide(starts, [np.concatenate([o[2][k] for o in opened])[order] for k in range(flags)])
        ends = np.cumsum([len(o[0]) for o in opened])
        told = [(b, bits[e - len(o[0]):e]) for (b, _), o, e in zip(found, opened, ends)]
        told = [(b, np.packbits(x).tobytes()) for b, x in told if x.any()]
        return pa.record_batch([pa.array([number] * len(told), pa.int64()), pa.array([b for b, _ in told], pa.int64()),
                                pa.array([x for _, x in told], pa.binary())], schema=PIECES)

    now, found = None, []
    for batch in rows:
        for number, source, data in zip(*[batch.column(c).to_pylist() for c in ("range", "batch", "data")]):
            if number != now:
                if found:
                    yield answer(found, now)
                now, found = number, []
            found.append((source, data))
    if found:
        yield answer(found, now)


def _meets_block(starts: np.ndarray, flags: list[np.ndarray]) -> np.ndarray:
    """Windows that occur more than once, at least once at a reference block."""
    block, several = flags
    group, first = np.cumsum(starts) - 1, np.flatnonzero(starts)
    anchored = np.logical_or.reduceat(block, first)
    often = np.logical_or.reduceat(several, first) | (np.diff(np.append(first, len(starts))) > 1)
    return (anchored & often)[group]


def _not_first(starts: np.ndarray, flags: list[np.ndarray]) -> np.ndarray:
    return ~starts


def _told(answers: pa.Table, round_: int, bounds: np.ndarray) -> np.ndarray:
    """Bits of one round for the sorted distinct hashes of a batch."""
    bits = np.zeros(int(bounds[-1]), bool)
    for kind, number, data in zip(*[answers.column(c).to_pylist() for c in ("round", "range", "data")]):
        if kind == round_:
            a, b = int(bounds[number]), int(bounds[number + 1])
            bits[a:b] = np.unpackbits(np.frombuffer(data, np.uint8), count=b - a)
    return bits


class _Plan:
    """Sizes for a corpus of so many bytes."""

    def __init__(self, size: int):
        words = max(1, size // 5)
        even = math.isqrt(PIECE_WORDS * words)
        self.batch_bytes = max(BATCH_BYTES, 6 * even)
        self.ranges = max(1, -(-words // max(RANGE_WORDS, even)))
        self.drop_bits = 64 - min(64, max(40, words.bit_length() + SPARE_BITS))


def _stored(docs: DataFrame, id_col: str, text_col: str, plan: _Plan, parts: int) -> DataFrame:
    """Batches in document order: (batch, ids, texts)."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0

        def block() -> pa.RecordBatch:
            payload = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            return pa.record_batch([pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                                    pa.array([payload], pa.binary())], names=["batch", "ids", "payload"])

        for batch in rows:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                line = b" ".join((text or b"").split()) + b"\n"
                if size and size + len(line) > plan.batch_bytes:
                    yield block()
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(doc)
                texts.append(line)
                size += len(line)
        if ids:
            yield block()

    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
               .repartitionByRange(parts, F.col("id").asc_nulls_last(), F.xxhash64("text"))     # null or repeated ids spread
               .sortWithinPartitions(F.col("id").asc_nulls_last(), F.xxhash64("text")))
    return ordered.mapInArrow(run, "batch long, ids array<long>, payload binary")


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False,
                   parts: int | None = None) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed``, ``kept_sha256``, ``spans`` (start, length of every
    maximal run of removed words) and, with ``with_text``, ``kept_text``."""
    plan = _Plan(text_bytes(docs, text_col))
    parts = parts or parts_for(docs, text_col)
    batches = bucketed(_stored(docs, id_col, text_col, plan, parts), "batch", parts, "substring-batches")

    def send_anchors(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows:
            for number, payload in zip(row.column(0).to_pylist(), row.column(1)):
                batch = Batch(payload.as_py())
                at, hashes = batch.anchors()
                if not len(at):
                    continue
                distinct, where, count = np.unique(hashes, return_inverse=True, return_counts=True)
                block = np.zeros(len(distinct), bool)
                block[where[batch.blocks(at)]] = True
                yield from _pieces(number, distinct, plan.ranges, plan.drop_bits, None, block, count > 1).to_batches()

    def asked(pieces: DataFrame, checked: bool, flags: int, decide, round_: int) -> DataFrame:
        schema = "range long, batch long, data binary"
        sent = pieces.repartition("range").sortWithinPartitions("range", "batch")
        return sent.mapInArrow(lambda rows: _per_range(rows, checked, flags, decide), schema).withColumn("round", F.lit(round_))

    def hits(batch: Batch, answers: pa.Table) -> np.ndarray:
        at, hashes = batch.anchors()
        distinct, where = np.unique(hashes, return_inverse=True)
        hit = np.zeros(len(batch.words), bool)
        hit[at] = _told(answers, 1, _ranges(distinct, plan.ranges))[where]
        return hit

    def send_candidates(left: pa.Table, answers: pa.Table) -> pa.Table:
        if not left.num_rows or not answers.num_rows:
            return PIECES.empty_table()
        batch = Batch(left.column("payload")[0].as_py())
        _, one, two = batch.candidates(hits(batch, answers))
        one, two, _, _ = _distinct(one, two)
        return _pieces(left.column("batch")[0].as_py(), one, plan.ranges, 0, two)

    result = pa.schema([(id_col, pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))]
                       + ([("kept_text", pa.string())] if with_text else []))

    def remove(left: pa.Table, answers: pa.Table) -> pa.Table:
        if not left.num_rows:
            return result.empty_table()
        batch = Batch(left.column("payload")[0].as_py())
        change = np.zeros(len(batch.words) + 1, np.int32)
        if answers.num_rows:
            at, one, two = batch.candidates(hits(batch, answers))
            distinct, _, first, where = _distinct(one, two)
            repeat = _told(answers, 2, _ranges(distinct, plan.ranges))[where] | (np.arange(len(at)) != first[where])
            np.add.at(change, at[repeat], 1)
            np.add.at(change, at[repeat] + WINDOW, -1)
        gone = np.cumsum(change[:-1]) > 0
        before = np.concatenate(([0], np.cumsum(gone)))
        removed = before[batch.starts[1:]] - before[batch.starts[:-1]]
        digests, spans, texts = [], [], []
        for k, text in enumerate(batch.texts):
            runs = []
            if removed[k]:
                a, b = int(batch.starts[k]), int(batch.starts[k + 1])
                text = b" ".join(compress(batch.words[a:b], (~gone[a:b]).tolist()))
                edges = np.flatnonzero(np.diff(np.concatenate(([False], gone[a:b], [False]))))
                runs = [{"start": int(x), "length": int(y - x)} for x, y in zip(edges[::2], edges[1::2])]
            digests.append(hashlib.sha256(text).hexdigest())
            spans.append(runs)
            if with_text:
                texts.append(text.decode("utf-8", "replace"))
        columns = [left.column("ids")[0].as_py(), batch.counts, removed, digests, spans] + ([texts] if with_text else [])
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, result)], schema=result)

    anchors = batches.select("batch", "payload").mapInArrow(send_anchors, "range long, batch long, data binary")
    first = materialise(asked(anchors, False, 2, _meets_block, 1), "substring-hits")
    candidates = (batches.select("batch", "payload").groupBy("batch").cogroup(first.groupBy("batch"))
                  .applyInArrow(send_candidates, "range long, batch long, data binary"))
    second = materialise(asked(candidates, True, 0, _not_first, 2), "substring-repeats")
    spans_type = "array<struct<start:long,length:long>>"
    schema = f"`{id_col}` long, n_words long, n_removed long, kept_sha256 string, spans {spans_type}"
    return (batches.groupBy("batch").cogroup(first.unionByName(second).groupBy("batch"))
            .applyInArrow(remove, schema + (", kept_text string" if with_text else "")))
