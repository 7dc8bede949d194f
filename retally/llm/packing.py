"""Packing documents into sequences by Karmarkar-Karp multiway differencing.

Each task packs the documents of its partition in one pass, without a shuffle:

* a document's ids (with the end id) are cut into full windows, which are
  sequences of their own, and a rest shorter than a window;
* rests gather until they fill ``BATCH`` windows.  About ``FINE_SHARE`` of
  their ids are cut into grains of ``GRAIN`` ids, longest rests first, so that
  the differences left by the long pieces can be levelled;
* the pieces are divided among ``ceil(ids / window)`` windows: every piece
  starts as a partition with one filled window, the two partitions with the
  largest imbalance are merged, the fullest window of one with the emptiest of
  the other, until one partition is left (Karmarkar and Karp, 1982, in its
  multiway form).  While the fullest window exceeds the capacity, the number
  of windows rises by one and the division is made anew;
* less than one window at a partition's end is cut at powers of two, which need
  no padding.

Memory is bounded by one batch of windows and one slice of texts.  The number
of windows a partition can waste is below one per batch.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each; a null id is carried as null; an empty table gives an empty
result.  Only the named columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from retally.llm import tokens

WINDOW = 2048
BATCH = 128
SLICE = 512          # full windows of one text handed on at once
FINE_SHARE = 0.1
GRAIN = 32


def divide(sizes: list[int], windows: int) -> list[list[int]]:
    """Multiway differencing: the piece numbers of each window, fullest window first."""
    heap, merges = [], []
    for i, s in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[0] = s
        heap.append((-s, i, sums))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heapq.heappop(heap)
        sums = left + right[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), len(sizes) + len(merges), sums))
        merges.append((a, b, order))
    # Follow every window of the last partition down to the pieces it was merged from.
    place = {heap[0][1]: np.arange(windows)}
    window_of = [0] * len(sizes)
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        final = place.pop(len(sizes) + k)
        at = np.empty(windows, np.int64)
        at[order] = final
        place[a], place[b] = at, at[::-1]
    for i in range(len(sizes)):
        window_of[i] = int(place[i][0])
    out: list[list[int]] = [[] for _ in range(windows)]
    for i, w in enumerate(window_of):
        out[w].append(i)
    return out


def pack(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """Piece numbers per window, none above ``window``."""
    count = -(-sum(sizes) // window)
    while True:
        found = divide(sizes, count)
        if max(sum(sizes[i] for i in w) for w in found) <= window:
            return found
        count += 1


Piece = tuple[int, int, int]      # row, start, length


def _grains(rests: list[Piece], window: int) -> list[Piece]:
    """Cut the longest rests into grains until these hold the fine share of all ids."""
    rests = sorted(rests, key=lambda p: -p[2])
    fine, left = FINE_SHARE * sum(p[2] for p in rests), []
    for n, (row, start, length) in enumerate(rests):
        if fine <= 0:
            return left + rests[n:]
        left += [(row, at, min(GRAIN, start + length - at)) for at in range(start, start + length, GRAIN)]
        fine -= length
    return left


def _tail(pieces: list[Piece]) -> list[list[Piece]]:
    """Less than a window of pieces as sequences whose lengths are powers of two."""
    total, out, queue = sum(p[2] for p in pieces), [], list(pieces)
    while total:
        room, sequence = 1 << (total.bit_length() - 1), []
        total -= room
        while room:
            row, start, length = queue.pop(0)
            used = min(room, length)
            sequence.append((row, start, used))
            if used < length:
                queue.insert(0, (row, start + used, length - used))
            room -= used
        out.append(sequence)
    return out


def _sequences(rests: list[Piece], window: int, last: bool) -> list[list[Piece]]:
    if sum(p[2] for p in rests) < window:
        return _tail(rests) if last else []
    pieces = _grains(rests, window)
    return [[pieces[i] for i in w] for w in pack([p[2] for p in pieces], window) if w]


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
                   window: int = WINDOW, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids`` (little-endian 32 bit), ``doc_tokens``,
    ``sequence_id`` and ``offset`` in the sequence."""
    path = tokenizer or tokens.default_path()
    out = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("start", T.LongType()),
                        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
                        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
                        T.StructField("offset", T.LongType())])
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder_of(path)
        number = TaskContext.get().partitionId() << 32
        held: dict[int, tuple[object, np.ndarray, int, int]] = {}     # row -> id, waiting ids, ids before them, all ids
        rests: list[Piece] = []
        row = waiting = 0

        def block(sequences: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal number
            columns: list[list] = [[] for _ in schema.names]
            for sequence in sequences:
                offset = 0
                for r, start, length in sequence:
                    doc, ids, before, total = held[r]
                    for column, value in zip(columns, (doc, start, length, ids[start - before:start - before + length].tobytes(),
                                                       total, number, offset)):
                        column.append(value)
                    offset += length
                number += 1
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            names = batch.column(0)
            for at, ids in tokens.encoded(batch.column(1), encoder, end_id):
                doc, full = names[at].as_py(), len(ids) - len(ids) % window
                for a in range(0, full, SLICE * window):       # the windows of a long text go out some at a time
                    upto = min(full, a + SLICE * window)
                    held[row] = (doc, ids[a:upto], a, len(ids))
                    yield block([[(row, b, window)] for b in range(a, upto, window)])
                held.pop(row, None)
                if full < len(ids):
                    held[row] = (doc, ids[full:].copy(), full, len(ids))        # not a view, which would keep the whole text's ids
                    rests.append((row, full, len(ids) - full))
                    waiting += len(ids) - full
                row += 1
                if waiting >= BATCH * window - window // 2:
                    yield block(_sequences(rests, window, False))
                    rests, waiting = [], 0
                    held.clear()
        if rests:
            yield block(_sequences(rests, window, True))

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, out)


def sequence_rows(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``ids`` (pieces joined by offset), ``length``, ``padded_length``.

    A sequence holds at most ``window`` ids, so its pieces are a bounded group.
    """
    whole = pieces.groupBy("sequence_id").agg(
        F.expr("concat_ws('', transform(array_sort(collect_list(struct(offset, hex(ids) AS h))), x -> x.h))").alias("h"),
        F.sum("length").alias("length"))
    power = F.expr("bit_count(length) = 1")
    return whole.select("sequence_id", F.unhex("h").alias("ids"), "length",
                        F.when(power, F.col("length")).otherwise(F.lit(window).cast("long")).alias("padded_length"))
