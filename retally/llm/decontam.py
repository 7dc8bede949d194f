"""Benchmark decontamination over a distributed positional inverted index.

Words are runs of ASCII digits, letters (A-Z in lower case) and all characters
beyond ASCII; everything else parts them.

1. ``build_index``: every task turns its documents into shards of about
   ``SHARD_BYTES`` of text.  A shard is one row: the documents (or pieces of
   very long ones), the distinct terms, the number of postings of each term
   and all postings, term by term, as compressed gaps between positions.  Every
   word of every document is posted.  Building needs no shuffle, and a frequent
   word is spread over all shards, so no key is hot.
2. Search: the items are cut into windows of ``window`` consecutive words (an
   item with fewer words is one window).  Items travel to the shards in blocks
   of at most ``BLOCK_BYTES``; further blocks are further passes over the
   index, so nothing that is broadcast grows with the item table.
3. In a shard, windows with a term that the shard does not hold are out.  For
   the others the terms are ordered by their number of postings there.  The
   list of the rarest term gives the candidate starts (its positions less its
   offset in the window), and the offset-adjusted lists of the next terms are
   intersected one after the other by binary search.
4. ``phrase_matches`` returns every exact occurrence, ``proximity_matches``
   every shortest span of at most ``within`` words that holds all words of a
   window in any order, and ``contamination`` sums the phrase matches up per
   document.

A text longer than a shard is cut into segments that overlap by ``reach``
words on both sides.  Each word is owned by one segment, which sees every
window of up to ``reach + 1`` words around it.

Defined results: a null, empty or blank text has no words, is indexed and
matches nothing; the same holds for an item, which then has no window.  Rows
that repeat an id are documents of their own; a null document id is returned
as null.  Items are named by their id as a string (null: empty string); rows
that share an id are one item, repeated rows change nothing.  Empty tables give
empty results, and documents without any item give rows without hits.  Only the
named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from retally.llm.shared import materialise

WINDOW = 10
REACH = 63                       # longest match in a cut text: REACH + 1 words
SHARD_BYTES = 4 * 1024 * 1024
BLOCK_BYTES = 4 * 1024 * 1024    # item text searched in one pass
PIECE_WORDS = 2048               # a long item is handed over in pieces of so many words
CANDIDATES = 2_000_000           # candidate starts held at once in a task

_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TABLE = bytes(b if b in _WORD_BYTES else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of_bytes(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TABLE).split()


# ---------------------------------------------------------------- index

def _segments(text: bytes | None, reach: int) -> Iterator[tuple[int, list[bytes], int]]:
    """(words before the owned ones, all words, words owned) of each segment of a text; one for most texts."""
    text = text or b""
    words, lead, at = [], 0, 0
    if len(text) > SHARD_BYTES:
        text = text.translate(_TABLE)
        while len(text) - at > SHARD_BYTES and (cut := text.find(b" ", at + SHARD_BYTES)) >= 0:
            words += text[at:cut].split()
            at = cut
            owned = len(words) - lead - reach
            if owned > 0:
                yield lead, words, owned
                upto = lead + owned
                lead = min(reach, upto)
                words = words[upto - lead:]
    words += words_of_bytes(text[at:] if at else text)
    yield lead, words, len(words) - lead


def _compressed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, byte plane by byte plane."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _decompressed(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    planes = np.frombuffer(raw, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


INDEX_SCHEMA = ("shard long, rows array<long>, ids array<{id}>, starts array<long>, leads array<long>, owned array<long>, "
                "total array<long>, terms binary, counts binary, postings binary")


class _ShardWriter:
    """Gathers segments of consecutive documents and packs them as one row."""

    def __init__(self, number: int, id_type: pa.DataType):
        self.number, self.id_type = number, id_type
        self.clear()

    def clear(self) -> None:
        self.words, self.size = [], 0
        self.rows, self.ids, self.starts, self.leads, self.owned, self.total = [], [], [], [], [], []

    def add(self, row: int, doc, start: int, lead: int, words: list[bytes], owned: int) -> None:
        for column, value in zip((self.rows, self.ids, self.starts, self.leads, self.owned, self.total),
                                 (row, doc, start, lead, owned, len(words))):
            column.append(value)
        self.words += words

    def pack(self) -> pa.RecordBatch:
        coded = pa.array(self.words, pa.binary()).dictionary_encode()
        codes = coded.indices.to_numpy()
        order = np.argsort(codes, kind="stable")                    # positions, term by term
        counts = np.bincount(codes, minlength=len(coded.dictionary))
        gaps = np.diff(order, prepend=0)
        firsts = (np.cumsum(counts) - counts)[counts > 0]
        gaps[firsts] = order[firsts]
        terms = zstandard.ZstdCompressor(level=1).compress(b" ".join(coded.dictionary.to_pylist()))
        arrays = [pa.array([self.number], pa.int64()), pa.array([self.rows], pa.list_(pa.int64())),
                  pa.array([self.ids], pa.list_(self.id_type)),
                  *[pa.array([c], pa.list_(pa.int64())) for c in (self.starts, self.leads, self.owned, self.total)],
                  *[pa.array([b], pa.binary()) for b in (terms, _compressed(counts), _compressed(gaps))]]
        self.number += 1
        self.clear()
        return pa.record_batch(arrays, names=["shard", "rows", "ids", "starts", "leads", "owned", "total", "terms", "counts", "postings"])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """The index of ``docs``: one row per shard, stored in the shared folder.

    A document is known by ``row`` (unique, of no meaning) beside its id.
    """
    kind = docs.schema[id_col].dataType
    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        row, shard = base, _ShardWriter(base, id_type)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for doc, text in zip(batch.column(0).to_pylist(), texts):
                text, start = text.as_py(), 0
                for lead, words, owned in _segments(text, reach):
                    shard.add(row, doc, start, lead, words, owned)
                    shard.size += sum(map(len, words)) if len(text or b"") > SHARD_BYTES else len(text or b"")
                    start += owned
                    if shard.size >= SHARD_BYTES:
                        yield shard.pack()
                row += 1
                if len(shard.rows) >= 65536:             # short or empty texts
                    yield shard.pack()
        if shard.rows:
            yield shard.pack()

    schema = INDEX_SCHEMA.format(id=kind.simpleString())
    return materialise(docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema), "postings")


class _Shard:
    """One index row, opened."""

    def __init__(self, row: dict):
        self.terms = pa.array(zstandard.ZstdDecompressor().decompress(row["terms"]).split(b" "), pa.binary())
        self.rows, self.ids = row["rows"], row["ids"]
        self.starts, self.leads, self.owned, total = (np.array(row[c], np.int64) for c in ("starts", "leads", "owned", "total"))
        self.ends = np.cumsum(total)
        self.begins = self.ends - total
        self.n = int(self.ends[-1])
        counts = _decompressed(row["counts"])
        self.counts = np.append(counts, np.zeros(max(0, len(self.terms) - len(counts)), np.int64))
        self.firsts = np.cumsum(self.counts) - self.counts
        gaps = _decompressed(row["postings"])
        sums = np.cumsum(gaps)
        before = np.concatenate(([0], sums))[self.firsts]             # of the gaps of earlier terms
        self.positions = sums - np.repeat(before, self.counts)
        self.keys = np.repeat(np.arange(len(self.counts)), self.counts) * self.n + self.positions   # ascending

    def numbers(self, terms: pa.Array) -> np.ndarray:
        """Number of each term here, -1 where the shard does not hold it."""
        if not self.n:
            return np.full(len(terms), -1, np.int64)
        return pc.fill_null(pc.index_in(terms, value_set=self.terms), -1).to_numpy().astype(np.int64)

    def holds(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether the list of a term has a position."""
        wanted = term * self.n + position
        at = np.searchsorted(self.keys, wanted)
        return (self.keys[np.minimum(at, len(self.keys) - 1)] == wanted) & (position >= 0) & (position < self.n)

    def segment(self, position: np.ndarray) -> np.ndarray:
        # empty segments share their begin with the next one; the last such holds the position
        return np.searchsorted(self.begins, position, "right") - 1

    def lists(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``term``, position) of all postings of the terms."""
        size = self.counts[term]
        which = np.repeat(np.arange(len(term)), size)
        inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        return which, self.positions[self.firsts[term][which] + inner]


# ---------------------------------------------------------------- items

class ItemBlock:
    """Distinct windows of a block of items, and the items of each window."""

    def __init__(self, rows: list[tuple[str, bytes]], window: int):
        known: dict[bytes, int] = {}
        pairs: set[tuple[int, int]] = set()
        names: dict[str, int] = {}
        for name, line in rows:
            words = line.split(b" ")
            item = names.setdefault(name, len(names))
            for at in range(max(1, len(words) - window + 1)):
                key = b" ".join(words[at:at + window])
                pairs.add((known.setdefault(key, len(known)), item))
        self.names = list(names)
        split = [k.split(b" ") for k in known]
        self.sizes = np.array([len(s) for s in split], np.int64)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        coded = pa.array([w for s in split for w in s], pa.binary()).dictionary_encode()
        self.vocabulary, self.terms = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        self.offsets = np.arange(len(self.terms)) - np.repeat(self.firsts, self.sizes)
        ordered = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.items = ordered[:, 1]
        self.item_counts = np.bincount(ordered[:, 0], minlength=len(split))
        self.item_firsts = np.cumsum(self.item_counts) - self.item_counts

    def items_of(self, window: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (segment, item) of matches."""
        both = np.unique(np.stack([segment, window], axis=1), axis=0)
        size = self.item_counts[both[:, 1]]
        inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        item = self.items[np.repeat(self.item_firsts[both[:, 1]], size) + inner]
        found = np.unique(np.stack([np.repeat(both[:, 0], size), item], axis=1), axis=0)
        return found[:, 0], found[:, 1]


def _item_pieces(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, line): words of items, long items in pieces that overlap by ``window - 1`` words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, lines = [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                words = words_of_bytes(text.as_py())
                for at in range(0, len(words) and max(1, len(words) - window + 1), PIECE_WORDS):
                    names.append(name)
                    lines.append(b" ".join(words[at:at + PIECE_WORDS + window - 1]))
            yield pa.record_batch([pa.array(names, pa.string()), pa.array(lines, pa.binary())], names=["item", "line"])

    named = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    return materialise(named.mapInArrow(run, "item string, line binary").distinct(), "item-pieces")


def _blocks(pieces: DataFrame) -> tuple[DataFrame, int]:
    """Pieces with a block number; no block holds more than ``BLOCK_BYTES`` unless it is one piece."""
    total = int(pieces.agg(F.sum(F.octet_length("line"))).first()[0] or 0)
    blocks = -(-total // (BLOCK_BYTES // 2))
    while blocks > 1:
        numbered = pieces.withColumn("block", F.pmod(F.xxhash64("item", "line"), F.lit(blocks)))
        sizes = numbered.groupBy("block").agg(F.sum(F.octet_length("line")).alias("size"), F.count("*").alias("n"))
        if not sizes.where((F.col("size") > BLOCK_BYTES) & (F.col("n") > 1)).head(1):
            break
        blocks *= 2
    return pieces.withColumn("block", F.pmod(F.xxhash64("item", "line"), F.lit(max(1, blocks)))), blocks


def _search(index: DataFrame, items: DataFrame, id_col: str, text_col: str, window: int, schema: T.StructType,
            answer: Callable[[_Shard, ItemBlock], Iterator[pa.RecordBatch]]) -> DataFrame | None:
    """``answer`` for every shard and block of items (None: no item has a window)."""
    spark, found = index.sparkSession, None
    pieces, blocks = _blocks(_item_pieces(items, id_col, text_col, window))
    for number in range(blocks):
        rows = [(r["item"], bytes(r["line"])) for r in pieces.where(F.col("block") == number).collect()]   # at most BLOCK_BYTES
        if not rows:
            continue
        block = spark.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            lists = ItemBlock(block.value, window)
            for batch in batches:
                for k in range(batch.num_rows):
                    yield from answer(_Shard(batch.slice(k, 1).to_pylist()[0]), lists)

        part = index.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found


def _chosen(shard: _Shard, block: ItemBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows whose terms are all held; term numbers of all slots; slots ordered by postings within each window."""
    term = shard.numbers(block.vocabulary)[block.terms]
    all_held = np.minimum.reduceat(term, block.firsts) >= 0
    slot_window = np.repeat(np.arange(len(block.sizes)), block.sizes)
    order = np.lexsort((shard.counts[term], slot_window))
    return np.flatnonzero(all_held), term, order


def _in_turn(windows: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of windows with about ``CANDIDATES`` candidates each."""
    run = (np.cumsum(sizes) - sizes) // CANDIDATES
    for part in np.split(windows, np.flatnonzero(np.diff(run)) + 1):
        if len(part):
            yield part


def phrases(shard: _Shard, block: ItemBlock) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(window, start) of all exact occurrences in a shard, some windows at a time."""
    windows, term, order = _chosen(shard, block)
    if not len(windows):
        return
    rarest = order[block.firsts]
    for some in _in_turn(windows, shard.counts[term[rarest[windows]]]):
        which, position = shard.lists(term[rarest[some]])
        window = some[which]
        start = position - block.offsets[rarest[window]]
        seg = shard.segment(position)
        keep = (start >= shard.begins[seg]) & (start + block.sizes[window] <= shard.ends[seg])
        window, start = window[keep], start[keep]
        for turn in range(1, int(block.sizes[some].max())):
            more = block.sizes[window] > turn
            slot = order[block.firsts[window] + np.where(more, turn, 0)]
            keep = ~more | shard.holds(term[slot], start + block.offsets[slot])
            window, start = window[keep], start[keep]
        yield window, start


def near_spans(shard: _Shard, block: ItemBlock, within: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(window, first, last) of the shortest spans of at most ``within`` words that hold all words of a window.

    Every occurrence of the rarest word is extended to the shortest span around
    it (the leftmost of equals); a word that a window has twice counts once.
    """
    windows, term, order = _chosen(shard, block)
    if not len(windows):
        return
    rarest = order[block.firsts]
    for some in _in_turn(windows, shard.counts[term[rarest[windows]]] * within):
        which, anchor = shard.lists(term[rarest[some]])
        window = some[which]
        seg = shard.segment(anchor)
        low, high = shard.begins[seg], shard.ends[seg]
        best_first, best_size = np.zeros(len(anchor), np.int64), np.full(len(anchor), within + 1, np.int64)
        for back in range(within - 1, -1, -1):                        # the span starts ``back`` words before the anchor
            first = anchor - back
            last, fits = anchor.copy(), first >= low
            for turn in range(1, int(block.sizes[some].max())):
                at = np.flatnonzero(fits & (block.sizes[window] > turn))
                slot = order[block.firsts[window[at]] + turn]
                following = np.searchsorted(shard.keys, term[slot] * shard.n + first[at])
                key = shard.keys[np.minimum(following, len(shard.keys) - 1)]
                position = key - term[slot] * shard.n
                good = (following < len(shard.keys)) & (position >= first[at]) & (position < np.minimum(first[at] + within, high[at]))
                last[at] = np.where(good, np.maximum(last[at], position), last[at])
                fits[at] = good
            size = last - first + 1
            better = fits & (size < best_size)
            best_first[better], best_size[better] = first[better], size[better]
        keep = best_size <= within
        found = np.unique(np.stack([window[keep], best_first[keep], best_first[keep] + best_size[keep] - 1], axis=1), axis=0)
        yield found[:, 0], found[:, 1], found[:, 2]


# ---------------------------------------------------------------- results

def _check(window: int, reach: int) -> None:
    if not 1 <= window <= reach + 1:
        raise ValueError(f"matches of {window} words need an index with reach {window - 1} or more, not {reach}")


def _matches(index: DataFrame, items: DataFrame, id_col: str, text_col: str, window: int, located) -> DataFrame:
    kind = index.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", kind), T.StructField("item", T.StringType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
    id_type = to_arrow_type(kind)

    def answer(shard: _Shard, block: ItemBlock) -> Iterator[pa.RecordBatch]:
        for windows, first, last in located(shard, block):
            seg = shard.segment(first)
            start = first - shard.begins[seg] - shard.leads[seg]        # in the owned words of the segment
            keep = (start >= 0) & (start < shard.owned[seg])            # each start is owned once
            windows, first, last, seg, start = windows[keep], first[keep], last[keep], seg[keep], start[keep]
            size = block.item_counts[windows]
            inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            item = block.items[np.repeat(block.item_firsts[windows], size) + inner]
            seg, start, length = (np.repeat(x, size) for x in (seg, start + shard.starts[seg], last - first + 1))
            yield pa.record_batch([pa.array([shard.rows[s] for s in seg], pa.int64()), pa.array([shard.ids[s] for s in seg], id_type),
                                   pa.array([block.names[i] for i in item], pa.string()), pa.array(start), pa.array(length)],
                                  names=["row", "doc_id", "item", "start", "length"])

    found = _search(index, items, id_col, text_col, window, schema, answer)
    found = found if found is not None else index.sparkSession.createDataFrame([], schema)
    return found.distinct()


def phrase_matches(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                   window: int = WINDOW, reach: int = REACH) -> DataFrame:
    """Every exact occurrence of a window: row, doc_id, item, start (word in the document), length."""
    _check(window, reach)

    def located(shard: _Shard, block: ItemBlock):
        for windows, start in phrases(shard, block):
            yield windows, start, start + block.sizes[windows] - 1

    return _matches(index, items, id_col, text_col, window, located)


def proximity_matches(index: DataFrame, items: DataFrame, within: int, id_col: str = "item_id", text_col: str = "text",
                      window: int = WINDOW, reach: int = REACH) -> DataFrame:
    """Every shortest span of at most ``within`` words with all words of a window: row, doc_id, item, start, length."""
    _check(within, reach)
    return _matches(index, items, id_col, text_col, window, lambda shard, block: near_spans(shard, block, within))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_hit`` (words inside occurrences), ``n_items``, ``items_sha256``,
    ``contaminated``, ``items`` (sorted) and ``spans`` (start and end of every run of hit words)."""
    index = build_index(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType
    spans_type = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())),
                           T.StructField("spans", spans_type)])

    def answer(shard: _Shard, block: ItemBlock) -> Iterator[pa.RecordBatch]:
        change = np.zeros(shard.n + 1, np.int32)
        touched: list[tuple[np.ndarray, np.ndarray]] = []
        for windows, start in phrases(shard, block):
            np.add.at(change, start, 1)
            np.add.at(change, start + block.sizes[windows], -1)
            touched.append(block.items_of(windows, shard.segment(start)))
        if not touched or not sum(len(s) for s, _ in touched):
            return
        hit = np.cumsum(change[:-1]) > 0
        named: dict[int, set[str]] = {}
        for segs, found in touched:
            for seg, item in zip(segs.tolist(), found.tolist()):
                named.setdefault(seg, set()).add(block.names[item])
        rows, items_, spans = [], [], []
        for seg, names in named.items():
            a = int(shard.begins[seg] + shard.leads[seg])
            owned = hit[a:a + int(shard.owned[seg])]
            edges = np.flatnonzero(np.diff(np.concatenate(([False], owned, [False])))) + int(shard.starts[seg])
            rows.append(shard.rows[seg])
            items_.append(sorted(names))
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edges[::2], edges[1::2])])
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.record_batch([pa.array(rows, pa.int64()), pa.array(items_, pa.list_(pa.string())), pa.array(spans, span)],
                              names=["row", "items", "spans"])

    segments = index.select(F.explode(F.arrays_zip("rows", "ids", "owned")).alias("x"))
    found = _search(index, items, item_col, item_text_col, window, schema, answer)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    # The parts of one document (segments, blocks of items) meet and are merged, then join the words of all documents.
    gathered = found.groupBy("row").agg(F.collect_list("items").alias("items"), F.flatten(F.collect_list("spans")).alias("spans"))
    hits = gathered.mapInArrow(_merged, T.StructType([*schema, T.StructField("n_hit", T.LongType())]))
    every = segments.select(F.col("x.rows").alias("row"), F.col("x.ids").alias("id"), F.col("x.owned").alias("owned"),
                            F.lit(None).cast("struct<n_hit:bigint,items:array<string>,spans:array<struct<start:bigint,end:bigint>>>").alias("hit"))
    every = every.unionByName(hits.select("row", F.lit(None).cast(kind).alias("id"), F.lit(0).cast("long").alias("owned"),
                                          F.struct("n_hit", "items", "spans").alias("hit")))
    merged = every.groupBy("row").agg(F.max("id").alias("id"), F.sum("owned").alias("n_words"), F.max("hit").alias("hit"))
    none = F.array().cast("array<string>")
    names, n_hit = F.coalesce("hit.items", none), F.coalesce("hit.n_hit", F.lit(0).cast("long"))
    return merged.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
                         F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
                         names.alias("items"), F.coalesce("hit.spans", F.array().cast(spans_type)).alias("spans"))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items named once, in order, and runs of hit words joined where they overlap or touch."""
    for batch in batches:
        items, spans, hits = [], [], []
        for row in batch.select(["items", "spans"]).to_pylist():
            items.append(sorted(set().union(*row["items"])))
            runs: list[list[int]] = []
            for x in sorted(row["spans"], key=lambda x: x["start"]):
                if runs and x["start"] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], x["end"])
                else:
                    runs.append([x["start"], x["end"]])
            spans.append([{"start": a, "end": b} for a, b in runs])
            hits.append(sum(b - a for a, b in runs))
        yield pa.record_batch([batch.column(0), pa.array(items, pa.list_(pa.string())),
                               pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                               pa.array(hits, pa.int64())], names=["row", "items", "spans", "n_hit"])
