"""Token ids in binary files that can be read document by document.

One file per range of document ids, documents in ascending id order.  A file
is a plain zstandard stream:

* independent data frames of ``FRAME_IDS`` little-endian ids (16 bit when the
  vocabulary allows, else 32 bit), each with its own checksum, cut without
  regard to document borders, so a long document spans several;
* a skippable frame (``INDEX_MAGIC``) with the id width and, zstandard
  compressed, document ids and lengths;
* a trailing seek table as in the public zstd seekable format (skippable frame
  0x184D2A5E: compressed size, decompressed size and XXH64 checksum of every
  data frame, frame count, flags, magic 0x8F92EAB1).

Spark's text writer puts the frames into the shared file system, so the commit
protocol guards against lost or repeated tasks and no local file is involved.
The writer ends each row with a newline; a data or index frame is therefore
followed by the header of a one-byte skippable frame that takes the newline in,
and the newline after the seek table is counted in its frame.  Any zstandard
decoder reads the file through.

``TokenFile`` opens a file through a seekable object and decompresses only the
frames that hold the requested documents; ``read_tokens`` does the same in
Spark tasks over all files.

Defined results: a null or empty text is the end id alone; a null id sorts
first and stays null; repeated ids are separate documents, ordered by text
hash; an empty table gives files without documents.  Only the named columns
are read.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retally.llm import tokens
from retally.llm.shared import fresh_path, materialise, parts_for

FRAME_IDS = 65536
LEVEL = 3
PAD = struct.pack("<II", 0x184D2A50, 1)          # header of the frame that takes the writer's newline
INDEX_MAGIC = 0x184D2A5D
SEEK_MAGIC, SEEK_END = 0x184D2A5E, 0x8F92EAB1
FOOTER = struct.Struct("<IBI")


class FileBuilder:
    """The rows of one file: frames as they fill, then index and seek table."""

    def __init__(self, width: int):
        self.width = width
        self.pending: list[np.ndarray] = []
        self.waiting = 0
        self.table: list[tuple[int, int, int]] = []
        self.docs: list[int] = []
        self.known: list[bool] = []
        self.lengths: list[int] = []
        self.press = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)

    def _frame(self, ids: np.ndarray) -> bytes:
        raw = ids.astype(f"<u{self.width}").tobytes()
        data = self.press.compress(raw) + PAD
        self.table.append((len(data) + 1, len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        return data

    def add(self, doc: int | None, ids: np.ndarray) -> Iterator[bytes]:
        self.docs.append(doc or 0)
        self.known.append(doc is not None)
        self.lengths.append(len(ids))
        self.pending.append(ids)
        self.waiting += len(ids)
        if self.waiting >= FRAME_IDS:
            whole = np.concatenate(self.pending)
            cut = len(whole) - len(whole) % FRAME_IDS
            for at in range(0, cut, FRAME_IDS):
                yield self._frame(whole[at:at + FRAME_IDS])
            self.pending, self.waiting = [whole[cut:]], len(whole) - cut

    def finish(self) -> Iterator[bytes]:
        if self.waiting:
            yield self._frame(np.concatenate(self.pending))
        index = self.press.compress(np.array(self.docs, "<i8").tobytes() + np.array(self.lengths, "<i8").tobytes()
                                    + np.array(self.known, "u1").tobytes())
        body = struct.pack("<BQ", self.width, len(self.docs)) + index
        yield struct.pack("<II", INDEX_MAGIC, len(body)) + body + PAD
        entries = b"".join(struct.pack("<III", *e) for e in self.table) + FOOTER.pack(len(self.table), 0x80, SEEK_END)
        # where the index frame starts, before the entries: readers go from the end
        yield struct.pack("<II", SEEK_MAGIC, len(entries) + 1) + entries


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
                 tokenizer: str | None = None, parts: int | None = None) -> None:
    """Encode every text and write the files under ``path``, in ascending id order."""
    source = tokenizer or tokens.default_path()
    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
               .repartitionByRange(parts or parts_for(docs, text_col), "id", F.xxhash64("text"))     # null or repeated ids spread
               .sortWithinPartitions("id", F.xxhash64("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder_of(source)
        builder = FileBuilder(2 if encoder.tokenizer.get_vocab_size() < 65536 and end_id < 65536 else 4)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, got in tokens.encoded(batch.column(1), encoder, end_id):
                for row in builder.add(ids[at], got):
                    yield pa.record_batch([pa.array([row], pa.binary())], names=["value"])
        if builder.docs:
            for row in builder.finish():
                yield pa.record_batch([pa.array([row], pa.binary())], names=["value"])

    rows = ordered.mapInArrow(run, "value binary")
    rows.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


class TokenFile:
    """One file through a seekable binary object; frames are read only when their ids are asked for."""

    def __init__(self, file):
        self.file = file
        size = file.seek(0, io.SEEK_END)
        self.frames: list[tuple[int, int, int, int]] = []
        self.docs, self.known, self.bounds = np.empty(0, "<i8"), np.empty(0, bool), np.zeros(1, np.int64)
        if not size:
            return
        count, _, magic = FOOTER.unpack(self._at(size - 1 - FOOTER.size, FOOTER.size))
        if magic != SEEK_END:
            raise ValueError("no seek table at the end of the file")
        start = size - 1 - FOOTER.size - 12 * count
        entries = np.frombuffer(self._at(start, 12 * count), "<u4").reshape(-1, 3).astype(np.int64)
        ends = np.cumsum(entries[:, 0])
        self.frames = [(int(e - c), int(c), int(n), int(x)) for e, (c, n, x) in zip(ends, entries)]
        at = int(ends[-1]) if count else 0
        magic, length = struct.unpack("<II", self._at(at, 8))
        if magic != INDEX_MAGIC:
            raise ValueError("no document index before the seek table")
        body = self._at(at + 8, length)
        self.width, n = struct.unpack("<BQ", body[:9])
        raw = zstandard.ZstdDecompressor().decompress(body[9:])
        self.docs, lengths = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<i8", n, 8 * n)
        self.known = np.frombuffer(raw, "u1", n, 16 * n).astype(bool)
        self.bounds = np.concatenate(([0], np.cumsum(lengths)))
        self._last: tuple[int, np.ndarray] | None = None
        self.opened = 0                # data frames decompressed so far

    def _at(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(length)

    def frame(self, number: int) -> np.ndarray:
        if self._last is None or self._last[0] != number:
            offset, length, size, check = self.frames[number]
            raw = zstandard.ZstdDecompressor().decompress(self._at(offset, length - len(PAD) - 1))
            if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {number} does not match its checksum")
            self.opened += 1
            self._last = (number, np.frombuffer(raw, f"<u{self.width}"))
        return self._last[1]

    def ids(self, position: int) -> np.ndarray:
        """All ids of the document at a position of the file, as 32-bit numbers."""
        a, b = int(self.bounds[position]), int(self.bounds[position + 1])
        parts = [self.frame(k)[max(a - k * FRAME_IDS, 0):b - k * FRAME_IDS] for k in range(a // FRAME_IDS, -(-b // FRAME_IDS))]
        return np.concatenate(parts).astype("<u4") if parts else np.empty(0, "<u4")


def read_tokens(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """Documents of all files: ``file``, ``doc_id``, ``file_start`` (ids before it in its file), ``n_tokens``, ``ids``.

    With ``doc_ids`` only those documents, and only their frames are decompressed.
    """
    wanted = None if doc_ids is None else np.array(sorted(doc_ids), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                source = TokenFile(pa.BufferReader(content.as_buffer()))
                places = np.arange(len(source.docs))
                if wanted is not None:
                    places = places[source.known & np.isin(source.docs, wanted)]
                for at in range(0, len(places), 512):
                    part = places[at:at + 512]
                    yield pa.record_batch([
                        pa.array([name.as_py()] * len(part), pa.string()),
                        pa.array(source.docs[part], pa.int64(), mask=~source.known[part]),
                        pa.array(source.bounds[part], pa.int64()),
                        pa.array(source.bounds[part + 1] - source.bounds[part], pa.int64()),
                        pa.array([source.ids(int(p)).tobytes() for p in part], pa.binary()),
                    ], names=["file", "doc_id", "file_start", "n_tokens", "ids"])

    files = spark.read.format("binaryFile").load(path).where("length > 0")
    return (files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
            .mapInArrow(run, "file string, doc_id long, file_start long, n_tokens long, ids binary"))


def ids_before(totals: DataFrame) -> DataFrame:
    """``totals(file, n)``, one row per file -> ``file`` and ``before``: the ids in all files of smaller part numbers.

    Spark pads part numbers to five digits only, so they are compared as numbers.
    """
    part = F.regexp_extract("file", r"^part-(\d+)", 1).cast("long")
    return totals.select("file", (F.sum("n").over(Window.orderBy(part)) - F.col("n")).alias("before"))


def token_positions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> DataFrame:
    """Write the files, read them back: per document its place among all ids and the checksum of its ids.

    Part numbers follow the range partitions, so their order is the id order; the
    ids before each file come from a window over one row per file.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "token-files")
    write_tokens(docs, path, id_col, text_col, end_id)
    read = materialise(read_tokens(spark, path).select("file", "doc_id", "file_start", "n_tokens", F.crc32("ids").alias("ids_crc32")),
                       "token-positions")
    before = materialise(ids_before(read.groupBy("file").agg(F.sum("n_tokens").alias("n"))), "token-files-before")   # one row per file
    return read.join(before, "file").select(
        F.col("doc_id").alias(id_col), (F.col("before") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32")
