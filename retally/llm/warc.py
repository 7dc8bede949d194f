"""Content-addressed web archive.

``write_archive`` stores every payload once and every record's header exactly:

* ``payloads``: WARC files with one ``resource`` record per distinct payload,
  named by its SHA-256.  The grouping combines on the map side, so copies of a
  hot payload collapse before the shuffle and each task ships a payload once.
  Rows that share a SHA-256 must also agree in length and SHA-1, or the job
  fails: a digest is not taken on trust.
* ``headers``: the WARC header of every record, a ``response`` or a
  ``revisit`` of the response with the same payload, blocks divided by an
  empty line as in a WARC file.

``read_payloads`` reads the files record by record and recomputes all digests,
``read_headers`` splits headers into fields, and ``restore_records`` joins the
two into the original records; each restored payload is held against the SHA-1
its own record had when it was written.  ``write_records`` lays restored records
out as ordinary WARC files.

Payload and record files hold one gzip member per record and are cut at
``FILE_BYTES`` of compressed bytes, so a reader unpacks one record at a time
whatever the size of a page; a file is longer only where a single record is.
All writing goes through Spark's committed writers.  Shuffles that carry
payloads get partitions by the bytes of the table; the join that gives a hot
payload to all its revisits is a sort-merge join, whose skewed partitions Spark
splits on the side of the headers.

Defined results: a null or empty payload is a payload of 0 bytes; a null URL
leaves its header line out, control characters in a URL are percent-encoded;
records that repeat the largest id of their payload are all responses; a null
id is the smallest; an empty table gives an empty archive.  Only the named
columns are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retally.llm.shared import fresh_path, materialise, parts_for

END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ID = "urn:page:"
STRONG = "X-Payload-SHA256"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 16 * 1024 * 1024      # compressed bytes of a payload or record file
FILE_HEADERS = 500_000             # headers of a header file, which is read row by row
PART_BYTES = 32 * 1024 * 1024      # payload bytes of a shuffle partition
BATCH_BYTES = 16 * 1024 * 1024     # of an Arrow batch
READ_BYTES = 8 * 1024              # compressed bytes unpacked at once
BLOCK_BYTES = 4 * 1024 * 1024      # payload bytes given back to Spark at once
# The writer ends each row, here a file, with one zero byte: the last byte of an empty gzip member.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff0300") + bytes(8)


@contextmanager
def sized_for_payloads(spark: SparkSession, parts: int) -> Iterator[None]:
    """Jobs that run inside shuffle into ``parts`` partitions at least and hand payloads to Python ``BATCH_BYTES`` at a time."""
    shuffles, batch = "spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxBytesPerBatch"
    before = {name: spark.conf.get(name) for name in (shuffles, batch)}
    spark.conf.set(shuffles, str(max(int(before[shuffles]), parts)))
    spark.conf.set(batch, str(BATCH_BYTES))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a SHA-1 given as 40 hex digits: every 5 hex digits are 4 symbols."""
    symbols = []
    for k in range(0, 40, 5):
        number = F.conv(F.substring(digest, k + 1, 5), 16, 10).cast("int")
        symbols += [F.substring(F.lit(BASE32), F.shiftright(number, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*symbols)


def _line(name: str, value: Column) -> Column:
    """One header line, left out when the value is null."""
    return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value.cast("string")), F.lit(""))


def _safe(url: Column) -> Column:
    for c in ("\r", "\n", "\t", "\x0b", "\x0c", "\x00"):
        url = F.replace(url, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return url


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``path/payloads`` and ``path/headers``.  Payloads under ``min_bytes`` are never revisited."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    hashed = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
                          F.sha2(F.encode(payload, "UTF-8"), 256).alias("strong"))
    records = materialise(hashed.select("id", "url", "strong", F.octet_length("payload").cast("long").alias("bytes"),
                                        F.sha1(F.encode("payload", "UTF-8")).alias("sha1")), "warc-records")

    stored = hashed.withColumn("sha1", F.sha1(F.encode("payload", "UTF-8"))).groupBy("strong").agg(
        F.first("payload").alias("payload"), F.min("sha1").alias("sha1"), F.max("sha1").alias("other"),
        F.min(F.octet_length("payload")).alias("least"), F.max(F.octet_length("payload")).alias("most"))
    same = (F.col("sha1") == F.col("other")) & (F.col("least") == F.col("most"))
    checked = F.when(same, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("different payloads share the digest "), F.col("strong"))))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource"), _line("WARC-Record-ID", F.concat(F.lit("<urn:sha256:"), F.col("strong"), F.lit(">"))),
                    _line("WARC-Date", F.lit(date)), _line(STRONG, F.col("strong")),
                    _line("Content-Length", F.octet_length("payload")), F.lit(END))
    with sized_for_payloads(pages.sparkSession, parts_for(pages, payload_col, PART_BYTES)):
        write_members(stored.select(F.encode(F.concat(head, checked), "UTF-8").alias("record")), f"{path}/payloads")

    shared = materialise(records.where(F.col("bytes") >= min_bytes).groupBy("strong")
                         .agg(F.max("id").alias("kept_id"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-shared")
    joined = records.join(shared, "strong", "left")
    again = (F.col("bytes") >= min_bytes) & F.col("kept_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("kept_id"))
    name = F.concat(F.lit(f"<{ID}"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        _line("WARC-Record-ID", name), _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", _safe(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha1")))), _line(STRONG, F.col("strong")),
        F.when(again, F.concat(_line("WARC-Refers-To", F.concat(F.lit(f"<{ID}"), F.col("kept_id").cast("string"), F.lit(">"))),
                               _line("WARC-Profile", F.lit(REVISIT)))).otherwise(F.lit("")),
        _line("Content-Length", F.when(again, F.lit(0).cast("long")).otherwise(F.col("bytes"))))
    (joined.select(header.alias("value")).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_HEADERS).text(f"{path}/headers"))


def write_members(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write the one binary column of ``records`` as WARC files: a gzip member per record, files cut by compressed bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def file() -> pa.RecordBatch:
            return pa.record_batch([pa.array([b"".join(waiting) + EMPTY_MEMBER[:-1]], pa.binary())], names=["value"])

        waiting, size = [], 0
        for batch in batches:
            for record in batch.column(0):
                press = zlib.compressobj(wbits=31)
                member = press.compress(record.as_buffer()) + press.compress(END.encode()) + press.flush()
                if waiting and size + len(member) > file_bytes:
                    yield file()
                    waiting, size = [], 0
                waiting.append(member)
                size += len(member)
        if waiting:
            yield file()

    files = records.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    files.write.option("lineSep", "\x00").option("maxRecordsPerFile", 1).text(path)


def members(data: memoryview) -> Iterator[bytes]:
    """The unpacked members of a gzip file, one at a time."""
    at = 0
    while at < len(data):
        one, parts = zlib.decompressobj(wbits=31), []
        while not one.eof:
            piece = data[at:at + READ_BYTES]
            if not len(piece):
                raise ValueError("the file ends within a record")
            parts.append(one.decompress(piece))
            at += len(piece) - len(one.unused_data)
        yield b"".join(parts)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record of an uncompressed WARC file."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("a record does not start with its version line")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = stop + 4
        end = start + int(fields["Content-Length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError("a record does not end with two line breaks")
        yield fields, data[start:end]
        at = end + 4


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Stored payloads: ``strong``, ``payload`` (bytes); digests are recomputed and checked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block() -> pa.RecordBatch:
            return pa.record_batch([pa.array(strong, pa.string()), pa.array(payloads, pa.binary())], names=["strong", "payload"])

        strong, payloads, size = [], [], 0
        for batch in batches:
            for content in batch.column(0):
                for member in members(memoryview(content.as_buffer())):
                    for fields, payload in parse_records(member):
                        if hashlib.sha256(payload).hexdigest() != fields[STRONG]:
                            raise ValueError(f"payload {fields[STRONG]} does not match its digest")
                        strong.append(fields[STRONG])
                        payloads.append(payload)
                        size += len(payload)
                        if size >= BLOCK_BYTES or len(strong) == 1024:
                            yield block()
                            strong, payloads, size = [], [], 0
        if strong:
            yield block()

    files = spark.read.format("binaryFile").load(f"{path}/payloads").where("length > 0").select("content")
    return files.mapInArrow(run, "strong string, payload binary")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """Records: ``header`` (exact), ``id``, ``record_type``, ``refers_to``, ``digest`` (base32 SHA-1), ``strong``."""
    rows = spark.read.option("lineSep", END).text(f"{path}/headers").where("value <> ''")

    def field(name: str) -> Column:
        found = F.regexp_extract("value", rf"\r\n{name}: ([^\r\n]*)", 1)
        return F.when(found != "", found)

    def number(name: str) -> Column:
        return F.regexp_extract("value", rf"\r\n{name}: <{ID}(-?\d+)>", 1)

    return rows.select(
        F.col("value").alias("header"),
        F.when(number("WARC-Record-ID") != "", number("WARC-Record-ID")).cast("long").alias("id"),
        field("WARC-Type").alias("record_type"),
        F.when(number("WARC-Refers-To") != "", number("WARC-Refers-To")).cast("long").alias("refers_to"),
        F.substring(field("WARC-Payload-Digest"), 6, 32).alias("digest"), field(STRONG).alias("strong"))


def restore_records(spark: SparkSession, path: str) -> DataFrame:
    """The original records, each with its own payload bytes, revisits too.

    ``id``, ``header``, ``record_type``, ``refers_to``, ``payload``,
    ``payload_digest`` (base32 SHA-1 of the restored payload, equal to the
    header's or the job fails) and ``record`` (as in a WARC file).
    """
    # by sort-merge: archives are compressed, so the planner would take the payloads for small enough to broadcast
    joined = read_headers(spark, path).join(read_payloads(spark, path).hint("merge"), "strong").withColumn("sha1", F.sha1("payload"))
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.unhex(F.lit("")))
    return joined.withColumn("restored", base32_of_hex(F.col("sha1"))).select(
        "id", "header", "record_type", "refers_to", "payload",
        F.when(F.col("restored") == F.col("digest"), F.col("restored"))
        .otherwise(F.raise_error(F.concat(F.lit("a payload does not match the digest of its record "), F.col("header")))).alias("payload_digest"),
        F.concat(F.encode(F.concat("header", F.lit(END)), "UTF-8"), block).alias("record"))


def write_records(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Complete WARC files (a gzip member per record) of restored records."""
    write_members(records.select("record"), path, file_bytes)


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
             min_bytes: int = 0) -> DataFrame:
    """Write the archive and restore every record from it: id, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``.

    Length and digest are those of the restored payload.
    """
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archive(pages, path, id_col, url_col, payload_col, min_bytes)
    records = restore_records(spark, path).select(
        F.col("id").alias(id_col), F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    with sized_for_payloads(spark, parts_for(pages, payload_col, PART_BYTES)):
        return materialise(records, "warc-restored")
