"""Web archive: digests, revisits, exact round trip, edge cases."""

import base64
import gzip
import hashlib

import pytest

from retally.llm.shared import fresh_path
from retally.llm.warc import (END, archived, members, parse_records, read_payloads, restore_records, write_archive, write_members,
                              write_records)

SCHEMA = "page_id long, url string, html string, strong string, payload string, bytes string"


def slow(rows, least=0):
    biggest = {}
    for page, _, html in rows:
        key = (html or "").encode()
        biggest[key] = max(biggest.get(key, -10**9), -10**9 + 1 if page is None else page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        keep = biggest[data]
        again = len(data) >= least and page is not None and page != keep
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if again else "response", keep if again else None))
    return sorted(out, key=str)


ROWS = ([(i, f"http://a/{i}", "<p>hot</p>\r\n\r\nWARC/1.1\r\n") for i in range(150)]
        + [(200 + i, "http://b/é\r\nX: y\t", f"<b>{i // 2}</b>\r\n") for i in range(40)]
        + [(300, None, None), (301, "", ""), (302, "u", "long é " * 60000), (303, "u", "\r\n\r\n")])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(5)


def test_archive_read_back(spark):
    for least in (0, 25):
        got = sorted((tuple(r) for r in archived(frame(spark, ROWS), min_bytes=least).collect()), key=str)
        assert got == slow(ROWS, least)


def test_payloads_are_stored_once_and_records_are_restored(spark):
    path = fresh_path(spark, "test-warc")
    write_archive(frame(spark, ROWS), path)
    payloads = {(r[2] or "").encode() for r in ROWS}
    stored = [bytes(r.payload) for r in read_payloads(spark, path).collect()]
    assert sorted(stored) == sorted(payloads)
    restored = restore_records(spark, path)
    by_id = {r[0]: (r[2] or "").encode() for r in ROWS}
    rows = restored.collect()
    assert len(rows) == len(ROWS) and all(bytes(r.payload) == by_id[r.id] for r in rows)
    # the complete WARC files hold the same records
    out = fresh_path(spark, "test-warc-files")
    write_records(restored, out)
    data = b"".join(gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").load(out).where("length > 0").collect())
    parsed = sorted((f["WARC-Type"], block) for f, block in parse_records(data))
    assert parsed == sorted((kind, by_id[page] if kind == "response" else b"") for page, _, _, kind, _ in slow(ROWS))
    assert data.endswith(END.encode())


def stored_files(spark, path):
    return [bytes(r.content) for r in spark.read.format("binaryFile").load(path).where("length > 0").collect()]


def test_a_member_per_record_and_files_cut_by_bytes(spark):
    records = [b"WARC/1.1\r\nContent-Length: 64\r\n\r\n" + hashlib.sha512(bytes([i])).digest() for i in range(60)]
    out = fresh_path(spark, "test-warc-cut")
    write_members(spark.createDataFrame([(r,) for r in records], "record binary").coalesce(1), out, file_bytes=1000)
    files = stored_files(spark, out)
    assert len(files) > 5 and all(len(f) < 1100 for f in files)
    read = [m for f in files for m in members(memoryview(f)) if m]
    assert sorted(read) == sorted(r + END.encode() for r in records)
    assert b"".join(gzip.decompress(f) for f in files) == b"".join(read)          # any gzip reader reads the files through
    with pytest.raises(ValueError):
        list(members(memoryview(files[0])[:-30]))


def test_a_record_longer_than_a_file(spark):
    rows = [(1, "u", "é\r\n" * 2_000_000), (2, "u", "é\r\n" * 2_000_000), (3, "u", "x")]
    got = sorted((tuple(r) for r in archived(frame(spark, rows)).collect()), key=str)
    assert got == slow(rows)


def test_a_header_that_does_not_fit_its_payload_is_refused(spark):
    path = fresh_path(spark, "test-warc-wrong")
    write_archive(frame(spark, [(1, "u", "x"), (2, "u", "y")]), path)
    headers = spark.read.option("lineSep", END).text(f"{path}/headers").where("value <> ''")
    wrong = headers.selectExpr("replace(value, 'sha1:', 'sha1:A') AS value")
    other = fresh_path(spark, "test-warc-wrong-headers")
    wrong.write.option("lineSep", END).text(f"{other}/headers")
    spark.read.format("binaryFile").load(f"{path}/payloads").where("length > 0").selectExpr("CAST(substring(content, 1, length(content) - 1) AS STRING) AS value") \
        .write.option("lineSep", "\x00").option("maxRecordsPerFile", 1).text(f"{other}/payloads")
    assert len(restore_records(spark, path).collect()) == 2
    with pytest.raises(Exception, match="does not match the digest of its record"):
        restore_records(spark, other).collect()


def test_broken_files_are_refused():
    with pytest.raises(ValueError):
        list(parse_records(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcd\r\n\r\n"))


def test_empty_table_and_repeated_rows(spark):
    assert archived(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(7, "u", "x"), (7, "u", "x"), (6, "u", "x"), (None, "u", "x")]
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in archived(frame(spark, rows)).where("page_id is not null").collect())
    assert got == [(6, "revisit", 7), (7, "response", None), (7, "response", None)]
