"""Streaming ingest: exactly-once register, newest drop replaces the payment table."""

import os
import tempfile
import time

from retally.streaming import payment_drop_stream, register_stream


def _touch(folder, name, text="x", mtime=None):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    if mtime is not None:
        os.utime(path, (mtime, mtime))


def test_register_stream_is_exactly_once(spark):
    d, ck = tempfile.mkdtemp(prefix="rs-"), tempfile.mkdtemp(prefix="rs-ck-")
    _touch(d, "admission_approval 1 a.pdf")
    _touch(d, "fee_receipt 2 b.pdf")
    spark.sql("DROP TABLE IF EXISTS register_stream_t")
    register_stream(spark, d, "register_stream_t", ck).awaitTermination(120)
    assert spark.table("register_stream_t").count() == 1
    _touch(d, "admission_approval 3 c.pdf")
    register_stream(spark, d, "register_stream_t", ck).awaitTermination(120)
    got = sorted(r.coll_code for r in spark.table("register_stream_t").collect())
    assert got == [1, 3]                       # the first file is not registered twice


def test_payment_drop_stream_keeps_newest(spark):
    d, ck = tempfile.mkdtemp(prefix="ps-"), tempfile.mkdtemp(prefix="ps-ck-")
    hdr = "description,status,notes\n"
    now = time.time()
    _touch(d, "payments 1.csv", hdr + "1,captured,{}\n", now - 100)
    _touch(d, "payments 2.csv", hdr + "2,captured,{}\n3,captured,{}\n", now - 50)
    _touch(d, "other.csv", hdr + "9,captured,{}\n", now)
    spark.sql("DROP TABLE IF EXISTS payment_stream_t")
    payment_drop_stream(spark, d, "payment_stream_t", checkpoint=ck).awaitTermination(120)
    assert sorted(r.description for r in spark.table("payment_stream_t").collect()) == ["2", "3"]
    _touch(d, "payments 3.csv", hdr + "4,captured,{}\n", now)
    payment_drop_stream(spark, d, "payment_stream_t", checkpoint=ck).awaitTermination(120)
    assert [r.description for r in spark.table("payment_stream_t").collect()] == ["4"]


def test_an_older_drop_that_arrives_later_changes_nothing(spark):
    d, ck = tempfile.mkdtemp(prefix="ps-"), tempfile.mkdtemp(prefix="ps-ck-")
    now = time.time()
    _touch(d, "payments new.csv", 'notes,status,description\n"{""sem"": ""1y""}",captured,2\n', now - 50)
    spark.sql("DROP TABLE IF EXISTS payment_late_t")
    payment_drop_stream(spark, d, "payment_late_t", checkpoint=ck).awaitTermination(120)
    _touch(d, "payments old.csv", "description,status,notes\n1,captured,{}\n", now - 500)
    payment_drop_stream(spark, d, "payment_late_t", checkpoint=ck).awaitTermination(120)
    assert [(r.description, r.notes) for r in spark.table("payment_late_t").collect()] == [("2", '{"sem": "1y"}')]
