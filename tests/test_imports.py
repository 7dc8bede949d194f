"""Replacing tables all at once, the drop ledger, appends by name."""

import os
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from retally import schemas
from retally.plans.ingest import import_payments
from retally.sources import versions
from retally.sources.files import list_drops, list_files
from retally.sources.ledger import import_newest, new_drops, newest_new, read_ledger
from retally.sources.sinks import append_table, stage_report
from retally.sources.versions import OLD, recover, replace_table
from retally.streaming import payment_drop_stream
from tests.fixtures import frame

HDR = "description,status,notes\n"


def _touch(folder, name, text="x", mtime=None):
    path = os.path.join(str(folder), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return path


@pytest.fixture
def table(spark, request):
    name = f"t_{abs(hash(request.node.name))}"
    for n in (name, name + OLD):
        spark.sql(f"DROP TABLE IF EXISTS {n}")
    yield name
    for n in (name, name + OLD):
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def ids(spark, table):
    return sorted(r.id for r in spark.table(table).collect())


def failing(spark):
    """Some tasks write their rows before one fails."""
    return spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 999, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("id")).alias("id"))


def test_a_failing_write_leaves_the_old_rows(spark, table, tmp_path):
    replace_table(spark.range(3), table, str(tmp_path))
    with pytest.raises(PySparkException):
        replace_table(failing(spark), table, str(tmp_path))
    assert ids(spark, table) == [0, 1, 2]
    assert len(os.listdir(tmp_path)) == 1                        # nothing of the failed version is left
    replace_table(spark.range(5), table, str(tmp_path))
    assert ids(spark, table) == [0, 1, 2, 3, 4]


def test_a_failing_first_write_makes_no_table(spark, table, tmp_path):
    with pytest.raises(PySparkException):
        replace_table(failing(spark), table, str(tmp_path))
    assert not spark.catalog.tableExists(table)


def test_a_table_can_be_replaced_from_itself(spark, table, tmp_path):
    replace_table(spark.range(4), table, str(tmp_path))
    for _ in range(3):
        replace_table(spark.table(table).where("id > 0").select((F.col("id") - 1).alias("id")), table, str(tmp_path))
    assert ids(spark, table) == [0]
    assert len(os.listdir(tmp_path)) == versions.KEPT_VERSIONS


def test_other_columns_come_with_the_new_rows(spark, table, tmp_path):
    replace_table(spark.range(2), table, str(tmp_path))
    replace_table(spark.range(2).select(F.col("id").cast("string").alias("name"), F.lit(1).alias("n")), table, str(tmp_path))
    assert spark.table(table).columns == ["name", "n"] and spark.table(table).count() == 2
    assert not spark.catalog.tableExists(table + OLD)


def test_a_managed_table_is_taken_over(spark, table):
    spark.range(7).write.saveAsTable(table)
    with pytest.raises(PySparkException):
        replace_table(failing(spark), table)
    assert ids(spark, table) == list(range(7))
    replace_table(spark.range(2), table)
    assert ids(spark, table) == [0, 1]


def test_a_crash_between_the_renames_is_undone(spark, table, tmp_path):
    replace_table(spark.range(3), table, str(tmp_path))
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}{OLD}")
    recover(spark, table)
    assert ids(spark, table) == [0, 1, 2]
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}{OLD}")
    replace_table(spark.range(1), table, str(tmp_path))
    assert ids(spark, table) == [0] and not spark.catalog.tableExists(table + OLD)


def test_a_running_reader_keeps_its_rows(spark, table, tmp_path):
    replace_table(spark.range(3), table, str(tmp_path))
    reader = spark.read.parquet(*spark.table(table).inputFiles())
    replace_table(spark.range(9), table, str(tmp_path))
    assert reader.count() == 3


def test_import_payments_keeps_the_table_when_the_drop_is_broken(spark, table, tmp_path):
    now = time.time()
    _touch(tmp_path, "payments 1.csv", HDR + "1,captured,{}\n", now - 100)
    import_payments(spark, str(tmp_path), table)
    _touch(tmp_path, "payments 2.csv", "description,status\n1,captured\n", now)
    with pytest.raises(ValueError, match="notes"):
        import_payments(spark, str(tmp_path), table)
    assert [r.description for r in spark.table(table).collect()] == ["1"]


def test_staging_keeps_its_rows_when_the_report_fails(spark, table):
    row = dict(scanno=1, ansidrno="A", course="C", marks=12, scrutiny_type="rt")
    report = frame(spark, schemas.REPORT, [row])
    stage_report(report, table)
    with pytest.raises(PySparkException):
        stage_report(report.withColumn("marks", F.raise_error(F.lit("broken")).cast("int")), table)
    with pytest.raises(TypeError, match="marks"):
        stage_report(report.withColumn("marks", F.lit("12")), table)
    assert [tuple(r) for r in spark.table(table).collect()] == [tuple(r) for r in report.collect()]


def test_the_stream_keeps_the_table_when_a_drop_is_broken(spark, table, tmp_path):
    drops, ck, now = tmp_path / "drops", str(tmp_path / "ck"), time.time()
    _touch(drops, "payments 1.csv", HDR + "1,captured,{}\n", now - 100)
    payment_drop_stream(spark, str(drops), table, checkpoint=ck).awaitTermination(120)
    _touch(drops, "payments 2.csv", "description,status\n9,captured\n", now - 50)
    with pytest.raises(Exception):
        payment_drop_stream(spark, str(drops), table, checkpoint=ck).awaitTermination(120)
    assert [r.description for r in spark.table(table).collect()] == ["1"]


def test_append_finds_columns_by_name(spark, table):
    append_table(spark.sql("SELECT 'a' AS lable, 'x' AS src_location"), table)
    append_table(spark.sql("SELECT 'y' AS src_location, 'b' AS lable"), table)
    assert sorted(tuple(r) for r in spark.table(table).select("lable", "src_location").collect()) == [("a", "x"), ("b", "y")]
    with pytest.raises(ValueError, match="src_location"):
        append_table(spark.sql("SELECT 'c' AS lable, 'z' AS place"), table)


# ---------------------------------------------------------------- ledger

def test_ledger_takes_each_drop_once_and_never_an_older_one(spark, table, tmp_path):
    drops, ledger, now = tmp_path / "drops", str(tmp_path / "ledger"), time.time()

    def run():
        return import_newest(spark, str(drops), table, ledger, schema=schemas.PAYMENT, path=str(tmp_path / "versions"))

    def held():
        return [r.description for r in spark.table(table).collect()]

    os.makedirs(drops)
    assert run() is None and not spark.catalog.tableExists(table)
    _touch(drops, "payments b.csv", HDR + "1,captured,{}\n", now - 300)
    _touch(drops, "payments a.csv", HDR + "2,captured,{}\n", now - 200)
    assert run().endswith("payments a.csv") and held() == ["2"]
    assert run() is None
    _touch(drops, "payments late.csv", HDR + "3,captured,{}\n", now - 250)     # older than what the table holds
    assert run() is None and held() == ["2"]
    _touch(drops, "payments a.csv", HDR + "4,captured,{}\n5,captured,{}\n", now - 100)   # written anew under its name
    assert run().endswith("payments a.csv") and sorted(held()) == ["4", "5"]
    rows = read_ledger(spark, ledger)
    assert rows.count() == 4 and rows.where("imported").count() == 2
    assert new_drops(list_drops(spark, str(drops), "payments"), rows).count() == 0


def test_a_broken_drop_stays_new(spark, table, tmp_path):
    drops, ledger, now = tmp_path / "drops", str(tmp_path / "ledger"), time.time()
    _touch(drops, "payments 1.csv", HDR + "1,captured,{}\n", now - 300)
    import_newest(spark, str(drops), table, ledger, schema=schemas.PAYMENT)
    _touch(drops, "payments 2.csv", "description,status\n2,captured\n", now - 200)
    with pytest.raises(ValueError):
        import_newest(spark, str(drops), table, ledger, schema=schemas.PAYMENT)
    assert [r.description for r in spark.table(table).collect()] == ["1"]
    _touch(drops, "payments 2.csv", HDR + "2,captured,{}\n", now - 100)
    assert import_newest(spark, str(drops), table, ledger, schema=schemas.PAYMENT).endswith("payments 2.csv")
    assert [r.description for r in spark.table(table).collect()] == ["2"]


def test_equal_times_are_parted_by_path(spark, tmp_path):
    now = time.time() - 50
    for name in ("payments x.csv", "payments y.csv"):
        _touch(tmp_path, name, HDR, now)
    listing = list_drops(spark, str(tmp_path), "payments")
    assert newest_new(listing, read_ledger(spark, str(tmp_path / "none"))).first()["path"].endswith("payments y.csv")


def test_a_drop_can_be_a_folder_of_part_files(spark, table, tmp_path):
    drops, now = tmp_path / "drops", time.time()
    _touch(drops, "payments 0.csv", HDR + "1,captured,{}\n", now - 300)
    parts = spark.createDataFrame([(str(k), "captured", "{}") for k in range(20)], schemas.PAYMENT).repartition(3)
    parts.write.option("header", True).csv(str(drops / "payments 1.csv"))
    _touch(drops, "other/payments 9.csv", HDR + "9,captured,{}\n", now + 100)      # not directly in the folder
    listing = {os.path.basename(r.path): r.length for r in list_drops(spark, str(drops), "payments").collect()}
    assert set(listing) == {"payments 0.csv", "payments 1.csv"}
    import_newest(spark, str(drops), table, str(tmp_path / "ledger"), schema=schemas.PAYMENT)
    assert spark.table(table).count() == 20


def test_listing_leaves_the_tree_below_alone(spark, tmp_path):
    """Only the folder itself is listed: a file deep below is no entry, an empty or missing match is no error."""
    _touch(tmp_path, "admission_approval 1 a.pdf")
    _touch(tmp_path, "deep/er/admission_approval 2 b.pdf")
    _touch(tmp_path, "k=v/admission_approval 3 c.pdf")
    assert [r.file_name for r in list_files(spark, str(tmp_path)).collect()] == ["admission_approval 1 a.pdf"]
    assert list_files(spark, str(tmp_path), "nothing*").count() == 0
    assert list_drops(spark, str(tmp_path), "payments").count() == 0
