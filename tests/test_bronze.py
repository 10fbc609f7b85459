"""Landing, ingestion, run log, latest drop, inspection."""

from datetime import datetime
from hashlib import sha256
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from assay.functions.hashing import record_hash
from assay.plans.bronze import AUDIT_COLUMNS, ingest, ingest_all, inspect_bronze
from assay.plans.clock import Clock
from assay.sources.specs import BY_NAME, CUSTOMERS, ORDERS
from assay.sources.tables import (
    latest_drop, read_feed, read_if_present, read_latest_drop, write_drop,
)
from assay.streaming.ingest import ingest_new

FIRST, SECOND = datetime(2024, 1, 1, 8), datetime(2024, 1, 2, 8)
HEADER = (
    "order_id,customer_id,order_date,order_status,order_amount,currency,sales_channel,"
    "created_at,updated_at,source_system"
)


def customers(spark, *keys):
    rows = [tuple([key, f" {key} "] + [None] * 10) for key in keys]
    return spark.createDataFrame(rows, CUSTOMERS.schema)


def write_csv(folder, feed, name, *lines):
    target = Path(folder, "landing", feed)
    target.mkdir(parents=True, exist_ok=True)
    (target / name).write_text("".join(f"{line}\n" for line in lines))


def log_of(spark, folder):
    return spark.read.parquet(f"{folder}/log").orderBy("start_time").collect()


def test_drop_keeps_blanks_and_nulls(spark, folder):
    write_drop(customers(spark, "C1", None), folder, CUSTOMERS.feed, FIRST)
    rows = read_feed(spark, folder, CUSTOMERS.feed, CUSTOMERS.schema).collect()
    assert {(r["customer_id"], r["first_name"]) for r in rows} == {("C1", " C1 "), (None, " None ")}


def test_plain_files_are_drops_and_columns_match_by_position(spark, folder):
    write_csv(
        folder, "orders", "orders_20240101_080000.csv",
        HEADER.replace("order_id", "something_else"),
        "O1,C1,2024-01-01,PAID,12.5,AUD,WEB,x,y,z", "O2,C2,2024-01-01,PAID,cheap,AUD,WEB,x,y,z",
        "O3,C3",
    )
    rows = read_feed(spark, f"{folder}/landing", "orders", ORDERS.schema).orderBy("order_id")
    assert [(r["order_id"], r["order_amount"], r["currency"]) for r in rows.collect()] == [
        ("O1", 12.5, "AUD"), ("O2", None, "AUD"), ("O3", None, None),
    ]


def test_hash_skips_nulls_and_does_not_escape(spark):
    rows = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a||b", None, None)],
                                 "x STRING, y STRING, z STRING")
    found = [r[0] for r in rows.select(record_hash(rows.columns)).collect()]
    assert found == [sha256(b"a||b").hexdigest()] * 3


def test_ingest_appends_with_audit_columns_and_logs(spark, folder):
    write_csv(folder, "orders", "orders_1.csv", HEADER, "O1,C1,d,PAID,1.5,AUD,WEB,x,y,z")
    for batch in ("b1", "b2"):
        written = ingest(
            spark, ORDERS, f"{folder}/landing", f"{folder}/bronze", f"{folder}/log",
            Clock(instant=FIRST), batch_id=batch,
        )
        assert written == 1
    table = spark.read.parquet(f"{folder}/bronze/orders")
    assert table.columns == [*ORDERS.columns, *AUDIT_COLUMNS]
    rows = table.orderBy("_batch_id").collect()
    assert [r["_batch_id"] for r in rows] == ["b1", "b2"]
    text = "O1||C1||d||PAID||1.5||AUD||WEB||x||y||z"
    assert rows[0]["_record_hash"] == sha256(text.encode()).hexdigest()
    assert rows[0]["_source_file"].endswith("/landing/orders/orders_1.csv")
    assert str(rows[0]["_ingestion_timestamp"]) == "2024-01-01 08:00:00"

    first, second = log_of(spark, folder)
    assert first["run_id"] != second["run_id"] and first["run_id"] != first["batch_id"]
    assert (first["source_name"], first["rows_read"], first["rows_written"]) == ("orders", 1, 1)
    assert first["status"] == "SUCCESS" and first["error_message"] is None
    assert first["end_time"] >= first["start_time"] and first["duration_seconds"] >= 0


@pytest.mark.parametrize("lines", [(HEADER,), ()])
def test_feed_without_rows_is_a_success(spark, folder, lines):
    write_csv(folder, "orders", "orders_1.csv", *lines)
    places = (f"{folder}/landing", f"{folder}/bronze", f"{folder}/log")
    assert ingest(spark, ORDERS, *places) == 0
    (row,) = log_of(spark, folder)
    assert (row["status"], row["rows_read"], row["rows_written"]) == ("SUCCESS", 0, 0)


def test_failure_is_logged_and_stops_the_run(spark, folder):
    write_drop(customers(spark, "C1", "C2"), f"{folder}/landing", CUSTOMERS.feed, FIRST)
    with pytest.raises(AnalysisException):
        ingest_all(spark, f"{folder}/landing", f"{folder}/bronze", f"{folder}/log")
    done, failed = log_of(spark, folder)
    assert (done["source_name"], done["status"], done["rows_written"]) == (
        "crm_customers", "SUCCESS", 2,
    )
    assert (failed["source_name"], failed["status"], failed["rows_read"]) == ("orders", "FAILED", 0)
    assert "PATH_NOT_FOUND" in failed["error_message"]


def test_latest_drop_by_name(spark, folder):
    write_drop(customers(spark, "C2"), folder, CUSTOMERS.feed, SECOND)
    write_drop(customers(spark, "C1"), folder, CUSTOMERS.feed, FIRST)
    assert latest_drop(spark, folder, CUSTOMERS.feed).endswith("crm_customers_20240102_080000.csv")
    rows = read_latest_drop(spark, folder, CUSTOMERS.feed, CUSTOMERS.schema).collect()
    assert [r["customer_id"] for r in rows] == ["C2"]


def test_latest_plain_file_and_no_file(spark, folder):
    write_csv(folder, "orders", "orders_1.csv", HEADER)
    write_csv(folder, "orders", "orders_2.csv", HEADER)
    assert latest_drop(spark, f"{folder}/landing", "orders").endswith("/orders/orders_2.csv")
    with pytest.raises((FileNotFoundError, AnalysisException)):
        latest_drop(spark, f"{folder}/landing", "payments")


def test_missing_and_unfinished_tables(spark, folder):
    assert read_if_present(spark, f"{folder}/nowhere") is None
    customers(spark, "C1", "C2").write.parquet(f"{folder}/there")
    assert read_if_present(spark, f"{folder}/there").count() == 2
    Path(folder, "there", "_SUCCESS").unlink()
    with pytest.raises(FileNotFoundError, match="no committed table"):
        read_if_present(spark, f"{folder}/there")


def test_inspection(spark, folder):
    customers(spark, *"ABCDEFG").write.parquet(f"{folder}/crm_customers")
    spark.createDataFrame([], ORDERS.schema).write.parquet(f"{folder}/orders")
    profile, head = inspect_bronze(spark, folder)
    rows = {(r["table_name"], r["column_name"]): r for r in profile.collect()}
    assert rows["crm_customers", "status"]["row_count"] == 7
    assert rows["orders", "order_amount"]["data_type"] == "double"
    assert rows["orders", "order_amount"]["row_count"] == 0
    assert len(rows) == len(CUSTOMERS.columns) + len(ORDERS.columns)
    assert head.count() == 5


def test_new_files_are_read_once(spark, folder):
    places = (f"{folder}/landing", f"{folder}/bronze", f"{folder}/manifests", f"{folder}/log")
    write_drop(customers(spark, "C1", "C2"), f"{folder}/landing", CUSTOMERS.feed, FIRST)
    assert ingest_new(spark, CUSTOMERS, *places, batch_id="b1") == 2
    assert ingest_new(spark, CUSTOMERS, *places, batch_id="b2") == 0
    write_drop(customers(spark, "C3"), f"{folder}/landing", CUSTOMERS.feed, SECOND)
    assert ingest_new(spark, CUSTOMERS, *places, batch_id="b3") == 1
    table = spark.read.parquet(f"{folder}/bronze/crm_customers")
    assert {(r["customer_id"], r["_batch_id"]) for r in table.collect()} == {
        ("C1", "b1"), ("C2", "b1"), ("C3", "b3"),
    }
    assert table.where(F.col("_source_file").contains("crm_customers_2024")).count() == 3
    assert [r["rows_written"] for r in log_of(spark, folder)] == [2, 0, 1]
    assert not list(Path(folder, "bronze").rglob("_spark_metadata"))


def test_names_with_wildcards_are_plain_names(spark, folder):
    lines = [HEADER, "O1,C1,d,PAID,1.5,AUD,WEB,x,y,z"]
    write_csv(folder, "orders", "orders_[1] {a}.csv", *lines)
    write_csv(folder, "orders", "orders_1.csv", *lines)
    places = (f"{folder}/landing", f"{folder}/bronze", f"{folder}/manifests", f"{folder}/log")
    assert ingest_new(spark, ORDERS, *places) == 2


def test_a_feed_that_has_not_landed_fails_in_both_modes(spark, folder):
    places = (f"{folder}/landing", f"{folder}/bronze")
    with pytest.raises(AnalysisException):
        ingest_new(spark, ORDERS, *places, f"{folder}/manifests", f"{folder}/log")
    with pytest.raises(AnalysisException):
        ingest(spark, ORDERS, *places, f"{folder}/log", manifests=f"{folder}/manifests")
    assert [r["status"] for r in log_of(spark, folder)] == ["FAILED", "FAILED"]


def test_a_run_that_died_is_picked_up(spark, folder, monkeypatch):
    """Before its rows reached bronze they are read again; after that they are not."""
    places = (f"{folder}/landing", f"{folder}/bronze", f"{folder}/manifests", f"{folder}/log")
    write_drop(customers(spark, "C1"), f"{folder}/landing", CUSTOMERS.feed, FIRST)

    def die(*_):
        raise RuntimeError("the driver died")

    with monkeypatch.context() as broken:
        broken.setattr("assay.plans.bronze.append_rows", die)
        with pytest.raises(RuntimeError):
            ingest_new(spark, CUSTOMERS, *places)
    assert ingest_new(spark, CUSTOMERS, *places) == 1
    write_drop(customers(spark, "C2"), f"{folder}/landing", CUSTOMERS.feed, SECOND)
    with monkeypatch.context() as broken:
        broken.setattr("assay.sources.manifest.Manifest.finish", die)
        with pytest.raises(RuntimeError):
            ingest_new(spark, CUSTOMERS, *places)
    assert ingest_new(spark, CUSTOMERS, *places) == 0
    table = spark.read.parquet(f"{folder}/bronze/crm_customers")
    assert sorted(r["customer_id"] for r in table.collect()) == ["C1", "C2"]


def test_both_modes_agree(spark, folder):
    spec = BY_NAME["customers"]
    write_drop(customers(spark, "C1", "C2", "C3"), f"{folder}/landing", spec.feed, FIRST)
    clock = Clock(instant=FIRST)
    ingest(spark, spec, f"{folder}/landing", f"{folder}/batch", f"{folder}/log", clock, "b")
    ingest_new(
        spark, spec, f"{folder}/landing", f"{folder}/stream", f"{folder}/manifests",
        f"{folder}/log", clock, "b",
    )
    batch, stream = (spark.read.parquet(f"{folder}/{kind}/{spec.feed}") for kind in
                     ("batch", "stream"))
    assert sorted(map(str, batch.collect())) == sorted(map(str, stream.collect()))
