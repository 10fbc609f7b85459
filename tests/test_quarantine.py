"""Cells that do not fit the schema are counted and kept with their text."""

from pathlib import Path

import pytest

from assay.plans.bronze import ingest
from assay.plans.gold import run_report
from assay.plans.quarantine import malformed_counts, quarantine_path, read_quarantine
from assay.plans.silver import SilverTables, refine_table
from assay.sources.folders import exists
from assay.sources.specs import BY_NAME, LOYALTY_ACCOUNTS, ORDERS
from assay.streaming.ingest import ingest_new

HEADER = (
    "order_id,customer_id,order_date,order_status,order_amount,currency,sales_channel,created_at,"
    "updated_at,source_system"
)
GOOD = "O1,C1,d,PAID,1.5,AUD,WEB,x,y,z"
LINES = [
    HEADER, GOOD, "O2,C1,d,PAID,abc,AUD,WEB,x,y,z", "O3,C1,d,PAID,,AUD,WEB,x,y,z", "O4,C1,d",
    "O5,C1,d,PAID,2.5,AUD,WEB,x,y,z,extra", '"O,6",C1,d,PAID,"1,5",AUD,WEB,x,y,z',
]


def land(folder, feed, name, lines):
    path = Path(folder, "landing", feed, name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def places(folder):
    return f"{folder}/landing", f"{folder}/bronze"


def cells_of(spark, folder, feed="orders"):
    return sorted(
        (r["record_text"].split(",C")[0], r["column_name"], r["cell_text"], r["_batch_id"])
        for r in read_quarantine(spark, f"{folder}/bronze", feed).collect()
    )


WANTED = [
    ('"O,6"', "order_amount", "1,5"), ("O2", "order_amount", "abc"), ("O4", None, None),
    ("O5", None, None),
]


def test_bad_cells_are_kept_and_rows_stay(spark, folder):
    land(folder, "orders", "orders_1.csv", LINES)
    assert ingest(spark, ORDERS, *places(folder), f"{folder}/log", batch_id="007") == 6
    assert cells_of(spark, folder) == [(*cell, "007") for cell in WANTED]
    rows = spark.read.parquet(f"{folder}/bronze/orders").collect()
    amounts = {r["order_id"]: r["order_amount"] for r in rows}
    assert amounts == {"O1": 1.5, "O2": None, "O3": None, "O4": None, "O5": 2.5, "O,6": None}
    assert "_record_text" not in rows[0].asDict()
    source = read_quarantine(spark, f"{folder}/bronze", "orders").first()["_source_file"]
    assert source.endswith("/landing/orders/orders_1.csv")


def test_a_batch_without_bad_cells_leaves_no_table(spark, folder):
    land(folder, "orders", "orders_1.csv", [HEADER, GOOD])
    ingest(spark, ORDERS, *places(folder), f"{folder}/log")
    assert not exists(spark, quarantine_path(f"{folder}/bronze", "orders"))
    assert cells_of(spark, folder) == []


@pytest.mark.parametrize("place", ["assay.plans.bronze.quarantine_batch",
                                   "assay.sources.manifest.Manifest.finish"])
def test_a_run_that_died_still_owes_its_bad_cells(spark, folder, monkeypatch, place):
    def die(*_):
        raise RuntimeError("the driver died")

    land(folder, "orders", "orders_1.csv", LINES)
    more = (f"{folder}/manifests", f"{folder}/log")
    with monkeypatch.context() as broken:
        broken.setattr(place, die)
        with pytest.raises(RuntimeError):
            ingest_new(spark, ORDERS, *places(folder), *more, batch_id="b1")
    assert ingest_new(spark, ORDERS, *places(folder), *more, batch_id="b2") == 0
    assert cells_of(spark, folder) == [(*cell, "b1") for cell in WANTED]


def test_report_counts_bad_cells(spark, folder):
    names = ",".join(LOYALTY_ACCOUNTS.columns)
    row = ",".join("7.5" if n == "points_balance" else "v" for n in LOYALTY_ACCOUNTS.columns)
    land(folder, "orders", "orders_1.csv", LINES)
    land(folder, "loyalty_accounts", "loyalty_accounts_1.csv", [names, row])
    land(folder, "crm_customers", "crm_customers_1.csv", [",".join(BY_NAME["customers"].columns)])
    specs = [BY_NAME[name] for name in ("customers", "orders", "loyalty_accounts")]
    silver, bronze = SilverTables(spark, f"{folder}/silver"), {}
    for spec in specs:
        ingest(spark, spec, *places(folder), f"{folder}/log")
        bronze[spec.name] = spark.read.parquet(f"{folder}/bronze/{spec.feed}")
        refine_table(bronze[spec.name], spec, silver)
    counts = malformed_counts(spark, f"{folder}/bronze", specs)
    report = run_report(spark, bronze, silver, specs, counts).collect()
    assert {r["source_name"]: r["malformed_cells"] for r in report} == {
        "customers": 0, "orders": 4, "loyalty_accounts": 1,
    }
