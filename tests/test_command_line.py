"""The jobs as a user calls them, one after the other over one folder."""

import pytest

from assay.__main__ import arguments, execute
from assay.plans.silver import SilverTables
from assay.session import CHECKPOINT_SETTING, new_run_root, release_run, shared_root
from assay.sources.folders import exists


def call(spark, folder, *words):
    execute(spark, arguments(["--root", folder, "--as-of", "2024-01-25", *words]))


def quality_of(spark, folder):
    rows = spark.read.parquet(f"{folder}/gold/dq_summary").collect()
    return {row["source_name"]: row for row in rows}


def test_jobs_in_sequence(spark, folder, capsys):
    call(spark, folder, "generate", "--customers", "200")
    call(spark, folder, "ingest")
    call(spark, folder, "inspect")
    assert "crm_customers" in capsys.readouterr().out
    call(spark, folder, "refine", "customers")
    call(spark, folder, "refine", "orders", "payments")
    assert "deduplicated_rows" in capsys.readouterr().out
    call(spark, folder, "refine")
    call(spark, folder, "summarise")
    shown = capsys.readouterr().out
    assert "rejection_rate_percent" in shown and "total_customers" in shown

    written = SilverTables(spark, f"{folder}/silver")
    payments = written.graded("payments")
    assert payments.columns[:2] == ["order_id", "customer_id"]
    assert payments.columns[-5:] == [
        "customer_exists", "order_exists", "_has_future_updated_at", "_is_valid",
        "_rejection_reason",
    ]
    assert {"_ingestion_timestamp", "_source_file", "_batch_id", "_record_hash",
            "_silver_processed_at"} <= set(payments.columns)
    assert payments.schema["_is_valid"].dataType.simpleString() == "boolean"
    assert written.valid("payments").where("_rejection_reason IS NOT NULL").count() == 0
    assert written.rejected("payments").where("_rejection_reason IS NULL").count() == 0
    assert written.valid("customers").columns[0] == "customer_id"


def test_ingesting_again_inflates_bronze_but_not_silver(spark, folder):
    call(spark, folder, "generate", "--customers", "50")
    call(spark, folder, "run")
    before = quality_of(spark, folder)
    call(spark, folder, "run")
    after = quality_of(spark, folder)
    for name, row in before.items():
        assert after[name]["bronze_rows"] == 2 * row["bronze_rows"]
        assert after[name]["silver_valid_rows"] == row["silver_valid_rows"]
        assert after[name]["silver_rejected_rows"] == row["silver_rejected_rows"]


def test_a_feed_without_rows_still_gives_gold(spark, folder):
    call(spark, folder, "generate", "--customers", "50")
    call(spark, folder, "ingest")
    bronze = spark.read.parquet(f"{folder}/bronze/support_tickets")
    bronze.limit(0).write.mode("overwrite").parquet(f"{folder}/none")
    spark.read.parquet(f"{folder}/none").write.mode("overwrite").parquet(
        f"{folder}/bronze/support_tickets"
    )
    call(spark, folder, "refine")
    call(spark, folder, "summarise")
    tables = SilverTables(spark, f"{folder}/silver")
    empty, filled = tables.graded("support_tickets"), tables.graded("loyalty_accounts")
    assert empty.count() == 0 and filled.count() > 0
    assert empty.columns[:2] == ["customer_id", "ticket_id"]
    assert empty.columns[-4:] == [
        "customer_exists", "_has_future_ticket_date", "_is_valid", "_rejection_reason",
    ]
    kpis = spark.read.parquet(f"{folder}/gold/kpi_summary").first()
    assert kpis["open_support_tickets"] == 0 and kpis["customers_with_support_tickets"] == 0
    quality = spark.read.parquet(f"{folder}/gold/dq_summary")
    row = quality.where("source_name = 'support_tickets'").first()
    assert tuple(row)[1:6] == (0, 0, 0, 0, None)


def test_new_files_only(spark, folder):
    call(spark, folder, "generate", "--customers", "50")
    call(spark, folder, "ingest", "--new-files-only")
    size = spark.read.parquet(f"{folder}/bronze/orders").count()
    call(spark, folder, "ingest", "--new-files-only")
    assert spark.read.parquet(f"{folder}/bronze/orders").count() == size > 0


def test_running_over_new_files_leaves_bronze_alone(spark, folder):
    call(spark, folder, "generate", "--customers", "50")
    call(spark, folder, "run", "--new-files-only")
    before = quality_of(spark, folder)
    call(spark, folder, "run", "--new-files-only")
    after = quality_of(spark, folder)
    assert {n: tuple(r)[1:6] for n, r in before.items()} == {
        n: tuple(r)[1:6] for n, r in after.items()
    }
    call(spark, folder, "generate", "--customers", "20")
    call(spark, folder, "run", "--new-files-only")
    assert quality_of(spark, folder)["customers"]["bronze_rows"] > (
        before["customers"]["bronze_rows"]
    )


def test_job_is_required_and_tables_must_be_known(capsys):
    with pytest.raises(SystemExit):
        arguments(["--root", "x"])
    with pytest.raises(SystemExit):
        arguments(["--root", "x", "refine", "orders", "nothing"])
    assert "nothing" in capsys.readouterr().err


def test_a_run_folder_is_removed_by_its_owner(spark, folder):
    root = new_run_root(spark, "mine")
    spark.range(3).write.parquet(f"{root}/table")
    release_run(spark, root)
    assert not exists(spark, root)
    with pytest.raises(ValueError, match="no run folder"):
        release_run(spark, folder)


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://somewhere:7077"

            @staticmethod
            def getConf():
                return Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session())


def test_run_folders_are_below_the_shared_folder(spark):
    root = shared_root(spark)
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    assert named is None or root == named.rstrip("/")
    one, two = new_run_root(spark, "x"), new_run_root(spark, "x")
    assert one != two and one.startswith(f"{root}/")
