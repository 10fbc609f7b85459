"""Plans and hot keys: what must hold when the tables are large."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from assay.functions.cleaning import dated
from assay.operators.dedup import descending, first_per_key, latest_per_key
from assay.operators.references import flag_existing, orphans
from assay.operators.summaries import order_summary
from assay.plans import gold, silver
from assay.plans.clock import Clock
from assay.session import SETTINGS, new_run_root, written
from assay.sources.specs import BY_NAME, SOURCES
from assay.sources.tables import read_graded, write_graded, write_table
from checks import queries as registered
from checks.feeds import landing_feed

ROWS = 60_000


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(params=["SortMergeJoin", "ShuffledHashJoin"])
def small_skew_threshold(spark, request):
    hash_limit = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    settings = {
        hash_limit: "0" if request.param == "SortMergeJoin" else SETTINGS[hash_limit],
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield f"{request.param}(skew=true)"
    for key in settings:
        if key in SETTINGS:
            spark.conf.set(key, SETTINGS[key])
        else:
            spark.conf.unset(key)


def hot_children(spark, hot):
    """A third of the rows share one parent (or NULL); the rest spread over 500 parents."""
    number = F.col("id")
    key = F.when(number % 3 == 0, hot).otherwise(F.concat(F.lit("P"), number % 500))
    return spark.range(0, ROWS, 1, 8).select(
        number.alias("child"), key.alias("parent_id"), F.sha2(number.cast("string"), 256).alias("x")
    )


@pytest.mark.parametrize("hot", ["P7", None])
def test_hot_parent_is_split_and_rows_stay_whole(
    spark, no_broadcast, small_skew_threshold, plan_of, hot
):
    parents = written(
        spark.range(0, 400).select(F.concat(F.lit("P"), "id").alias("parent_id")),
        new_run_root(spark, "parents"),
    )
    children = hot_children(spark, F.lit(hot).cast("string"))
    flagged = flag_existing(children, parents, "parent_id", "found", parent_is_unique=True)
    plan = plan_of(flagged, final=True)
    assert small_skew_threshold in plan

    found = flagged.agg(F.count("*").alias("n"), F.count("found").alias("found")).first()
    hot_rows = 0 if hot is None else ROWS // 3
    spread = spark.range(0, ROWS).where("id % 3 != 0 AND id % 500 < 400").count()
    assert (found["n"], found["found"]) == (ROWS, hot_rows + spread)


def test_hot_customer_and_hot_order_of_payments_are_both_split(
    spark, no_broadcast, small_skew_threshold, plan_of
):
    spec, number = BY_NAME["payments"], F.col("id")
    text = {
        "payment_id": F.concat(F.lit("PAY"), number),
        "order_id": F.when(number % 3 == 0, "ORD1").otherwise(F.concat(F.lit("ORD"), number % 900)),
        "customer_id": F.when(number % 3 == 1, "CRM1").otherwise(
            F.concat(F.lit("CRM"), number % 700)
        ),
        "payment_date": F.lit("2024-01-01"),
        "payment_status": F.lit(" success"),
        "payment_method": F.lit("card"),
        "payment_amount": number + 0.5,
        "created_at": F.sha2(number.cast("string"), 256),
        "source_system": F.sha2((-number).cast("string"), 256),
    }
    bronze = spark.range(0, ROWS, 1, 8).select(*[
        text.get(c.name, F.lit(None)).cast(c.dataType).alias(c.name) for c in spec.schema
    ])
    root = new_run_root(spark, "parents")
    ids = spark.range(0, 600)
    parents = {
        "customers": written(
            ids.select(F.concat(F.lit("CRM"), "id").alias("customer_id")), f"{root}/customers"
        ),
        "orders": written(
            ids.select(F.concat(F.lit("ORD"), "id").alias("order_id")), f"{root}/orders"
        ),
    }
    graded = silver.refine(bronze, spec, parents, Clock())
    plan = plan_of(graded, final=True)
    plan = plan[:plan.index("Initial Plan")]
    assert plan.count(small_skew_threshold) == 2
    assert graded.count() == ROWS

    both = "(id % 3 = 0 OR id % 900 < 600) AND (id % 3 = 1 OR id % 700 < 600)"
    valid = spark.range(0, ROWS).where(both).count()
    assert graded.where("_is_valid").count() == valid


def test_repeated_parents_do_not_repeat_children(spark):
    children = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "child INT, k STRING")
    parents = spark.createDataFrame([("a",), ("a",), (None,)], "k STRING")
    rows = flag_existing(children, parents, "k", "found").orderBy("child").collect()
    assert [tuple(row) for row in rows] == [("a", 1, True), ("b", 2, None), (None, 3, None)]
    assert [row["child"] for row in orphans(children, parents, "k").collect()] == [2]


def test_hot_key_is_reduced_before_the_shuffle(spark, plan_of):
    rows = spark.range(0, ROWS, 1, 8).select(
        F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("k"),
        (F.col("id") % 1000).alias("version"), F.col("id").alias("x"),
    )
    latest = latest_per_key(rows, "k", "version", ["k", "version", "x"])
    plan = plan_of(latest)
    partial, exchange = plan.index("Partial"), plan.index("Exchange")
    assert "WindowGroupLimit" in plan and exchange < partial
    assert latest.count() == ROWS - ROWS // 3 + 1
    hot = latest.where(F.col("k").isNull()).first()
    assert (hot["version"], hot["x"]) == (999, max(i for i in range(0, ROWS, 3) if i % 1000 == 999))


def test_latest_breaks_ties_by_the_remaining_columns(spark):
    rows = spark.createDataFrame(
        [("a", None, 9), ("a", 1, 1), ("a", 1, 3), ("a", 1, None), (None, 1, 1), (None, 2, 0)],
        "k STRING, version INT, x INT",
    )
    kept = latest_per_key(rows, "k", "version", ["k", "version", "x"])
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        [("a", 1, 3), (None, 2, 0)], key=str
    )
    first = first_per_key(rows, ["k"], descending(["x"]))
    assert {tuple(r) for r in first.collect()} == {("a", None, 9), (None, 1, 1)}


def test_summaries_aggregate_before_the_shuffle(spark, sf_dir, plan_of):
    orders = landing_feed(spark, sf_dir, "orders").withColumn("order_date", dated("order_date"))
    plan = plan_of(order_summary(orders))
    assert plan.index("Exchange") < plan.index("partial_sum")


def test_snapshot_shuffles_each_input_once(spark, sf_dir, no_broadcast, plan_of):
    tables = registered._silver(spark, sf_dir)
    snapshot = gold.customer_snapshot({spec.name: tables.valid(spec.name) for spec in SOURCES})
    plan = plan_of(snapshot)
    assert plan.count("Exchange hashpartitioning") == 6
    assert "PartitionFilters: [isnotnull(_is_valid" in plan
    assert "phone" not in plan and "_record_hash" not in plan


def test_valid_side_reads_only_its_files(spark, sf_dir):
    tables = silver.SilverTables(spark, new_run_root(spark, "silver"))
    feeds = {"customers": landing_feed(spark, sf_dir, "customers")}
    silver.refine_all(feeds, tables, registered.CLOCKS)
    files = {row[0] for row in tables.valid("customers").select("_metadata.file_path").collect()}
    assert files and all("_is_valid=true" in path for path in files)
    assert tables.valid("customers").count() + tables.rejected("customers").count() == 150


def test_no_query_uses_python_rows_or_a_cross_join(spark, sf_dir, plan_of):
    for name in ("silver_payments", "customer_snapshot", "dq_summary", "gen_payments",
                 "feed_customers", "feed_payments", "run_report"):
        plan = plan_of(registered.all_queries()[name](spark, sf_dir))
        for bad in ("CartesianProduct", "NestedLoop", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in plan, (name, bad)


def last_plan(spark):
    """Physical plan of the last execution that wrote files."""
    listed = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [listed.apply(i).physicalPlanDescription() for i in range(listed.size())]
    return [plan for plan in plans if "InsertIntoHadoopFsRelationCommand" in plan][-1]


def test_silver_is_written_without_a_sort(spark, sf_dir, folder):
    feed = landing_feed(spark, sf_dir, "customers")
    graded = silver.refine(feed, BY_NAME["customers"], {}, Clock())
    write_graded(graded, f"{folder}/silver")
    plan = last_plan(spark).split("Initial Plan")[0]
    top = plan[plan.index("InsertIntoHadoopFsRelationCommand"):]
    before_window = top[: top.index("Window")]
    assert "Sort" not in before_window


def test_a_failing_write_leaves_the_old_table(spark, folder):
    """The error comes while files are being written; the table is whole, its neighbours clean."""
    path = f"{folder}/orders"
    good = spark.range(0, 100).select("id", (F.col("id") % 2 == 0).alias("_is_valid"))
    write_graded(good, path)
    bad = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")).alias(
            "id"
        ),
        F.lit(True).alias("_is_valid"),
    )
    with pytest.raises(Exception, match="broken row"):
        write_graded(bad, path)
    assert read_graded(spark, path, good.schema).count() == 100
    with pytest.raises(Exception, match="broken row"):
        write_table(bad, path)
    assert read_graded(spark, path, good.schema).count() == 100
    assert [p.name for p in Path(folder).iterdir()] == ["orders"]
    write_graded(good.limit(0), path)
    assert read_graded(spark, path, good.schema).count() == 0
    Path(path, "_SUCCESS").unlink()
    with pytest.raises(FileNotFoundError, match="no committed table"):
        read_graded(spark, path, good.schema)


def test_rejected_files_follow_their_size(spark, folder):
    """Ninety tasks leave ninety rejected files, which are packed before they are published."""
    rows = spark.range(0, 9000, 1, 90).select("id", (F.col("id") % 10 > 0).alias("_is_valid"))
    write_graded(rows, f"{folder}/table")
    files = list(Path(folder, "table", "_is_valid=false").glob("*.parquet"))
    assert len(files) == 1
    sides = read_graded(spark, f"{folder}/table", rows.schema).groupBy("_is_valid").count()
    assert {r["_is_valid"]: r["count"] for r in sides.collect()} == {True: 8100, False: 900}


def test_columns_are_pruned_to_the_lookup_key(spark, sf_dir, no_broadcast, plan_of):
    tables = silver.SilverTables(spark, new_run_root(spark, "silver"))
    silver.refine_all(
        {"customers": landing_feed(spark, sf_dir, "customers")}, tables, registered.CLOCKS
    )
    spec = BY_NAME["orders"]
    graded = silver.refine(
        landing_feed(spark, sf_dir, "orders"), spec, {"customers": tables.valid("customers")},
        Clock(),
    )
    assert "ReadSchema: struct<customer_id:string>" in plan_of(graded)
