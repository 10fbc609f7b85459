"""Silver and facts over changed keys: equal to the whole refinement, and no more work than due."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from assay.__main__ import arguments, execute
from assay.plans import gold, refresh as refreshing
from assay.plans.clock import Clock
from assay.plans.customer_facts import snapshot_from_facts
from assay.plans.medallion import Layout, refine_bronze, refresh
from assay.sources import shards as sharding
from assay.sources.folders import exists
from assay.sources.specs import BY_NAME, SOURCES
from assay.sources.tables import write_drop
from assay.streaming.ingest import ingest_new

NAMES = [spec.name for spec in SOURCES]
CLOCK = Clock(date(2024, 1, 25))
SOUND = {
    "customers": {"first_name": "Ann", "last_name": "Lee", "email": "a@b.com", "status": "active",
                  "gender": "female", "signup_date": "2020-01-01"},
    "orders": {"order_date": "2023-01-01", "order_status": "COMPLETED", "order_amount": 10.0,
               "currency": "AUD", "sales_channel": "WEB"},
    "addresses": {"state": "NSW", "postcode": "2000", "country": "australia", "is_primary": "true"},
    "payments": {"payment_date": "2023-01-02", "payment_status": "SUCCESS",
                 "payment_method": "CARD", "payment_amount": 10.0},
    "support_tickets": {"ticket_status": "OPEN", "priority": "LOW", "channel": "EMAIL",
                        "category": "OTHER"},
    "loyalty_accounts": {"join_date": "2022-01-01", "tier": "GOLD", "points_balance": 5,
                         "loyalty_status": "ACTIVE"},
}


def sound_values():
    """Values that pass the rules of every feed, whatever its domains are called."""
    from assay.operators.quality import OneOf
    for spec in SOURCES:
        for rule in spec.rules:
            if isinstance(rule, OneOf):
                SOUND[spec.name].setdefault(rule.column, rule.domain[0])
                if SOUND[spec.name][rule.column] not in rule.domain:
                    SOUND[spec.name][rule.column] = rule.domain[0]


sound_values()


def feed(spark, name, rows):
    """Rows given as (key, customer, version day, other values)."""
    spec, made = BY_NAME[name], []
    for key, customer, day, values in rows:
        row = dict.fromkeys(spec.columns) | SOUND[name] | {"customer_id": customer, spec.key: key}
        row |= {spec.order_column: day} | values
        made.append(tuple(row[column] for column in spec.columns))
    return spark.createDataFrame(made, spec.schema)


def land(spark, layout, day, drops, names=NAMES):
    for name in names:
        spec = BY_NAME[name]
        if name in drops:
            rows = feed(spark, name, drops[name])
            write_drop(rows, layout.landing, spec.feed, datetime(2024, 1, day))
            ingest_new(spark, spec, layout.landing, layout.bronze, layout.manifests,
                       layout.ingestion_log, CLOCK)


FIRST = {
    "customers": [("A", "A", "2023-01-01", {}), ("B", "B", "2023-01-01", {"email": "broken"}),
                  ("C", "C", "2023-01-01", {}), (None, None, "2023-01-01", {})],
    "orders": [("O1", "A", "2023-01-01", {}), ("O2", "B", "2023-01-01", {}),
               ("O3", "C", "2023-01-01", {"order_amount": 30.0}), ("O4", "D", "2023-01-01", {}),
               ("O5", "C", "2023-02-01", {}), (None, "C", "2023-01-01", {}),
               ("O6", None, "2023-01-01", {})],
    "addresses": [("X1", "A", "2023-01-01", {}), ("X2", "C", "2023-01-01", {}),
                  ("X3", "C", "2023-03-01", {"postcode": "3000"})],
    "payments": [(f"P{i}", c, "2023-01-01", {"order_id": f"O{i}"})
                 for i, c in ((1, "A"), (2, "B"), (3, "C"), (4, "D"), (5, "C"))],
    "support_tickets": [("T1", "A", "2023-01-01", {}), ("T2", "D", "2023-01-01", {})],
    "loyalty_accounts": [("L1", "C", "2023-01-01", {}), ("L2", "B", "2023-01-01", {})],
}
SECOND = {
    # A turns invalid, B valid, D appears, C stays; a version older than C's loses.
    "customers": [("A", "A", "2023-06-01", {"email": "broken"}), ("B", "B", "2023-06-01", {}),
                  ("D", "D", "2023-06-01", {}), ("C", "C", "2022-01-01", {"status": "blocked"}),
                  (None, None, "2023-07-01", {})],
    # O3 moves to another customer, the latest order of C is cancelled away to a bad amount.
    "orders": [("O3", "B", "2023-06-01", {"order_amount": 31.0}),
               ("O5", "C", "2023-06-01", {"order_amount": -1.0}), ("O7", "C", "2023-06-01", {})],
    "addresses": [("X3", "C", "2023-06-01", {"is_primary": "false"})],
    "support_tickets": [("T3", "C", "2023-06-01", {})],
}


def rows_of(df, *without):
    return sorted(map(repr, df.drop("_source_file", *without).collect()))


def check_equal_to_whole(spark, layout, silver, facts, names=NAMES):
    whole = refine_bronze(spark, layout, CLOCK, names)
    for name in names:
        assert silver.graded(name).columns == whole.graded(name).columns
        assert rows_of(silver.graded(name)) == rows_of(whole.graded(name)), name
        mine = gold.SIDES[name](whole.valid(name))
        assert rows_of(facts.read(name)) == rows_of(mine), name
    if names == NAMES:
        snapshot = gold.customer_snapshot({n: whole.valid(n) for n in NAMES}, CLOCK)
        assert rows_of(snapshot_from_facts(facts, CLOCK)) == rows_of(snapshot)
    return whole


@pytest.fixture
def layout(folder):
    return Layout(folder)


def test_replaced_versions_and_turned_parents(spark, layout):
    land(spark, layout, 1, FIRST)
    tables = refresh(spark, layout, CLOCK, shards=4)
    check_equal_to_whole(spark, layout, *tables)
    land(spark, layout, 2, SECOND)
    silver, facts = refresh(spark, layout, CLOCK, shards=9)
    assert silver.shards == 4 and facts.buckets == 4
    whole = check_equal_to_whole(spark, layout, silver, facts)
    valid = {r["payment_id"] for r in whole.valid("payments").collect()}
    assert valid == {"P2", "P3", "P4"}
    counts = {r["customer_id"]: r["total_orders"] for r in facts.read("orders").collect()}
    assert counts == {"B": 2, "C": 1, "D": 1}
    # Older versions that come last change nothing but the log.
    land(spark, layout, 3, {"orders": FIRST["orders"], "customers": FIRST["customers"]})
    check_equal_to_whole(
        spark, layout, *refresh(spark, layout, CLOCK), ["customers", "orders"]
    )


def files_of(spark, path):
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return {r["path"] for r in rows.select("path").collect()}


def shard_folder(path):
    return path.split("/_shard=")[1].split("/")[0]


def test_only_touched_shards_are_written(spark, layout):
    many = {"customers": [(f"C{i}", f"C{i}", "2023-01-01", {}) for i in range(400)],
            "orders": [(f"O{i}", f"C{i % 400}", "2023-01-01", {}) for i in range(800)]}
    land(spark, layout, 1, many, ["customers", "orders"])
    silver, _ = refresh(spark, layout, CLOCK, shards=32)
    before = {name: files_of(spark, silver.path(name)) for name in many}
    assert {shard_folder(p) for p in before["orders"]} == {str(i) for i in range(32)}
    # One order anew, and one customer whose two orders turn invalid with it.
    land(spark, layout, 2, {
        "customers": [("C7", "C7", "2023-02-01", {"email": "broken"})],
        "orders": [("O3", "C3", "2023-02-01", {"order_amount": 5.0})],
    }, ["customers", "orders"])
    silver, _ = refresh(spark, layout, CLOCK)
    after = {name: files_of(spark, silver.path(name)) for name in many}

    def shard(key):
        return spark.range(1).select(F.pmod(F.hash(F.lit(key)), F.lit(32))).first()[0]

    written = {name: {shard_folder(p) for p in after[name] - before[name]} for name in many}
    assert written["customers"] == {str(shard("C7"))}
    assert written["orders"] == {str(shard(key)) for key in ("O3", "O7", "O407")}
    for name in many:
        kept = {p for p in before[name] if shard_folder(p) not in written[name]}
        assert kept <= after[name]
    assert silver.rejected("orders").count() == 2
    # Nothing new: nothing is written.
    refresh(spark, layout, CLOCK)
    assert all(files_of(spark, silver.path(name)) == after[name] for name in many)


class Died(Exception):
    pass


@pytest.mark.parametrize("place", ["before_ready", "between_shards", "before_log"])
def test_a_run_that_died_is_made_good(spark, layout, monkeypatch, place):
    names = ["customers", "orders"]
    land(spark, layout, 1, FIRST, names)
    refresh(spark, layout, CLOCK, shards=4)
    land(spark, layout, 2, SECOND, names)

    def die(*_):
        raise Died

    with monkeypatch.context() as broken:
        if place == "before_ready":
            broken.setattr(sharding, "move", die)
        elif place == "between_shards":
            moves = []
            move = sharding.move

            def few(spark, source, target):
                moves.append(source)
                if len(moves) > 2:
                    raise Died
                move(spark, source, target)

            broken.setattr(sharding, "move", few)
        else:
            append = refreshing.RefreshLog.append
            broken.setattr(
                refreshing.RefreshLog, "append",
                lambda log, owner, events: append(log, owner, events)
                if events[0][0] == "changed" else die(),
            )
        with pytest.raises(Died):
            refresh(spark, layout, CLOCK)
    silver, facts = refresh(spark, layout, CLOCK)
    check_equal_to_whole(spark, layout, silver, facts, names)
    for name in names:
        assert not exists(spark, sharding.ready_folder(silver.path(name)))


def test_rolling_forward_twice_keeps_what_was_moved(spark, folder):
    path = f"{folder}/table"
    rows = spark.range(20).select(F.col("id").alias("k"), F.lit(True).alias("_is_valid"))
    sharding.create_shards(sharding.in_shards(rows, "k", 4), path, 4)
    newer = sharding.in_shards(rows.where("k < 3"), "k", 4)
    sharding.replace_shards(newer, path, range(4))
    assert not sharding.roll_forward(spark, path)
    assert {r["k"] for r in spark.read.parquet(path).collect()} == {0, 1, 2}


def test_snapshot_of_facts_needs_no_shuffle(spark, layout, plan_of):
    land(spark, layout, 1, FIRST)
    _, facts = refresh(spark, layout, CLOCK, shards=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        snapshot = snapshot_from_facts(facts, CLOCK)
        plan = plan_of(snapshot)
        assert "Exchange" not in plan and plan.count("Join") == 5 and "Bucketed: true" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in NAMES:
        buckets = {path.rsplit("_", 1)[1] for path in files_of(spark, facts.path(name))}
        assert len(buckets) == len(files_of(spark, facts.path(name)))


def test_new_batches_skip_the_files_of_old_ones(spark, layout, plan_of):
    land(spark, layout, 1, FIRST)
    land(spark, layout, 2, SECOND)
    rows = spark.read.parquet(f"{layout.bronze}/orders").where(F.col("_batch_id").isin(["x"]))
    assert "PushedFilters: [In(_batch_id, [x])" in plan_of(rows) or "EqualTo(_batch_id,x)" in plan_of(rows)


def test_command_line(spark, folder, capsys):
    def call(*words):
        execute(spark, arguments(["--root", folder, "--as-of", "2024-01-25", *words]))

    call("generate", "--customers", "60")
    call("refresh", "--shards", "3")
    call("generate", "--customers", "60")
    call("refresh")
    assert "total_customers" in capsys.readouterr().out
    kpis = spark.read.parquet(f"{folder}/gold/kpi_summary").drop("_gold_processed_at").collect()
    call("refine")
    call("summarise")
    again = spark.read.parquet(f"{folder}/gold/kpi_summary").drop("_gold_processed_at").collect()
    for ours, theirs in zip(kpis[0], again[0], strict=True):
        assert ours == pytest.approx(theirs)
