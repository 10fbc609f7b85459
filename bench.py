"""Times every job of a full run over feeds derived from the given tables; prints one JSON line.

The feeds are landed as CSV first, which is not timed. Each job then reads what the job before
it wrote and writes its own tables, as in production. A first run warms the session up; the
second is reported. ``whole_run`` is the wall time of the run a user makes, in which tables that
do not depend on each other are refined side by side. ``refresh`` times the same tables over changed
keys: the first build, silver and facts after a second drop of every hundredth key, and the
snapshot from the facts. Neither is part of ``value``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from assay.plans import gold  # noqa: E402
from assay.plans.bronze import ingest  # noqa: E402
from assay.plans.customer_facts import CustomerFacts, snapshot_from_facts  # noqa: E402
from assay.plans.medallion import Layout, refresh, run  # noqa: E402
from assay.plans.silver import WAVES, SilverTables, refine_table  # noqa: E402
from assay.session import build_session, new_run_root, release_run  # noqa: E402
from assay.sources.specs import REPORTED, SOURCES  # noqa: E402
from assay.sources.tables import write_drop, write_table  # noqa: E402
from assay.streaming.ingest import ingest_new  # noqa: E402
from checks.feeds import landing_feed  # noqa: E402
from checks.queries import CLOCKS, DAY  # noqa: E402


def timed(seconds: dict[str, float], name: str, job: Callable[[], object]) -> None:
    started = time.perf_counter()
    job()
    seconds[name] = round(time.perf_counter() - started, 3)


def run_jobs(spark: SparkSession, landing: str) -> dict[str, float]:
    seconds: dict[str, float] = {}
    root = new_run_root(spark, "bench")
    layout = Layout(root)
    for spec in SOURCES:
        timed(seconds, f"bronze_{spec.name}", lambda: ingest(
            spark, spec, landing, layout.bronze, layout.ingestion_log, DAY
        ))
    silver = SilverTables(spark, layout.silver)
    for spec in (spec for wave in WAVES for spec in wave):
        timed(seconds, f"silver_{spec.name}", lambda: refine_table(
            spark.read.parquet(f"{layout.bronze}/{spec.feed}"), spec, silver, CLOCKS[spec.name]
        ))
    valid = {spec.name: silver.valid(spec.name) for spec in REPORTED}
    snapshot = f"{layout.gold}/customer_snapshot"
    timed(seconds, "customer_snapshot", lambda: write_table(
        gold.customer_snapshot(valid, DAY), snapshot
    ))
    timed(seconds, "kpi_summary", lambda: write_table(
        gold.kpi_summary(spark.read.parquet(snapshot), DAY), f"{layout.gold}/kpi_summary"
    ))
    timed(seconds, "dq_summary", lambda: write_table(
        gold.dq_summary(
            gold.quality_counts(spark, gold.dq_tables(spark, layout.bronze, silver)), DAY
        ),
        f"{layout.gold}/dq_summary",
    ))
    release_run(spark, root)
    return seconds


def whole_run(spark: SparkSession, landing_root: str) -> float:
    started = time.perf_counter()
    run(spark, Layout(landing_root), DAY)
    return round(time.perf_counter() - started, 3)


def refreshes(spark: SparkSession, sf_dir: str, root: str) -> dict[str, float]:
    """Times of refreshing a folder that ``whole_run`` has ingested."""
    seconds: dict[str, float] = {}
    layout = Layout(root)

    def bring() -> None:
        refresh(spark, layout, clocks=CLOCKS, shards=32)

    timed(seconds, "build", bring)
    for spec in SOURCES:
        feed = landing_feed(spark, sf_dir, spec.name)
        drop = feed.where(F.pmod(F.xxhash64(spec.key), F.lit(100)) == 0)
        write_drop(drop, layout.landing, spec.feed, datetime(2001, 6, 2))
        ingest_new(
            spark, spec, layout.landing, layout.bronze, layout.manifests, layout.ingestion_log, DAY
        )
    timed(seconds, "one_percent", bring)
    facts = CustomerFacts(spark, layout.customer_facts)
    timed(seconds, "snapshot", lambda: write_table(
        snapshot_from_facts(facts, DAY), f"{layout.gold}/customer_snapshot"
    ))
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus, spark_ui_enabled="false", spark_driver_memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    landed = new_run_root(spark, "landing")
    landing = f"{landed}/landing"
    for spec in SOURCES:
        write_drop(landing_feed(spark, sf_dir, spec.name), landing, spec.feed, datetime(2001, 6, 1))
    run_jobs(spark, landing)
    seconds = run_jobs(spark, landing)
    whole = whole_run(spark, landed)
    refreshed = refreshes(spark, sf_dir, landed)
    release_run(spark, landed)
    print(json.dumps({
        "metric": "full_run_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "whole_run": whole,
        "refresh": refreshed,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
