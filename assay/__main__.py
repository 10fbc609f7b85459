"""Command line: one job per call, over the layers below ``--root``.

    python -m assay --root data generate --customers 100000
    python -m assay --root data ingest
    python -m assay --root data inspect
    python -m assay --root data refine [table ...]
    python -m assay --root data summarise
    python -m assay --root data run [--new-files-only]
    python -m assay --root data refresh
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from assay.plans import gold
from assay.plans.bronze import inspect_bronze
from assay.plans.clock import Clock
from assay.plans.generate import land_generated, people_from_range
from assay.plans.medallion import (
    ALL, Layout, bronze_tables, ingest_landed, refine_bronze, run, run_refresh,
)
from assay.plans.quarantine import malformed_counts
from assay.plans.refresh import SHARDS
from assay.plans.silver import SilverTables
from assay.session import build_session
from assay.sources.specs import REPORTED
from assay.sources.tables import read_table


def arguments(words: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="assay", description="Customer-data refinery on Spark")
    parser.add_argument("--root", required=True, help="folder of all layers, on shared storage")
    parser.add_argument("--master", help="Spark master; spark-submit sets its own")
    parser.add_argument("--as-of", type=date.fromisoformat, help="processing day, default today")
    parser.add_argument(
        "--versioned", action="store_true", help="publish silver and gold as versions"
    )
    jobs = parser.add_subparsers(dest="job", required=True)
    generate = jobs.add_parser("generate", help="land one dirty drop of every feed")
    generate.add_argument("--customers", type=int, default=100_000)
    ingest = jobs.add_parser("ingest", help="append the landed feeds to bronze")
    ingest.add_argument("--new-files-only", action="store_true", help="read each file once")
    jobs.add_parser("inspect", help="schema, size and five rows of bronze")
    refine = jobs.add_parser("refine", help="write silver tables")
    refine.add_argument("tables", nargs="*", metavar="table", help=", ".join(ALL))
    jobs.add_parser("summarise", help="write and show the gold tables")
    whole = jobs.add_parser("run", help="ingest, refine and summarise")
    whole.add_argument("--new-files-only", action="store_true", help="read each file once")
    changed = jobs.add_parser("refresh", help="the same over new files and changed keys only")
    changed.add_argument("--shards", type=int, default=SHARDS, help="of the first refresh")
    options = parser.parse_args(words)
    unknown = sorted(set(getattr(options, "tables", ())) - set(ALL))
    if unknown:
        refine.error(f"no table {', '.join(unknown)} (choose from {', '.join(ALL)})")
    return options


def show(rows: DataFrame) -> None:
    """Print a report with every row it has; reports have a row per source or column."""
    rows.show(max(1, rows.count()), truncate=False)


def show_gold(spark: SparkSession, layout: Layout) -> None:
    show(read_table(spark, f"{layout.gold}/kpi_summary"))
    show(read_table(spark, f"{layout.gold}/dq_summary").orderBy("source_name"))


def execute(spark: SparkSession, options: argparse.Namespace) -> None:
    layout = Layout(options.root.rstrip("/"), options.versioned)
    clock = Clock(options.as_of)
    if options.job == "generate":
        people = people_from_range(spark, options.customers)
        land_generated(people, layout.landing, datetime.now(), clock)
    elif options.job == "ingest":
        ingest_landed(spark, layout, clock, options.new_files_only)
    elif options.job == "inspect":
        profile, rows = inspect_bronze(spark, layout.bronze)
        show(profile.orderBy("table_name", "position"))
        show(rows)
    elif options.job == "refine":
        names = options.tables or ALL
        tables = refine_bronze(spark, layout, clock, names)
        specs = [spec for spec in REPORTED if spec.name in names]
        feeds = bronze_tables(spark, layout, names)
        malformed = malformed_counts(spark, layout.bronze, specs)
        show(gold.run_report(spark, feeds, tables, specs, malformed).orderBy("source_name"))
    elif options.job == "summarise":
        tables = SilverTables(spark, layout.silver)
        gold.write_gold(spark, layout.bronze, tables, layout.gold, clock, layout.versioned)
        show_gold(spark, layout)
    elif options.job == "refresh":
        run_refresh(spark, layout, clock, options.shards)
        show_gold(spark, layout)
    else:
        run(spark, layout, clock, options.new_files_only)
        show_gold(spark, layout)


def main() -> None:
    options = arguments()
    spark = build_session(f"assay {options.job}", options.master)
    try:
        execute(spark, options)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
