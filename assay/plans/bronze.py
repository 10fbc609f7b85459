"""Landing CSV to bronze Parquet, with audit columns and a run log."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assay.functions.hashing import record_hash
from assay.plans.clock import NOW, Clock
from assay.plans.quarantine import quarantine_batch
from assay.sources.fixed_values import INGESTION_LOG_SCHEMA
from assay.sources.manifest import Manifest, landed_files
from assay.sources.sinks import save
from assay.sources.specs import SOURCES, SourceSpec
from assay.sources.tables import (
    RECORD_TEXT, append_packed, feed_glob, literal_path, preview, read_csv, table_profile,
)

AUDIT_COLUMNS = ("_ingestion_timestamp", "_source_file", "_batch_id", "_record_hash")


def with_audit(
    feed: DataFrame, batch_id: str, clock: Clock = NOW, columns: Sequence[str] | None = None
) -> DataFrame:
    """Audit columns of rows read from files."""
    return with_audit_columns(feed, F.col("_metadata.file_path"), batch_id, clock, columns)


def with_audit_columns(
    rows: DataFrame, source_file: Column | None = None, batch_id: str = "", clock: Clock = NOW,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Add ingestion time, source file, batch and a hash over all business columns, which are all
    columns if not named."""
    source_file = F.lit(None).cast("string") if source_file is None else source_file
    columns = rows.columns if columns is None else columns
    return rows.select(
        *columns,
        clock.now().alias("_ingestion_timestamp"),
        source_file.alias("_source_file"),
        F.lit(batch_id).alias("_batch_id"),
        record_hash(columns).alias("_record_hash"),
    )


def log_run(spark: SparkSession, log_path: str, **record: object) -> None:
    """Append one run to the ingestion log; unnamed columns are NULL."""
    schema = StructType.fromDDL(INGESTION_LOG_SCHEMA)
    row = tuple(record.get(name) for name in schema.fieldNames())
    append_packed(spark.createDataFrame([row], schema).coalesce(1), log_path)


def logged(
    spark: SparkSession, log_path: str, feed: str, batch_id: str, job: Callable[[], int]
) -> int:
    """Run ``job``, which returns the rows it moved, and log how it went.

    A failure is logged with zero rows and raised again, so later feeds do not run on a broken
    landing zone.
    """
    start_time, started = datetime.now(), time.monotonic()
    rows, failure = 0, None
    try:
        rows = job()
    except Exception as error:
        failure = error
    log_run(
        spark, log_path, run_id=str(uuid.uuid4()), source_name=feed, batch_id=batch_id,
        rows_read=rows, rows_written=rows, start_time=start_time, end_time=datetime.now(),
        duration_seconds=round(time.monotonic() - started, 2),
        status="FAILED" if failure else "SUCCESS",
        error_message=str(failure) if failure else None,
    )
    if failure:
        raise failure
    return rows


def append_rows(
    feed: DataFrame, target: str, batch_id: str, clock: Clock = NOW
) -> tuple[int, int]:
    """Append a feed's rows with their audit columns to a bronze table, in one commit.

    The feed is scanned once: its rows, and among them those that do not fit the schema, are
    counted by an observation while they are written.
    """
    seen, columns = Observation(), [name for name in feed.columns if name != RECORD_TEXT]
    misfit = F.col(RECORD_TEXT).isNotNull() if RECORD_TEXT in feed.columns else F.lit(False)
    counted = feed.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(misfit).alias("misfits")
    )
    rows = with_audit(counted, batch_id, clock, columns)
    save(rows, target, "append")
    return seen.get["rows"], seen.get["misfits"]


def append_files(
    spark: SparkSession, spec: SourceSpec, files: DataFrame, bronze: str, batch_id: str,
    clock: Clock, manifest: Manifest,
) -> int:
    """Append the rows of listed files and enter the files in the manifest."""
    manifest.plan(files, batch_id)
    # The driver lists a folder's files for any scan; here it lists those of the batch alone.
    paths = batch_paths(manifest, batch_id)
    if not paths:
        return 0
    rows = append_drop(spark, spec, paths, bronze, batch_id, clock)
    manifest.finish(batch_id)
    return rows


def batch_paths(manifest: Manifest, batch_id: str) -> list[str]:
    return [
        literal_path(row["path"]) for row in manifest.batch_files(batch_id).select("path").collect()
    ]


def append_drop(
    spark: SparkSession, spec: SourceSpec, paths: str | list[str], bronze: str, batch_id: str,
    clock: Clock,
) -> int:
    """Append the rows of some paths to bronze, and their malformed cells to the quarantine."""
    feed = read_csv(spark, paths, spec.schema, with_text=True)
    rows, misfits = append_rows(feed, f"{bronze}/{spec.feed}", batch_id, clock)
    if misfits:
        quarantine_batch(spark, spec, paths, bronze, batch_id, clock)
    return rows


def ingest(
    spark: SparkSession,
    spec: SourceSpec,
    landing: str,
    bronze: str,
    log_path: str,
    clock: Clock = NOW,
    batch_id: str | None = None,
    manifests: str | None = None,
) -> int:
    """Append every landed row of one feed to bronze, log the run, return the row count.

    Every run reads all landed files again, so bronze grows by the landing history. With
    ``manifests`` the files are entered there, and a later run over new files leaves them out.
    """
    batch_id = batch_id or str(uuid.uuid4())

    def append() -> int:
        if manifests is None:
            paths = feed_glob(landing, spec.feed)
            return append_drop(spark, spec, paths, bronze, batch_id, clock)
        landed = landed_files(spark, landing, spec.feed)
        manifest = Manifest(spark, manifests, spec.feed)
        return append_files(spark, spec, landed, bronze, batch_id, clock, manifest)

    return logged(spark, log_path, spec.feed, batch_id, append)


def ingest_all(
    spark: SparkSession,
    landing: str,
    bronze: str,
    log_path: str,
    specs: Iterable[SourceSpec] = SOURCES,
    clock: Clock = NOW,
    manifests: str | None = None,
) -> dict[str, int]:
    """Ingest the feeds in order; stops at the first failure."""
    return {
        spec.feed: ingest(
            spark, spec, landing, bronze, log_path, clock, manifests=manifests
        )
        for spec in specs
    }


def inspect_bronze(
    spark: SparkSession, bronze: str, feeds: Iterable[str] = ("crm_customers", "orders")
) -> tuple[DataFrame, DataFrame]:
    """Profile of the bronze tables, and five rows of the first."""
    tables = [(feed, spark.read.parquet(f"{bronze}/{feed}")) for feed in feeds]
    return table_profile(tables), preview(tables[0][1])
