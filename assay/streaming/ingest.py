"""Bronze ingestion of new files only.

The batch job reads every landed file on each run and appends it again, which dedup in silver
hides but which grows with the history of the landing zone. Here the landed files are compared
with the manifest of ingested ones, and only files that are not in it are read, however old their
file time is. Both modes write bronze the same way and keep the same manifest, so they can follow
one another in any order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from assay.plans.bronze import append_files, batch_paths, logged
from assay.plans.clock import NOW, Clock
from assay.plans.quarantine import quarantine_batch
from assay.sources.manifest import Manifest, landed_files
from assay.sources.specs import SourceSpec


def ingest_new(
    spark: SparkSession,
    spec: SourceSpec,
    landing: str,
    bronze: str,
    manifests: str,
    log_path: str,
    clock: Clock = NOW,
    batch_id: str | None = None,
) -> int:
    """Append the rows of files not ingested before, log the run, and return the number of rows.

    A feed that has not landed at all is logged as FAILED, like in the batch mode; one without new
    files is a success of 0 rows. A run that died is picked up: its files are read again unless its
    rows had reached bronze. A file that is written over with another size or time is a new file.
    """
    batch_id = batch_id or str(uuid.uuid4())
    manifest = Manifest(spark, manifests, spec.feed)

    def complete(died: str) -> None:
        quarantine_batch(spark, spec, batch_paths(manifest, died), bronze, died, clock)

    def append() -> int:
        landed = landed_files(spark, landing, spec.feed)
        manifest.recover(f"{bronze}/{spec.feed}", complete)
        return append_files(
            spark, spec, manifest.new_files(landed), bronze, batch_id, clock, manifest
        )

    return logged(spark, log_path, spec.feed, batch_id, append)
