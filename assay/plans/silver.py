"""Bronze to silver: clean, keep the latest version, check parents, validate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assay.operators.dedup import latest_per_key
from assay.operators.quality import any_later_than, grade
from assay.operators.references import flag_existing
from assay.plans.bronze import AUDIT_COLUMNS, with_audit_columns
from assay.plans.clock import NOW, Clock
from assay.sources.folders import require_committed
from assay.sources.specs import (
    ADDRESSES, BY_NAME, CUSTOMERS, LOYALTY_ACCOUNTS, ORDERS, PAYMENTS, SUPPORT_TICKETS, SourceSpec,
)
from assay.sources.tables import read_graded, read_rejected, read_valid, write_graded
from assay.sources.versions import current

WAVES = (
    (CUSTOMERS,),
    (ORDERS, ADDRESSES, SUPPORT_TICKETS, LOYALTY_ACCOUNTS),
    (PAYMENTS,),
)


def standardise(bronze: DataFrame, spec: SourceSpec, clock: Clock = NOW) -> DataFrame:
    """Clean texts and dates in place and stamp the processing time."""
    cleaned = {name: function(name) for name, function in spec.cleaning.items()}
    return bronze.withColumns({**cleaned, "_silver_processed_at": clock.now()})


def latest(standardised: DataFrame, spec: SourceSpec) -> DataFrame:
    """One row per key. Ties go to the largest remaining columns, audit columns last."""
    audit = [name for name in AUDIT_COLUMNS if name in standardised.columns]
    return latest_per_key(standardised, spec.key, spec.order_column, [*spec.columns, *audit])


def with_parents(
    rows: DataFrame, spec: SourceSpec, parents: Mapping[str, DataFrame]
) -> DataFrame:
    """Mark the rows whose parents are in ``parents``, the valid side of silver tables.

    Those hold each key once: they were reduced to one row per key and a NULL key is rejected.
    The customer is joined last. When that join is a shuffled one, the table is then written with
    the rows of a customer together, and the per-customer summaries shrink before their shuffle.
    """
    keys = [parent.key for parent in reversed(spec.parents)]
    rest = [name for name in rows.columns if name not in keys]
    flags = [parent.flag for parent in spec.parents]
    for parent in reversed(spec.parents):
        rows = flag_existing(
            rows, parents[parent.table], parent.key, parent.flag, parent_is_unique=True
        )
    return rows.select(*keys, *rest, *flags)


def with_warning(rows: DataFrame, spec: SourceSpec, clock: Clock = NOW) -> DataFrame:
    """Add the feed's future-date flag, which warns and never rejects."""
    warning = spec.warning
    late = any_later_than(clock.today(), warning.columns, warning.optional)
    return rows.withColumn(warning.flag, late)


def refine(
    bronze: DataFrame,
    spec: SourceSpec,
    parents: Mapping[str, DataFrame] | None = None,
    clock: Clock = NOW,
) -> DataFrame:
    """All rows of one silver table, graded valid or rejected."""
    rows = latest(standardise(bronze, spec, clock), spec)
    rows = with_parents(rows, spec, parents or {})
    return grade(with_warning(rows, spec, clock), spec.rules)


class SilverTables:
    """The silver tables below one folder, each with its valid and rejected side.

    With ``versioned`` they are published as versions, which readers never find missing.
    """

    def __init__(self, spark: SparkSession, root: str, versioned: bool = False):
        self.spark = spark
        self.root = root
        self.versioned = versioned
        self._schemas: dict[str, StructType] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, graded: DataFrame | Sequence[DataFrame], name: str) -> None:
        """Put a table in its place, given as a whole or in parts."""
        parts = [graded] if isinstance(graded, DataFrame) else graded
        write_graded(parts, self.path(name), self.versioned)
        self._schemas[name] = parts[0].schema

    def graded(self, name: str) -> DataFrame:
        return read_graded(self.spark, self.path(name), self._schema(name))

    def valid(self, name: str) -> DataFrame:
        return read_valid(self.spark, self.path(name), self._schema(name))

    def rejected(self, name: str) -> DataFrame:
        return read_rejected(self.spark, self.path(name), self._schema(name))

    def _schema(self, name: str) -> StructType:
        if name not in self._schemas:
            self._schemas[name] = graded_schema(self.spark, self.path(name), BY_NAME[name])
        return self._schemas[name]


def graded_schema(spark: SparkSession, path: str, spec: SourceSpec) -> StructType:
    """Schema of a written silver table with the partition column put back in its place."""
    path = current(spark, path)
    require_committed(spark, path)
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return planned_schema(spark, spec)
        raise
    names = [name for name in stored.columns if name != "_is_valid"]
    names.insert(names.index("_rejection_reason"), "_is_valid")
    return stored.withColumn("_is_valid", F.col("_is_valid").cast("boolean")).select(*names).schema


def planned_schema(spark: SparkSession, spec: SourceSpec) -> StructType:
    """Schema that refining gives; a table without rows has no file to read it from."""
    bronze = with_audit_columns(spark.createDataFrame([], spec.schema))
    parents = {
        parent.table: spark.createDataFrame([], f"{parent.key} STRING") for parent in spec.parents
    }
    return refine(bronze, spec, parents).schema


def refine_table(
    bronze: DataFrame, spec: SourceSpec, silver: SilverTables, clock: Clock = NOW, parts: int = 1
) -> None:
    """Refine one table against the written parents and write both sides.

    With ``parts`` this many parts of the keys are refined one after the other, each from a scan of
    its own, and only the shuffles of one part lie on disk at a time.
    """
    parents = {parent.table: silver.valid(parent.table) for parent in spec.parents}
    clock = clock.held(bronze.sparkSession) if parts > 1 else clock
    silver.write(
        [refine(rows, spec, parents, clock) for rows in key_parts(bronze, spec.key, parts)],
        spec.name,
    )


def key_parts(rows: DataFrame, key: str, parts: int) -> list[DataFrame]:
    """The rows in parts by hash of their key, so that the versions of a key stay together."""
    if parts == 1:
        return [rows]
    part = F.pmod(F.xxhash64(key), F.lit(parts))
    return [rows.where(part == number) for number in range(parts)]


def refine_all(
    bronze: Mapping[str, DataFrame],
    silver: SilverTables,
    clocks: Mapping[str, Clock] | None = None,
    parts: Mapping[str, int] | None = None,
) -> SilverTables:
    """Write the silver tables of the feeds in ``bronze``, parents before children.

    The tables of one wave depend only on earlier waves. They are submitted side by side, so a
    small feed does not leave the cluster idle behind a large one.
    """
    clocks, parts = clocks or {}, parts or {}

    def run(spec: SourceSpec) -> None:
        refine_table(
            bronze[spec.name], spec, silver, clocks.get(spec.name, NOW), parts.get(spec.name, 1)
        )

    for wave in WAVES:
        due = [spec for spec in wave if spec.name in bronze]
        if due:
            with ThreadPoolExecutor(len(due)) as pool:
                list(pool.map(run, due))
    return silver
