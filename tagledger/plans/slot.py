"""One scheduled run: a slot of raw files into silver, the star schema and its checks."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tagledger.operators.checks import STAR_CHECKS, run_checks
from tagledger.plans.silver import counted_silver, loadable, metric_columns
from tagledger.plans.star import refresh_star
from tagledger.schemas import SILVER, SLOT_PARTITIONS, Slot
from tagledger.session import pin_session, scratch_scope, shuffles_sized_for, stage
from tagledger.sinks.silver import Registration, off_slot_rows, settle_load, switch_partitions, write_load
from tagledger.sources.bronze import read_bronze, slot_exists, slot_glob
from tagledger.sources.loads import load_partitions
from tagledger.sources.silver import read_silver, staging
from tagledger.sources.spine import SPINE_DAYS, SPINE_START


@dataclass(frozen=True)
class Paths:
    bronze: str
    silver: str
    source: str
    database: str = "default"

    @property
    def silver_table(self) -> str:
        return f"{self.database}.stg_price_snapshots"


@dataclass
class SlotReport:
    slot: Slot
    loaded: bool
    metrics: dict = field(default_factory=dict)
    off_slot_rows: int = 0
    partitions: list[Registration] = field(default_factory=list)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    checks: list = field(default_factory=list)

    @property
    def passed(self) -> bool:
        return all(row["passed"] for row in self.checks)


def create_silver_table(spark: SparkSession, table: str, root: str) -> None:
    """External table over the silver root, as the place where partitions are registered."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SILVER.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(SLOT_PARTITIONS)}) LOCATION '{root}'"
    )


def load_slot(spark: SparkSession, paths: Paths, slot: Slot, layout: str = "auto") -> SlotReport:
    """Raw files of the slot into silver; an empty slot changes nothing.

    The deduplicated rows are stored once with their counts; the counts of the run and the load are
    both made from that copy.
    """
    pin_session(spark)
    report = SlotReport(slot, loaded=slot_exists(spark, paths.bronze, paths.source, slot))
    if not report.loaded:
        return report
    with scratch_scope(spark), shuffles_sized_for(spark, slot_glob(paths.bronze, paths.source, slot)):
        counted = stage(counted_silver(read_bronze(spark, paths.bronze, paths.source, slot, layout), slot), "counted")
        report.metrics = counted.agg(*metric_columns()).first().asDict()
        load = write_load(loadable(counted), paths.silver, slot)
    report.off_slot_rows = off_slot_rows(spark, paths.silver, load, slot)
    # Readers of paths see the load from here on; readers of the table with each partition's switch.
    create_silver_table(spark, paths.silver_table, paths.silver)
    report.partitions = switch_partitions(spark, paths.silver_table, load_partitions(spark, paths.silver, load))
    settle_load(spark, paths.silver, load, slot)
    return report


def run_slot(
    spark: SparkSession,
    paths: Paths,
    slot: Slot,
    layout: str = "auto",
    start: date = SPINE_START,
    days: int = SPINE_DAYS,
    staging_as: str = "view",
) -> SlotReport:
    """Load the slot, rebuild the models from all slots, run all checks."""
    pin_session(spark)
    report = load_slot(spark, paths, slot, layout)
    if report.loaded:
        base = staging(read_silver(spark, paths.silver))
        with scratch_scope(spark), shuffles_sized_for(spark, paths.silver):
            report.tables = refresh_star(base, paths.database, start, days, staging_as)
            report.checks = run_checks(report.tables, STAR_CHECKS).collect()
    return report
