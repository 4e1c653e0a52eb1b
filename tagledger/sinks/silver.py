"""Loading silver partitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagledger.schemas import SILVER, SILVER_COLUMNS, SLOT_PARTITIONS, Slot
from tagledger.session import create_marker, delete_folder
from tagledger.sources.loads import (
    SETTLED,
    Load,
    Partition,
    begun_loads,
    complete_loads,
    drop_replaced,
    file_partitions,
    slot_name,
)

PARTITION_BATCH = 200


def write_silver(df: DataFrame, root: str) -> None:
    """Append, keeping what is there; few files per partition, more for a hot one."""
    df.hint("rebalance", *SLOT_PARTITIONS).write.mode("append").partitionBy(*SLOT_PARTITIONS).parquet(root)


def write_load(df: DataFrame, root: str, slot: Slot) -> Load:
    """Write the slot's rows as a new load, which readers see when it is complete.

    Rows go to the slot's own day even where ``scraped_at`` is of another day.  The rebalance
    makes few files per category and cuts a hot category into several.  A slot has
    one writer at a time: what an earlier one began and did not end is removed.
    """
    spark = df.sparkSession
    begun, done = begun_loads(spark, root, slot), complete_loads(spark, root, slot)
    for broken in set(begun) - set(done):
        delete_folder(spark, broken.folder(root))
    load = Load(slot_name(slot), max((x.number for x in begun), default=0) + 1)
    placed = df.withColumns({"run_date": F.lit(slot.run_date), "run_hour": F.lit(slot.run_hour)}).select(*SILVER_COLUMNS)
    placed.hint("rebalance", *SLOT_PARTITIONS).write.mode("error").partitionBy(*SLOT_PARTITIONS).parquet(load.folder(root))
    return load


def settle_load(spark: SparkSession, root: str, load: Load, slot: Slot) -> None:
    """Drop what the load replaces; readers have not seen it since the load was complete."""
    drop_replaced(spark, root, load, slot)
    create_marker(spark, f"{load.folder(root)}/{SETTLED}")


def off_slot_rows(spark: SparkSession, root: str, load: Load, slot: Slot) -> int:
    """Rows of a load that were scraped on another day than the slot's; one column is read."""
    rows = spark.read.schema(SILVER).parquet(load.folder(root))
    return rows.filter(~F.to_date("scraped_at").eqNullSafe(F.lit(slot.run_date))).count()


def replace_slot(df: DataFrame, root: str, slot: Slot) -> int:
    """Replace the slot's partition of every category in ``df``; all others stay.

    A replay replaces what it wrote before and nothing else, at one moment for all
    categories; a write that fails changes nothing.  Returns the number of rows of another day.
    """
    load = write_load(df, root, slot)
    settle_load(df.sparkSession, root, load, slot)
    return off_slot_rows(df.sparkSession, root, load, slot)


@dataclass(frozen=True)
class Registration:
    category: str | None
    run_date: str
    run_hour: str
    registered: bool
    message: str = ""


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _partition_clause(key: tuple, location: str | None = None) -> str:
    values = ", ".join(f"{n} = " + ("null" if v is None else _quoted(str(v))) for n, v in zip(SLOT_PARTITIONS, key))
    return f"PARTITION ({values})" + (f" LOCATION {_quoted(location)}" if location else "")


def _add(spark: SparkSession, table: str, rows: list[tuple]) -> None:
    clauses = " ".join(_partition_clause(*r) for r in rows)
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {clauses}")


def _add_all(spark: SparkSession, table: str, rows: list[tuple]) -> list[Registration]:
    """Add (key, location) in batches; where a batch fails, each of its partitions is tried alone."""
    done: list[Registration] = []
    for start in range(0, len(rows), PARTITION_BATCH):
        batch = rows[start : start + PARTITION_BATCH]
        try:
            _add(spark, table, batch)
            done += [_registration(key, True) for key, _ in batch]
        except Exception:
            done += [_tried(key, lambda r=(key, place): _add(spark, table, [r])) for key, place in batch]
    return done


def _tried(key: tuple, job) -> Registration:
    try:
        job()
        return _registration(key, True)
    except Exception as error:
        return _registration(key, False, str(error).splitlines()[0])


def _registration(key: tuple, registered: bool, message: str = "") -> Registration:
    category, run_date, run_hour = key
    return Registration(category, str(run_date), str(run_hour), registered, message)


def register_partitions(spark: SparkSession, table: str, df: DataFrame) -> list[Registration]:
    """Make the partitions of ``df`` known to an external table over the silver root.

    The partitions of a table of files are read off its file names, with the folder of
    each; only other tables are scanned for them, and take the folders of the table's own
    location.  A failure is reported, not raised, as is a partition with files in several
    folders, which a table cannot show.  The list is one entry per partition.
    """
    places: dict[tuple, set[str]] = {}
    for p in file_partitions(df):
        places.setdefault(p.key, set()).add(p.location)
    if not places:
        rows = df.select(*SLOT_PARTITIONS).distinct().collect()
        return _add_all(spark, table, [(tuple(r), None) for r in rows])
    single = [Partition(*key, *found) for key, found in places.items() if len(found) == 1]
    many = [_registration(key, False, "files in several folders") for key, found in places.items() if len(found) > 1]
    return switch_partitions(spark, table, single) + many


def switch_partitions(spark: SparkSession, table: str, partitions: list[Partition]) -> list[Registration]:
    """Point the table's partitions at their folders, one statement each; new ones are added before."""
    added = _add_all(spark, table, [(p.key, p.location) for p in partitions])

    def point(p: Partition) -> None:
        spark.sql(f"ALTER TABLE {table} {_partition_clause(p.key)} SET LOCATION {_quoted(p.location)}")

    done = [_tried(p.key, lambda p=p: point(p)) if a.registered else a for a, p in zip(added, partitions)]
    if any(r.registered for r in done):
        spark.catalog.refreshTable(table)
    return done
