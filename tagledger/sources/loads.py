"""Loads of silver slots: a folder each, which counts from one moment on.

A load is written to ``<root>/load=<day>-<hour>.<number>``.  Readers see it once its ``_SUCCESS`` file is
there, the last thing the write creates; until then, or if the write fails, what was
loaded before stays as it is.  Afterwards the folders that it replaces are dropped and the load is marked
``_SETTLED``; between the two moments readers leave out what a later load replaces.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagledger.schemas import SLOT_PARTITIONS, Slot
from tagledger.session import delete_folder, glob_names

LOAD = "load"
DONE = "_SUCCESS"
SETTLED = "_SETTLED"
# The folder name of a null, a fixed value of partitioned tables.
_NULL = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True, order=True)
class Load:
    """One load of a slot; later loads of a slot have greater numbers."""

    slot: str
    number: int

    @classmethod
    def parse(cls, name: str) -> "Load":
        slot, _, number = name.partition(".")
        return cls(slot, int(number))

    @property
    def name(self) -> str:
        return f"{self.slot}.{self.number:06d}"

    def folder(self, root: str) -> str:
        return f"{root.rstrip('/')}/{LOAD}={self.name}"


@dataclass(frozen=True)
class Partition:
    """A partition and the folder of its files."""

    category: str | None
    run_date: str
    run_hour: str
    location: str

    @property
    def key(self) -> tuple:
        return self.category, self.run_date, self.run_hour


def slot_name(slot: Slot) -> str:
    return f"{slot.run_date}-{slot.run_hour}"


def _loads(spark: SparkSession, root: str, behind: str, slot: Slot | None = None) -> list[Load]:
    wanted = f"{slot_name(slot)}.*" if slot else "*"
    found = glob_names(spark, f"{root.rstrip('/')}/{LOAD}={wanted}{behind}")
    parts = [next(p for p in name.split("/") if p.startswith(f"{LOAD}=")) for name in found]
    return sorted(Load.parse(p.removeprefix(f"{LOAD}=")) for p in parts)


def begun_loads(spark: SparkSession, root: str, slot: Slot | None = None) -> list[Load]:
    return _loads(spark, root, "", slot)


def complete_loads(spark: SparkSession, root: str, slot: Slot | None = None) -> list[Load]:
    return _loads(spark, root, f"/{DONE}", slot)


def settled_loads(spark: SparkSession, root: str, slot: Slot | None = None) -> list[Load]:
    return _loads(spark, root, f"/{SETTLED}", slot)


def partition_of(path: str) -> Partition | None:
    """The partition that a file or folder belongs to; None if its path names none."""
    parts = path.rstrip("/").split("/")
    values = dict(p.split("=", 1) for p in parts if "=" in p)
    if not set(SLOT_PARTITIONS) <= set(values):
        return None
    last = max(i for i, p in enumerate(parts) if p.startswith(f"{SLOT_PARTITIONS[-1]}="))
    read = [None if values[c] == _NULL else unquote(values[c]) for c in SLOT_PARTITIONS]
    return Partition(*read, "/".join(parts[: last + 1]))


def load_partitions(spark: SparkSession, root: str, load: Load) -> list[Partition]:
    """Partitions of a load, from its folders; no row is read."""
    found = glob_names(spark, load.folder(root) + "".join(f"/{c}=*" for c in SLOT_PARTITIONS))
    return [p for p in map(partition_of, found) if p]


def file_partitions(df: DataFrame) -> list[Partition]:
    """Partitions of a table of files, from the names of its files; no row is read."""
    folders = sorted({unquote(f.rsplit("/", 1)[0]) for f in df.inputFiles()})
    return [p for p in map(partition_of, folders) if p]


def without_replaced(df: DataFrame, root: str, loads: Sequence[Load], settled: Sequence[Load]) -> DataFrame:
    """Leave out partitions of (load, …) that a later load replaces and that are not dropped yet."""
    spark = df.sparkSession
    pending = [load for load in loads if load not in set(settled)]
    rows = [(*p.key, load.name) for load in pending for p in load_partitions(spark, root, load)]
    if not rows:
        return df
    names = [f"_{c}" for c in (*SLOT_PARTITIONS, LOAD)]
    later = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    same = F.coalesce(LOAD, F.lit("")) < F.col(f"_{LOAD}")
    for c in SLOT_PARTITIONS:
        same = same & F.col(c).cast("string").eqNullSafe(F.col(f"_{c}"))
    return df.join(F.broadcast(later), same, "left_anti")


def drop_replaced(spark: SparkSession, root: str, load: Load, slot: Slot) -> None:
    """Drop the folders that a complete load replaces, and older loads that have none left."""
    base = root.rstrip("/")
    older = [o for o in begun_loads(spark, root, slot) if o < load]
    for p in load_partitions(spark, root, load):
        behind = p.location.split(f"{LOAD}={load.name}/", 1)[1]
        for folder in (f"{base}/{behind}", *(f"{o.folder(root)}/{behind.split('/', 1)[0]}" for o in older)):
            delete_folder(spark, folder)
    for o in older:
        if not load_partitions(spark, root, o):
            delete_folder(spark, o.folder(root))
