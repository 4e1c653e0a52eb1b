"""Reading one slot of raw JSON."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagledger.schemas import BRONZE, BRONZE_COLUMNS, Slot
from tagledger.session import any_file, first_bytes, glob_names
from tagledger.sources.objects import json_objects

HEAD_BYTES = 1 << 14  # of each file, to see its form
HEADS_AT_ONCE = 16


def slot_folders(root: str, source: str, slot: Slot) -> str:
    return f"{root.rstrip('/')}/source={source}/category=*/{slot.folder}"


def slot_glob(root: str, source: str, slot: Slot) -> str:
    return f"{slot_folders(root, source, slot)}/*"


def slot_exists(spark: SparkSession, root: str, source: str, slot: Slot) -> bool:
    """Is there a file of the slot in any category?  Lists only the slot's folders."""
    return any_file(spark, slot_folders(root, source, slot))


def _is_lines(head: bytes) -> bool:
    """Is the first line that is not blank a whole object or array?"""
    text = head.decode("utf-8", "replace").lstrip("\ufeff \t\r\n")
    line, end, _ = text.partition("\n")
    line = line.rstrip()
    if not end and len(head) == HEAD_BYTES:
        return False
    return not line or line[0] + line[-1] in ("{}", "[]")


def file_forms(spark: SparkSession, pattern: str) -> tuple[list[str], list[str]]:
    """Files with an object or array per line, and all others, by the first bytes of each."""
    names = [n for n in glob_names(spark, pattern) if not n.rsplit("/", 1)[-1].startswith(("_", "."))]
    with ThreadPool(HEADS_AT_ONCE) as pool:
        flags = pool.map(lambda name: _is_lines(first_bytes(spark, name, HEAD_BYTES)), names)
    lines = [n for n, flag in zip(names, flags) if flag]
    return lines, [n for n, flag in zip(names, flags) if not flag]


def read_objects(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Bronze columns of all JSON objects of files of any form; files are split over tasks."""
    parsed = json_objects(spark, paths).select(F.from_json("text", BRONZE).alias("_row"))
    return parsed.select(*[F.col(f"_row.{c}").alias(c) for c in BRONZE_COLUMNS])


def read_bronze(
    spark: SparkSession,
    root: str,
    source: str,
    slot: Slot,
    layout: str = "auto",
) -> DataFrame:
    """All files of one slot, all categories, as text columns; no rows for an empty slot.

    ``layout='auto'`` finds the form of every file from its first bytes, and reads it once.
    ``layout='lines'``: one object (or one array) per line, as ``write_bronze`` writes it.
    ``layout='array'``: arrays over many lines, or any other form.  Large files are split
    over tasks in every form.
    """
    if layout not in ("auto", "array", "lines"):
        raise ValueError(f"unknown layout: {layout!r}")
    if not slot_exists(spark, root, source, slot):
        return spark.createDataFrame([], BRONZE)
    pattern = slot_glob(root, source, slot)
    if layout == "lines":
        return spark.read.schema(BRONZE).json(pattern)
    if layout == "array":
        return read_objects(spark, pattern)
    lines, others = file_forms(spark, pattern)
    if not others:
        return spark.read.schema(BRONZE).json(pattern)
    objects = read_objects(spark, others)
    return spark.read.schema(BRONZE).json(lines).unionByName(objects) if lines else objects
