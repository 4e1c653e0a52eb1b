"""Reading partitioned silver Parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagledger.schemas import SILVER, SILVER_COLUMNS, SLOT_PARTITIONS, STAGING_COLUMNS, Slot
from tagledger.session import any_file
from tagledger.sources.loads import LOAD, complete_loads, settled_loads, without_replaced

_WITH_LOAD = T.StructType([*SILVER.fields, T.StructField(LOAD, T.StringType())])


def _read(spark: SparkSession, root: str, slot: Slot | None) -> DataFrame | None:
    """Appended folders and complete loads; None if there is neither.

    The schema is given: inference would read run_hour '06' as 6.
    """
    base = root.rstrip("/")
    appended = f"{base}/{SLOT_PARTITIONS[0]}=*"
    if slot:
        appended += f"/run_date={slot.run_date}/run_hour={slot.run_hour}"
    loads = complete_loads(spark, root, slot)
    parts = []
    if any_file(spark, appended):
        rows = spark.read.schema(SILVER).option("basePath", base).parquet(appended)
        parts.append(rows.withColumn(LOAD, F.lit(None).cast("string")))
    if loads:
        rows = spark.read.schema(_WITH_LOAD).option("basePath", base).parquet(*[x.folder(root) for x in loads])
        parts.append(rows)
    if not parts:
        return None
    rows = reduce(DataFrame.unionByName, parts)
    return without_replaced(rows, root, loads, settled_loads(spark, root, slot)).select(*SILVER_COLUMNS)


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    """Silver rows: what was appended, and the newest complete load of every partition."""
    rows = _read(spark, root, None)
    return spark.read.schema(SILVER).parquet(root) if rows is None else rows


def read_silver_slot(spark: SparkSession, root: str, slot: Slot) -> DataFrame:
    """Silver rows of one slot; lists only the slot's folders, not the whole table."""
    rows = _read(spark, root, slot)
    return spark.createDataFrame([], SILVER) if rows is None else rows


def staging(silver: DataFrame) -> DataFrame:
    """The column contract every model reads."""
    return silver.select(*STAGING_COLUMNS)
