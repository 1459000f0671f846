"""Layer tables at a path.

A layer is a partitioned columnar table (Parquet by default) at a path. It is
read with schema merging, because appends may add columns, and with partition
values kept as text: the conformed partition column is a ``yyyy-MM-dd``
string and must not come back as a date.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import threading
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .catalog import (
    LOGGED_FORMATS,
    add_columns,
    add_partitions,
    qualified,
    register_layer_table,
    same_location,
    table_location,
)

DEFAULT_FORMAT = "parquet"
_INFER = "spark.sql.sources.partitionColumnTypeInference.enabled"


# Loads that switch partition-type inference off are serialised: datasets may
# load in parallel threads, and one thread restoring the setting must not
# land in the middle of another thread's load.
_INFER_LOCK = threading.Lock()


@contextlib.contextmanager
def _text_partitions(spark: SparkSession):
    """Partition values are parsed when the relation is resolved (at load)."""
    with _INFER_LOCK:
        old = spark.conf.get(_INFER, "true")
        spark.conf.set(_INFER, "false")
        try:
            yield
        finally:
            spark.conf.set(_INFER, old)


def _missing(exc: AnalysisException) -> bool:
    cond = getattr(exc, "getCondition", None)
    name = cond() if callable(cond) else None
    text = str(exc)
    return name in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA") or any(
        k in text for k in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
    )


def read_layer(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """A4: read a layer table; partition columns come back as strings."""
    if fmt in LOGGED_FORMATS:
        return spark.read.format(fmt).load(path)  # schema and types from the log
    with _text_partitions(spark):
        return spark.read.format(fmt).option("mergeSchema", "true").load(path)


def try_read_layer(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame | None:
    """A15 and A4 together: the layer, or None when nothing is stored there."""
    try:
        return read_layer(spark, path, fmt)
    except AnalysisException as exc:
        if _missing(exc):
            return None
        raise


def layer_exists(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> bool:
    """True when a readable table is stored at ``path``."""
    return try_read_layer(spark, path, fmt) is not None


def write_layer(
    df: DataFrame,
    path: str,
    partition_col: str,
    fmt: str = DEFAULT_FORMAT,
    mode: str = "append",
) -> None:
    """A5 (``mode="errorifexists"``) and A6 (``mode="append"``).

    Rows are rebalanced on the partition column first: without it every task
    writes one file per day it holds (tasks x days small files). The
    ``rebalance`` hint lets AQE size the write tasks: a hot day is split over
    several tasks (several files) and small days are packed together.
    """
    writer = df.hint("rebalance", partition_col).write.format(fmt).mode(mode)
    if fmt in LOGGED_FORMATS:
        writer = writer.option("mergeSchema", "true")  # schema evolution in the log
    writer.partitionBy(partition_col).save(path)


def snapshot_layer(
    stored: DataFrame,
    backup_path: str,
    partition_col: str,
    fmt: str = DEFAULT_FORMAT,
    keep_if_empty: bool = False,
) -> str | None:
    """Copy the layer's rows to a new folder under ``backup_path``.

    The folder is named by the time; older copies are deleted once the new one
    is complete, so a failed copy leaves the last good one. With
    ``keep_if_empty`` a copy of no rows is not made. Returns the new folder.
    """
    if keep_if_empty and stored.isEmpty():
        return None
    spark = stored.sparkSession
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(backup_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    older = [s.getPath() for s in fs.listStatus(root)] if fs.exists(root) else []
    path = f"{backup_path}/{_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S%f}"
    stored.hint("rebalance", partition_col).write.format(fmt).partitionBy(partition_col).save(path)
    for p in older:
        fs.delete(p, True)
    return path


@dataclass(frozen=True)
class LayerTable:
    """A layer: files at ``path`` plus a catalog table that tracks them.

    The catalog keeps the schema and the partition list, so a read filtered
    on the partition column lists only the matching partition folders and
    reads no footers to find the schema. ``partition_type`` is the partition
    column's type in the table (None: string, as in the conformed layer).
    """

    path: str
    db: str
    table: str
    partition_col: str
    fmt: str = DEFAULT_FORMAT
    partition_type: str | None = None

    @property
    def name(self) -> str:
        return qualified(self.db, self.table)


def _with_partition_type(
    spark: SparkSession, schema: StructType, col: str, dtype: str | None
) -> StructType:
    if dtype is None:
        return schema
    # Resolve the type text the way a cast does (analyzer, no private API).
    target = spark.range(0).select(F.lit(None).cast(dtype).alias(col)).schema[col].dataType
    return StructType([StructField(f.name, target, True) if f.name == col else f for f in schema.fields])


def heal_partitions(spark: SparkSession, lt: LayerTable, values: list | None) -> None:
    """Make the catalog know the partitions a load is about to compare with.

    A load that died between writing files and recording their partitions
    leaves rows the catalog does not show. Recording the batch's days first
    (those it holds already are skipped by the catalog) lets the anti-join see
    them. ``None``: too many days to name, so all folders are rediscovered.
    """
    if lt.fmt in LOGGED_FORMATS or not same_location(table_location(spark, lt.db, lt.table), lt.path):
        return
    if values is None:
        spark.sql(f"MSCK REPAIR TABLE {lt.name}")
    else:
        add_partitions(spark, lt.db, lt.table, lt.partition_col, values)
    spark.catalog.refreshTable(f"{lt.db}.{lt.table}")


def open_layer(spark: SparkSession, lt: LayerTable) -> DataFrame | None:
    """A4 + A15: the layer as a catalog table, or None when nothing is stored.

    When the catalog does not know the layer yet (a new session over an
    existing lake), it is adopted once from its folders: one full listing
    and schema merge, after which reads go through the catalog.
    """
    if same_location(table_location(spark, lt.db, lt.table), lt.path):
        return spark.table(lt.name)
    df = try_read_layer(spark, lt.path, lt.fmt)
    if df is None:
        return None
    if lt.fmt in LOGGED_FORMATS:
        register_layer_table(spark, lt.db, lt.table, lt.path, lt.fmt)
        return spark.table(lt.name)
    schema = _with_partition_type(spark, df.schema, lt.partition_col, lt.partition_type)
    register_layer_table(spark, lt.db, lt.table, lt.path, lt.fmt, schema, lt.partition_col)
    return spark.table(lt.name)


def save_to_layer(
    spark: SparkSession,
    lt: LayerTable,
    df: DataFrame,
    values: list | None,
    mode: str = "append",
) -> None:
    """A5 / A6 + B2: write rows, then record new columns and partitions.

    ``values`` are the partition values the rows carry (None: unknown, the
    catalog then rediscovers partitions from the folders).
    """
    write_layer(df, lt.path, lt.partition_col, lt.fmt, mode)
    if not same_location(table_location(spark, lt.db, lt.table), lt.path):
        register_layer_table(
            spark, lt.db, lt.table, lt.path, lt.fmt, df.schema, lt.partition_col, values
        )
        return
    if lt.fmt in LOGGED_FORMATS:
        spark.catalog.refreshTable(f"{lt.db}.{lt.table}")
        return
    have = {f.name.lower() for f in spark.table(lt.name).schema.fields}
    extra = [(f.name, f.dataType.simpleString()) for f in df.schema.fields if f.name.lower() not in have]
    add_columns(spark, lt.db, lt.table, extra)
    if values is None:
        spark.sql(f"MSCK REPAIR TABLE {lt.name}")
    else:
        add_partitions(spark, lt.db, lt.table, lt.partition_col, values)
    spark.catalog.refreshTable(f"{lt.db}.{lt.table}")
