"""Quarantine table of a layer: the values that its casts lost.

``<db>.<table>__failed`` has a row for each lost value of a key: its column,
its text, the type it should have had, and the time of the load that first
met it. A value that is recorded already is not recorded again, so loading a
file twice adds nothing.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import HASH_COL
from .catalog import ensure_database, qualified, table_exists
from .layers import try_read_layer

SUFFIX = "__failed"
_CELL = [HASH_COL, "column", "value", "wanted"]


def record_failures(
    spark: SparkSession, db: str, table: str, path: str, cells: DataFrame, load_ts: _dt.datetime
) -> None:
    """Append the distinct cells that are not recorded yet."""
    ensure_database(spark, db)
    name = qualified(db, table)
    cells = cells.select(*_CELL).distinct()
    if table_exists(spark, db, table):
        known = spark.table(name)
    else:
        known = try_read_layer(spark, path)  # a new session over an old lake
    if known is not None:
        old = known.select(*[F.col(c).alias(f"old_{c}") for c in _CELL])
        same = F.lit(True)
        for c in _CELL:
            same = same & F.col(c).eqNullSafe(F.col(f"old_{c}"))
        cells = cells.join(old, same, "left_anti")
    cells.withColumn("load_time", F.lit(load_ts).cast("timestamp")).write.mode("append").parquet(path)
    if not table_exists(spark, db, table):
        spark.catalog.createTable(f"{db}.{table}", path=path, source="parquet")
    spark.catalog.refreshTable(f"{db}.{table}")
