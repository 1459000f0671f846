"""Membership bitmaps of a layer, kept by day next to it.

A table (bucket, bitmap) partitioned by day, read for a batch's days only. It
follows the layer's versions as the key index does (``sources/keyindex.py``):
a load that finds bitmaps of another version than the layer's present one
builds them anew. An append adds the bits of its new rows as further rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import HASH_COL
from ..operators.increment import prune_to_values
from ..operators.membership import day_bitmaps
from .catalog import ensure_database, qualified, table_exists
from .keyindex import HOLDS, fresh_folder
from .taken import get_properties, set_properties

SUFFIX = "__bits"
_BITS = "strata.bits"


@dataclass(frozen=True)
class DayBitmaps:
    spark: SparkSession
    db: str
    table: str
    path: str
    bits: int
    part: str
    key: str = HASH_COL

    @property
    def name(self) -> str:
        return qualified(self.db, self.table)

    def _write(self, rows: DataFrame) -> DataFrame:
        """One file a day at most from each task: rows are dealt by day."""
        made = day_bitmaps(rows, self.part, self.bits, self.key)
        return made.select("bucket", "bitmap", "day").hint("rebalance", "day")

    def bitmaps(self, version: str) -> DataFrame | None:
        if not version or not table_exists(self.spark, self.db, self.table):
            return None
        have = get_properties(self.spark, self.db, self.table)
        if have.get(HOLDS) != version or have.get(_BITS) != str(self.bits):
            return None
        return self.spark.table(self.name)

    def build(self, stored: DataFrame, version: str) -> DataFrame:
        ensure_database(self.spark, self.db)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        writer = self._write(stored).write.format("parquet").partitionBy("day")
        writer.option("path", fresh_folder(self.path)).saveAsTable(self.name)
        set_properties(self.spark, self.db, self.table, {HOLDS: version, _BITS: str(self.bits)})
        return self.spark.table(self.name)

    def append(self, new: DataFrame, version: str) -> None:
        """Add the bits of rows whose append gave the layer ``version``.
        ``new`` must not read these bitmaps."""
        self._write(new).write.insertInto(self.name)
        set_properties(self.spark, self.db, self.table, {HOLDS: version})

    def of_days(self, bitmaps: DataFrame, days: list) -> DataFrame:
        return prune_to_values(bitmaps, "day", days)
