"""Key index of a target: its distinct row hashes, bucketed and sorted.

A load compares its batch with every hash the target holds. Read from the
target itself, that is a scan and a shuffle of its whole hash column on every
load. The index keeps the hashes in a bucketed table instead: the anti-join
shuffles the batch to the buckets and reads the index where it lies, without
an exchange or a distinct on the stored side. Loads append the hashes they add.

The index is a copy, so it must never be believed when it may differ. It names
the version of the target (``sources/taken.py``) whose hashes it holds, and an
append gives the target a new version before it writes anything. The index gets
its hashes, and then the new name, when that append has ended; a load that
finds another version than the target's present one, or a target whose append
did not end, builds the index anew from the target. Targets are written by loads only (a
user's own DELETE or INSERT into a warehouse table is not seen; drop the index
table after one, or switch the index off with ``LakeConfig.key_index``).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import HASH_COL
from .catalog import ensure_database, qualified, table_exists
from .taken import get_properties, set_properties

SUFFIX = "__keys"
#: Property of a side table: the version of the target that it describes.
HOLDS = "strata.holds"
_BUCKETS, _APPENDS = "strata.buckets", "strata.appends"
#: Appends after which an index is written anew: a bucket is a file for each.
MAX_APPENDS = 32


def fresh_folder(path: str) -> str:
    """A folder of its own below ``path`` for every time a table is built."""
    return f"{path}/{uuid.uuid4().hex}"


@dataclass(frozen=True)
class KeyIndex:
    """``db.table`` over folders below ``path``. ``buckets`` None: as many as
    the session's shuffle partitions when the index is built."""

    spark: SparkSession
    db: str
    table: str
    path: str
    buckets: int | None = None
    key: str = HASH_COL

    @property
    def name(self) -> str:
        return qualified(self.db, self.table)

    def keys(self, version: str) -> DataFrame | None:
        """The distinct hashes of the target's ``version``, or None."""
        if not version or not table_exists(self.spark, self.db, self.table):
            return None
        have = get_properties(self.spark, self.db, self.table)
        if have.get(HOLDS) != version or int(have.get(_APPENDS, 0)) > MAX_APPENDS:
            return None
        return self.spark.table(self.name)

    def build(self, rows: DataFrame, version: str) -> DataFrame:
        """Write the index from the target's rows (hash column only)."""
        buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        ensure_database(self.spark, self.db)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        # Dealt by the bucket's own hash: a bucket is one task and one file.
        # A folder of its own, so a read of the index before stays whole.
        keys = rows.select(self.key).distinct().repartition(buckets, self.key)
        writer = keys.write.format("parquet").bucketBy(buckets, self.key).sortBy(self.key)
        writer.option("path", fresh_folder(self.path)).saveAsTable(self.name)
        set_properties(self.spark, self.db, self.table, {HOLDS: version, _BUCKETS: str(buckets), _APPENDS: "0"})
        return self.spark.table(self.name)

    def append(self, rows: DataFrame, version: str) -> None:
        """Add the hashes of the rows (none of them is in the index) whose
        append gave the target ``version``. ``rows`` must not read the index:
        writing it would change them."""
        have = get_properties(self.spark, self.db, self.table)
        keys = rows.select(self.key).distinct().repartition(int(have[_BUCKETS]), self.key)
        keys.write.insertInto(self.name)
        appends = str(int(have[_APPENDS]) + 1)
        set_properties(self.spark, self.db, self.table, {HOLDS: version, _APPENDS: appends})


def new_by_index(batch: DataFrame, keys: DataFrame, key: str = HASH_COL, hot: list | None = None) -> DataFrame:
    """Batch rows whose hash is not in the index: the anti-join of
    ``operators.increment`` on a side that is distinct already."""
    from ..operators.increment import anti_join_new

    return anti_join_new(batch, keys, key, hot, distinct_stored=False)
