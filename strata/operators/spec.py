"""Technical metadata -> column specs.

The technical metadata has one row per dataset column, so a dataset's specs
are tens of rows: they are filtered on Spark (D2) and only that bounded list
reaches the driver, where it becomes a list of ``ColumnSpec``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import AUDIT_COLS
from ..functions.types import TypeSpec, parse_type

# Technical metadata column names.
TECH_COLUMNS = (
    "filename",
    "columnname",
    "colseq",
    "delta",
    "sql",
    "hashkeycheck",
    "partitionkeycheck",
    "clusterindexcol",
)

# A dataset with more declared columns than this is a metadata error, not a
# table: the spec list is the one thing collected to the driver.
MAX_SPECS = 10_000


def flag_set(value) -> bool:
    """Technical flags compare after upper-casing."""
    return value is not None and str(value).upper() == "Y"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    seq: int
    lake_type: str | None
    sql_type: str | None
    hash_key: bool
    partition_key: bool
    cluster_key: bool

    def lake(self) -> TypeSpec:
        return parse_type(self.lake_type, "lake")

    def warehouse(self) -> TypeSpec:
        return parse_type(self.sql_type, "sql")


@dataclass(frozen=True)
class DatasetSpec:
    dataset: str
    columns: tuple[ColumnSpec, ...]

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def hash_keys(self) -> list[str]:
        return [c.name for c in self.columns if c.hash_key]

    @property
    def partition_key(self) -> str:
        keys = [c.name for c in self.columns if c.partition_key]
        if len(keys) != 1:
            raise ValueError(
                f"dataset {self.dataset!r} needs exactly one partition column, "
                f"metadata flags {keys}"
            )
        return keys[0]

    @property
    def cluster_keys(self) -> list[str]:
        return [c.name for c in self.columns if c.cluster_key]

    def warehouse_ddl_columns(self) -> list[tuple[str, str]]:
        """(name, type) for the warehouse table, plus audit columns."""
        cols = [(c.name, c.warehouse().ddl) for c in self.columns]
        return cols + list(zip(AUDIT_COLS, ("varchar(300)", "date", "date")))


def spelled(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the column that equals ``name`` but for case called ``name``.

    The partition column names folders and catalog partitions, so every layer
    spells it as the metadata does, whatever the file's header says."""
    return df.withColumnsRenamed({c: name for c in df.columns if c.lower() == name.lower() and c != name})


def dataset_rows(tech: DataFrame, dataset: str) -> DataFrame:
    """``tech where filename = dataset``."""
    return tech.filter(F.col("filename") == F.lit(dataset))


def _seq(value) -> int:
    try:
        return int(str(value).strip())
    except (TypeError, ValueError):
        raise ValueError(f"colseq {value!r} is not an integer") from None


def specs_from_rows(dataset: str, rows) -> DatasetSpec:
    """Sort by numeric ``colseq`` (H1) and build the spec list."""
    cols = [
        ColumnSpec(
            name=r["columnname"],
            seq=_seq(r["colseq"]),
            lake_type=r["delta"],
            sql_type=r["sql"],
            hash_key=flag_set(r["hashkeycheck"]),
            partition_key=flag_set(r["partitionkeycheck"]),
            cluster_key=flag_set(r["clusterindexcol"]),
        )
        for r in rows
    ]
    cols.sort(key=lambda c: (c.seq, c.name))
    return DatasetSpec(dataset, tuple(cols))


def dataset_spec(tech: DataFrame, dataset: str) -> DatasetSpec:
    """Collect one dataset's (bounded) metadata rows into a ``DatasetSpec``."""
    rows = (
        dataset_rows(tech, dataset)
        .select(*[F.col(c).cast("string").alias(c) for c in TECH_COLUMNS])
        .limit(MAX_SPECS + 1)
        .collect()
    )
    if len(rows) > MAX_SPECS:
        raise ValueError(f"dataset {dataset!r} declares more than {MAX_SPECS} columns")
    if not rows:
        raise ValueError(f"no technical metadata for dataset {dataset!r}")
    return specs_from_rows(dataset, [r.asDict() for r in rows])


def warehouse_ddl(spec: DatasetSpec) -> str:
    """``name type, ...`` column list text for CREATE TABLE."""
    from ..sources.catalog import quote

    return ", ".join(f"{quote(n)} {t}" for n, t in spec.warehouse_ddl_columns())
