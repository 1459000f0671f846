"""Catalog DDL (B1-B7) with validated, quoted identifiers.

Names come from metadata, so every identifier is checked against a strict
pattern and back-quoted before it is placed in a statement; values never
are (they go through DataFrame predicates).
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

_IDENT = re.compile(r"^[A-Za-z0-9_]+$")

# Table formats that track their own schema and data files in a transaction
# log: the catalog only points at them (no column list, no partition list).
LOGGED_FORMATS = frozenset({"delta"})


def quote(name: str) -> str:
    if name is None or not _IDENT.match(str(name)):
        raise ValueError(f"invalid identifier {name!r}")
    return f"`{name}`"


def qualified(db: str, table: str) -> str:
    return f"{quote(db)}.{quote(table)}"


def _sql_string(text: str) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, db: str) -> None:
    """Create the database (schema) when absent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(db)}")


def table_exists(spark: SparkSession, db: str, table: str) -> bool:
    """B4."""
    return spark.catalog.tableExists(f"{db}.{table}")


def register_layer_table(
    spark: SparkSession,
    db: str,
    table: str,
    path: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
    partition_col: str | None = None,
    partition_values: list | None = None,
) -> None:
    """B2: (re)create ``db.table`` as an external table over a layer path.

    With ``schema`` given the catalog keeps the layer's own types (the
    conformed partition column stays a string instead of an inferred date).
    """
    ensure_database(spark, db)
    name = qualified(db, table)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if fmt in LOGGED_FORMATS:
        # The table format keeps schema and files in its own log.
        spark.sql(f"CREATE TABLE {name} USING {quote(fmt)} LOCATION {_sql_string(path)}")
        return
    cols = ""
    parts = ""
    if schema is not None:
        part = (partition_col or "").lower()
        fields = sorted(schema.fields, key=lambda f: f.name.lower() == part)
        cols = " (" + ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in fields) + ")"
    if partition_col is not None:
        parts = f" PARTITIONED BY ({quote(partition_col)})"
    spark.sql(f"CREATE TABLE {name}{cols} USING {quote(fmt)}{parts} LOCATION {_sql_string(path)}")
    if partition_col is not None and partition_values is None:
        # File-source tables only see partitions the catalog knows about;
        # without a known value list, discover them from the folders once.
        spark.sql(f"MSCK REPAIR TABLE {name}")
    elif partition_col is not None:
        add_partitions(spark, db, table, partition_col, partition_values)


# The folder name Spark writes for a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def known_partitions(spark: SparkSession, db: str, table: str) -> set[str]:
    """Partition values the catalog holds: the whole list, for inspection and
    tests only. No load calls it."""
    from urllib.parse import unquote

    rows = spark.sql(f"SHOW PARTITIONS {qualified(db, table)}").collect()
    return {unquote(r[0].split("=", 1)[1]) for r in rows}


def add_partitions(spark: SparkSession, db: str, table: str, col: str, values: list, chunk: int = 5000) -> None:
    """Tell the catalog about partitions just written (no folder listing).

    Values the catalog holds already are left alone by it; its whole partition
    list never comes to the driver.
    """
    name = qualified(db, table)
    vals = sorted({NULL_PARTITION if v is None else str(v) for v in values})
    for i in range(0, len(vals), chunk):
        specs = " ".join(f"PARTITION ({quote(col)} = {_sql_string(v)})" for v in vals[i : i + chunk])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")


def table_location(spark: SparkSession, db: str, table: str) -> str | None:
    if not table_exists(spark, db, table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(db, table)}").collect()
    for r in rows:
        if r[0] == "Location":
            return r[1]
    return None


def same_location(a: str | None, b: str | None) -> bool:
    def norm(p):
        p = (p or "").rstrip("/")
        return p[len("file:"):] if p.startswith("file:") else p

    return a is not None and b is not None and norm(a) == norm(b)


def create_table(
    spark: SparkSession,
    db: str,
    table: str,
    columns: list[tuple[str, str]],
    fmt: str = "parquet",
) -> None:
    """Create a typed table from (name, type) pairs when absent."""
    body = ", ".join(f"{quote(n)} {t}" for n, t in columns)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified(db, table)} ({body}) USING {quote(fmt)}")


def add_columns(spark: SparkSession, db: str, table: str, columns: list[tuple[str, str]]) -> None:
    """Schema evolution of a catalog table: add columns it does not have yet."""
    if not columns:
        return
    body = ", ".join(f"{quote(n)} {t}" for n, t in columns)
    spark.sql(f"ALTER TABLE {qualified(db, table)} ADD COLUMNS ({body})")


def ensure_view(spark: SparkSession, db: str, view: str, table: str) -> None:
    """``CREATE VIEW db.view AS SELECT * FROM db.table`` when absent."""
    spark.sql(
        f"CREATE VIEW IF NOT EXISTS {qualified(db, view)} AS SELECT * FROM {qualified(db, table)}"
    )
