"""Warehouse tables as catalog tables.

The warehouse is a pair of catalog databases per schema: ``<schema>`` for the
typed target and ``staging_<schema>`` for the batch being inserted. New rows
are staged as a table, then inserted set-wise with a ``DISTINCT``, matched to
the target by column name; columns the target lacks are added first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import HASH_COL
from .catalog import add_columns, qualified


def read_warehouse(spark: SparkSession, db: str, table: str) -> DataFrame:
    """A12."""
    return spark.table(qualified(db, table))


def write_staging(df: DataFrame, db: str, table: str) -> None:
    """Replace (or create) the staging table with the batch."""
    df.write.mode("overwrite").format("parquet").saveAsTable(qualified(db, table))


def insert_from_staging(
    spark: SparkSession,
    staging_db: str,
    target_db: str,
    table: str,
    cluster_cols: list[str] | None = None,
) -> int:
    """``INSERT INTO target BY NAME SELECT DISTINCT ... FROM staging``.

    Rows are dealt to files by ranges of the cluster columns, descending, and
    sorted within each, so file min/max statistics prune reads on those
    columns. The row hash closes the range key: one cluster value that holds
    many rows spreads over several files. Returns the number of rows inserted.
    """
    staged = spark.table(qualified(staging_db, table))
    target = spark.table(qualified(target_db, table))
    have = {f.name.lower() for f in target.schema.fields}
    extra = [f for f in staged.schema.fields if f.name.lower() not in have]
    add_columns(spark, target_db, table, [(f.name, f.dataType.simpleString()) for f in extra])
    if extra:
        target = spark.table(qualified(target_db, table))

    staged_names = {c.lower(): c for c in staged.columns}
    select = []
    for f in target.schema.fields:
        src = staged_names.get(f.name.lower())
        value = F.col(src) if src is not None else F.lit(None)
        select.append(value.cast(f.dataType).alias(f.name))
    rows = staged.select(*select).distinct()
    if cluster_cols:
        order = [F.col(c).desc() for c in cluster_cols]
        tie = [F.col(HASH_COL)] if HASH_COL in rows.columns else [F.xxhash64(*rows.columns)]
        rows = rows.repartitionByRange(*order, *tie).sortWithinPartitions(*order)
    obs = Observation("inserted")
    rows.observe(obs, F.count(F.lit(1)).alias("rows")).write.insertInto(
        qualified(target_db, table)
    )
    inserted = obs.get.get("rows")
    # No metrics when there was nothing to observe.
    return rows.count() if inserted is None else int(inserted)
