"""Metadata tables (A9, A10, A11): load from CSV, read back, look up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.routing import BUSINESS_COLUMNS
from ..operators.spec import TECH_COLUMNS, dataset_rows
from .catalog import ensure_database, qualified
from .files import read_csv


def _require(df: DataFrame, columns, what: str) -> None:
    have = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    if missing:
        raise ValueError(f"{what} metadata is missing columns {missing}")


def read_business_csv(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv(spark, path)
    _require(df, BUSINESS_COLUMNS, "business")
    return df


def read_technical_csv(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv(spark, path)
    _require(df, TECH_COLUMNS, "technical")
    # colseq is declared INT; everything else stays text.
    return df.withColumn("colseq", F.col("colseq").try_cast("int"))


def save_metadata(df: DataFrame, db: str, table: str) -> None:
    """Replace the metadata table with the CSV's rows."""
    spark = df.sparkSession
    ensure_database(spark, db)
    df.write.mode("overwrite").format("parquet").saveAsTable(qualified(db, table))
