"""Metadata loads (K1, K2): CSV -> catalog table, replacing the previous one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import LakeConfig
from ..operators.spec import dataset_spec, DatasetSpec
from ..sources.catalog import qualified
from ..sources.metadata import read_business_csv, read_technical_csv, save_metadata


def load_business_metadata(spark: SparkSession, cfg: LakeConfig, csv_path: str) -> int:
    df = read_business_csv(spark, csv_path)
    save_metadata(df, cfg.metadata_db, cfg.business_table)
    return spark.table(qualified(cfg.metadata_db, cfg.business_table)).count()


def load_technical_metadata(spark: SparkSession, cfg: LakeConfig, csv_path: str) -> int:
    df = read_technical_csv(spark, csv_path)
    save_metadata(df, cfg.metadata_db, cfg.technical_table)
    return spark.table(qualified(cfg.metadata_db, cfg.technical_table)).count()


def business_table(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    return spark.table(qualified(cfg.metadata_db, cfg.business_table))


def technical_table(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    return spark.table(qualified(cfg.metadata_db, cfg.technical_table))


def spec_for(spark: SparkSession, cfg: LakeConfig, dataset: str) -> DatasetSpec:
    return dataset_spec(technical_table(spark, cfg), dataset)
