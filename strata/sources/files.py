"""Incoming files: format gate, CSV scan and folder listing (A1, A2, A3)."""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

# The only accepted file type, tested as a substring of the path.
SUPPORTED_MARK = ".csv"

LISTING_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("d_name", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modificationTime", T.TimestampType()),
    ]
)


def check_format(path: str) -> None:
    """A2: refuse anything that is not a CSV before reading it."""
    if SUPPORTED_MARK not in path:
        raise ValueError(f"{path}: file type is not supported (only {SUPPORTED_MARK})")


def read_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """A1: header CSV, every column a string (no schema inference)."""
    check_format(path)
    reader = spark.read.option("header", True).option("inferSchema", False)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def _is_missing(exc: AnalysisException) -> bool:
    cond = getattr(exc, "getCondition", None)
    name = cond() if callable(cond) else None
    text = str(exc)
    return name in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA") or "PATH_NOT_FOUND" in text


def _path_part(folder: str) -> str:
    """The path of a folder URI without scheme and authority."""
    parsed = urlparse(folder)
    return (parsed.path if parsed.scheme else folder).rstrip("/")


def top_entry(path: Column, folder: str) -> Column:
    """The entry directly under ``folder`` that holds ``path``.

    A file in the folder is its own entry; a file deeper down (a part file of
    a directory-style feed) maps to the directory directly under the folder.
    """
    store = r"(?:[A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]*)?)?"
    pattern = r"^(" + store + r"\Q" + _path_part(folder) + r"\E/[^/]+)"
    entry = F.regexp_extract(path, pattern, 1)
    return F.when(entry == F.lit(""), path).otherwise(entry)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """A3: one row per entry directly in ``folder``: (path, name, d_name, ...).

    Entries are files or directories (a directory is read whole as one
    file). The ``binaryFile`` source lists in parallel on the cluster and,
    because ``content`` is never selected, reads no file bytes; leaf files
    are mapped to their entry and grouped.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    except AnalysisException as exc:
        if _is_missing(exc):
            return spark.createDataFrame([], LISTING_SCHEMA)
        raise
    entries = files.groupBy(top_entry(F.col("path"), folder).alias("path")).agg(
        F.sum("length").alias("length"), F.max("modificationTime").alias("modificationTime")
    )
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return entries.select(
        F.col("path"),
        name.alias("name"),
        F.replace(name, F.lit("__"), F.lit("_")).alias("d_name"),
        F.col("length"),
        F.col("modificationTime"),
    )
