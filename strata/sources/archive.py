"""Raw archive of incoming files.

The folder's lines are read by Spark's text source (in parallel, split by
the cluster), joined on the file path with the routed files whose dataset
keeps a raw copy, and written under ``root/database/yyyy/mm/dd/file_name``
partitions with dynamic partition overwrite: archiving the same file again
on the same day replaces its earlier copy instead of doubling it. No file
list passes through the driver. Lines keep the order in which a task reads
them as long as the writer's sort on the partition columns does not spill.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.broadcast import broadcast_join
from .files import top_entry
from .layers import _text_partitions

# Archive partition columns, outermost first.
ARCHIVE_PARTITIONS = ("root", "database", "yyyy", "mm", "dd", "file_name")


def archive_frame(
    spark: SparkSession,
    routes: DataFrame,
    source: str | list[str],
    day: _dt.date,
    folder: str | None = None,
) -> DataFrame:
    """Raw lines of the routed files, tagged with their archive partition.

    ``routes`` has ``path``, ``name``, ``deltaLake_root`` and
    ``delta_database_name`` (one row per entry and dataset). ``source`` is
    what is read (the incoming folder, or a list of entries); ``folder`` is
    the incoming folder, whose direct entries the lines are mapped back to.
    """
    folder = folder or (source if isinstance(source, str) else None)
    targets = routes.select(
        F.col("path").alias("src_path"),
        F.col("name").alias("file_name"),
        F.col("deltaLake_root").alias("root"),
        F.col("delta_database_name").alias("database"),
    ).distinct()
    # The metadata column is URI-encoded, the listing is not; a plus sign is
    # itself in both.
    src = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .text(source)
        .select(F.col("value"), (top_entry(src, folder) if folder else src).alias("src_path"))
    )
    # Broadcast (size-checked, chunked beyond the limit): the lines are never
    # shuffled, so a large file is not funnelled into one task and its lines
    # stay in order.
    return broadcast_join(lines, targets, "src_path").select(
        "value",
        "root",
        "database",
        F.lit(f"{day.year:04d}").alias("yyyy"),
        F.lit(f"{day.month:02d}").alias("mm"),
        F.lit(f"{day.day:02d}").alias("dd"),
        "file_name",
    )


def archive_files(
    spark: SparkSession,
    routes: DataFrame,
    source: str | list[str],
    archive_path: str,
    day: _dt.date | None = None,
    folder: str | None = None,
) -> None:
    """Archive the routed entries read from ``source``."""
    day = day or _dt.date.today()
    _write(archive_frame(spark, routes, source, day, folder), archive_path)
    lost = missing_files(spark, routes, archive_path, day)
    if lost:
        raise RuntimeError(f"routed files without archived lines: {lost}")


def missing_files(spark: SparkSession, routes: DataFrame, archive_path: str, day: _dt.date, show: int = 20) -> list[str]:
    """Some of the routed, non-empty files that the day's archive lacks (by
    listing the archive; no line is read). Routes without a ``length`` are not
    checked: nothing tells whether such a file has lines."""
    if "length" not in routes.columns:
        return []
    with _text_partitions(spark):
        kept = spark.read.format("binaryFile").load(archive_path)
    of_day = (F.col("yyyy") == f"{day.year:04d}") & (F.col("mm") == f"{day.month:02d}") & (F.col("dd") == f"{day.day:02d}")
    kept = kept.filter(of_day & (F.col("length") > 0)).select("root", "database", "file_name").distinct()
    wanted = routes.filter("length > 0").select(
        F.col("deltaLake_root").alias("root"), F.col("delta_database_name").alias("database"), F.col("name").alias("file_name")
    )
    lost = wanted.distinct().join(kept, ["root", "database", "file_name"], "left_anti").limit(show).collect()
    return [r["file_name"] for r in lost]


def _write(frame: DataFrame, archive_path: str) -> None:
    (
        frame.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*ARCHIVE_PARTITIONS)
        .text(archive_path)
    )
