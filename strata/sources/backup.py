"""Backups of a layer that copy only what no kept backup holds.

Layer files are written once and never changed, so a file that an earlier
backup holds need not be copied again. A backup is a manifest: the layer's
files (path, length, time) and for each the data folder that holds its rows.

    <backup>/data/<id>/        rows of the files that were new to backup <id>
    <backup>/manifests/<id>/   the files of backup <id>, each with its folder

Making one lists the layer, copies the rows of new files in one Spark job
(flat, in files of a good size, with the file each row came from) and then
writes the manifest; a backup without a complete manifest does not count. Data
folders are counted by the manifests that name them and go when none is left.
A restore reads the folders a manifest names and keeps the rows of its files,
so it gives the table as it was, also where files have gone from the layer or
came later. Every folder has its row count and a checksum over its rows.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .layers import LayerTable, save_to_layer

#: Column of a data folder: the layer file that a row came from.
FILE = "__backup_file"
_KEY = ["path", "length", "modified"]


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _names(spark: SparkSession, folder: str, complete: bool) -> list[str]:
    fs, path = _filesystem(spark, folder)
    if not fs.exists(path(folder)):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(path(folder))]
    return sorted(n for n in found if not complete or fs.exists(path(f"{folder}/{n}/_SUCCESS")))


def layer_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """(path, length, modified) of a layer's files; no byte of them is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{fmt}")
    m = F.col("_metadata")
    return files.load(path).select(
        m["file_path"].alias("path"), m["file_size"].alias("length"), m["file_modification_time"].alias("modified")
    )


def _checksum(columns: list[str]) -> list[Column]:
    """Rows, and a sum over hashes of whole rows in any order."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0)).cast("string").alias("checksum")]


def backups(spark: SparkSession, root: str) -> list[str]:
    """Complete backups below ``root``, oldest first (paths of manifests)."""
    return [f"{root}/manifests/{n}" for n in _names(spark, f"{root}/manifests", complete=True)]


def backup_files(spark: SparkSession, lt: LayerTable, stored: DataFrame, root: str, keep: int = 1) -> str | None:
    """Back up a layer (``stored`` has its columns) below ``root``; the ``keep``
    last backups stay. Returns the backup (the path of its manifest)."""
    listing = layer_files(spark, lt.path, lt.fmt)
    older = backups(spark, root)
    last = spark.read.parquet(older[-1]) if older else None
    fresh = listing if last is None else listing.join(last.select(*_KEY), _KEY, "left_anti")
    n, since = fresh.agg(F.count(F.lit(1)), F.min("modified")).first()
    if not n and last is not None and last.join(listing, _KEY, "left_anti").isEmpty():
        return older[-1]  # it holds exactly these files
    name = f"{_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S%f}"
    columns = stored.columns
    counted = {"rows": 0, "checksum": "0"}
    if n:
        # Read by path: files that the catalog does not show are backed up too.
        stored = spark.read.schema(stored.schema).format(lt.fmt).load(lt.path)
        at = F.col("_metadata.file_path")
        rows = stored.select(*[F.col(f"`{c}`") for c in columns], at.alias(FILE), F.col("_metadata.file_modification_time").alias("__at"))
        if last is not None:
            # The time leaves older files unread, the join makes the cut exact.
            rows = rows.filter(F.col("__at") >= F.lit(since)).join(fresh.select(F.col("path").alias(FILE)), FILE, "left_semi")
        seen = Observation("backup")
        rows = rows.select(*[F.col(f"`{c}`") for c in columns], FILE).observe(seen, *_checksum(columns))
        rows.hint("rebalance").write.parquet(f"{root}/data/{name}")
        counted = seen.get
    manifest = fresh.withColumns(
        {"folder": F.lit(name), "rows": F.lit(counted["rows"]).cast("bigint"), "checksum": F.lit(counted["checksum"])}
    )
    if last is not None:
        manifest = manifest.unionByName(last.join(listing.select(*_KEY), _KEY, "left_semi").select(manifest.columns))
    manifest.coalesce(1 if n < 100_000 else 16).write.parquet(f"{root}/manifests/{name}")
    _forget(spark, root, keep)
    return f"{root}/manifests/{name}"


def _forget(spark: SparkSession, root: str, keep: int) -> None:
    """Delete manifests but the last ``keep``, then folders none of them names."""
    fs, path = _filesystem(spark, root)
    complete = backups(spark, root)
    gone = [f"{root}/manifests/{n}" for n in _names(spark, f"{root}/manifests", complete=False)]
    for m in gone:
        if m not in complete[-keep:]:
            fs.delete(path(m), True)
    named = {f for m in complete[-keep:] for f in folders(spark, m)}
    for f in _names(spark, f"{root}/data", complete=False):
        if f not in named:
            fs.delete(path(f"{root}/data/{f}"), True)


def folders(spark: SparkSession, backup: str) -> list[str]:
    """Data folders of a backup: one for each append that one was made before."""
    return sorted(r[0] for r in spark.read.parquet(backup).select("folder").distinct().collect())


def _root(backup: str) -> str:
    return backup.rsplit("/manifests/", 1)[0]


def restored_rows(spark: SparkSession, backup: str) -> DataFrame:
    """All rows of the layer as it was at the backup."""
    data = [f"{_root(backup)}/data/{f}" for f in folders(spark, backup)]
    rows = [spark.read.parquet(d) for d in data]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    files = spark.read.parquet(backup).select(F.col("path").alias(FILE))
    return both.join(files, FILE, "left_semi").drop(FILE)


def restore_layer(spark: SparkSession, lt: LayerTable, backup: str) -> None:
    """Write a backup's rows to the layer's path, which must be empty."""
    save_to_layer(spark, lt, restored_rows(spark, backup), None, mode="errorifexists")


def verify_backup(spark: SparkSession, backup: str) -> DataFrame:
    """(folder, rows, checksum, intact): each data folder read back and
    compared with what was recorded when it was written."""
    recorded = spark.read.parquet(backup).select("folder", "rows", "checksum").distinct()
    found = []
    for f in folders(spark, backup):
        data = spark.read.parquet(f"{_root(backup)}/data/{f}")
        columns = [c for c in data.columns if c != FILE]
        found.append(data.agg(*_checksum(columns)).select(F.lit(f).alias("folder"), F.struct("rows", "checksum").alias("now")))
    checked = recorded.join(reduce(DataFrame.unionByName, found), "folder")
    return checked.select("folder", "rows", "checksum", (F.struct("rows", "checksum") == F.col("now")).alias("intact"))
