"""Conformed layer load (K5).

Pure part, ``conformed_batch``: clean names (C2) -> partition day (C5) ->
distinct (I1/I2) -> hash key (C3) -> audit columns (C4). Doing the distinct
once, after normalisation, equals the distinct-then-distinct-again of a
row-at-a-time flow: the steps before it are per-row and deterministic. A key
that includes the partition column hashes the text as it arrived.

Side-effect part, ``load_conformed``: one cheap pass collects the batch's
partition days (one column of the file), the stored side is pruned to them,
the new rows are computed once and kept (count, backup gate, write), then
the layer is registered in the catalog.
"""

from __future__ import annotations

import datetime as _dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import LakeConfig, join_path
from ..functions.keys import HASH_COL, partition_day, with_audit_columns, with_partition_day, with_row_hash
from ..functions.names import clean_columns
from ..operators.failures import failed_cells, failed_day
from ..operators.increment import (
    MAX_PRUNE_VALUES,
    count_with_values,
    hot_keys,
    new_lake_rows,
    prune_to_batch,
    prune_to_values,
)
from ..operators.membership import new_rows_by_bitmap, observed_rows
from ..operators.spec import DatasetSpec, spelled
from ..session import ensure_checkpoint_dir
from ..sources.backup import backup_files
from ..sources.catalog import LOGGED_FORMATS
from ..sources.daybits import SUFFIX, DayBitmaps
from ..sources.files import read_csv
from ..sources.quarantine import SUFFIX as FAILED
from ..sources.quarantine import record_failures
from ..sources.layers import LayerTable, heal_partitions, open_layer, save_to_layer, snapshot_layer
from ..sources.taken import append_unfinished, begin_append, end_append, source_version
from .target import LoadResult, Target


def _resolve(df: DataFrame, name: str) -> str:
    lower = {c.lower(): c for c in df.columns}
    if name.lower() not in lower:
        raise ValueError(f"column {name!r} declared in the metadata is not in the file")
    return lower[name.lower()]


def conformed_batch(raw: DataFrame, spec: DatasetSpec, load_ts=None) -> DataFrame:
    """The conformed rows of one incoming batch (pure; no action).

    The distinct groups on the data columns only. The hash is a function of
    them, so it is added after the distinct — unless the partition column is
    a hash input, in which case the hash must see the raw text and is taken
    first. The audit columns are constants and come last.
    """
    return finished_rows(normalised_rows(raw, spec), spec, load_ts)


def normalised_rows(raw: DataFrame, spec: DatasetSpec, no_day: str | None = None) -> DataFrame:
    """Clean names and the partition day, row by row. The hash is taken here
    only if it needs the raw text of the partition column. A column ``no_day``
    tells whether that text was no day."""
    df = spelled(clean_columns(raw), spec.partition_key)
    keys = [_resolve(df, k) for k in spec.hash_keys]
    part = _resolve(df, spec.partition_key)
    if no_day is not None:
        lost = [t[3] for t in failed_day(df, part)]
        df = df.withColumn(no_day, lost[0] if lost else F.lit(False))
    return with_partition_day(with_row_hash(df, keys) if part in keys else df, part)


def finished_rows(rows: DataFrame, spec: DatasetSpec, load_ts=None) -> DataFrame:
    """Distinct normalised rows with hash and audit columns."""
    df = rows.distinct()
    if HASH_COL not in df.columns:
        df = with_row_hash(df, [_resolve(df, k) for k in spec.hash_keys])
    return with_audit_columns(df, load_ts)


def batch_days(raw: DataFrame, spec: DatasetSpec) -> tuple[list | None, int]:
    """Distinct partition days of a batch and its raw row count."""
    return batch_days_and_losses(raw, spec)[:2]


def batch_days_and_losses(raw: DataFrame, spec: DatasetSpec) -> tuple[list | None, int, int]:
    """Distinct partition days of a batch, its raw row count, and how many of
    its partition values are no day.

    One pass reading only the partition column: rows are counted per day and
    at most ``MAX_PRUNE_VALUES + 1`` (day, count) pairs reach the driver.
    Above that the days are None (too many for a static list).
    """
    df = clean_columns(raw)
    part = _resolve(df, spec.partition_key)
    day = partition_day(part, df.schema[part].dataType).alias("day")
    lost = F.count(F.col(f"`{part}`"))  # values of rows without a day
    rows = df.groupBy(day).agg(F.count(F.lit(1)).alias("n"), lost.alias("lost")).limit(MAX_PRUNE_VALUES + 1).collect()
    if len(rows) > MAX_PRUNE_VALUES:
        n, no_day = df.agg(F.count(F.lit(1)), F.count_if(F.col(f"`{part}`").isNotNull() & day.isNull())).first()
        return None, n, no_day
    return [r["day"] for r in rows], sum(r["n"] for r in rows), sum(r["lost"] for r in rows if r["day"] is None)


def quarantine_days(spark: SparkSession, cfg: LakeConfig, lt: LayerTable, raw: DataFrame, spec: DatasetSpec, load_ts) -> None:
    """Record the partition values of ``raw`` that are no day."""
    df = spelled(clean_columns(raw), spec.partition_key)
    df = with_row_hash(df, [_resolve(df, k) for k in spec.hash_keys])
    cells = failed_cells(df, failed_day(df, _resolve(df, spec.partition_key)))
    record_failures(spark, lt.db, lt.table + FAILED, lt.path.rstrip("/") + FAILED, cells, load_ts)


def batch_hot_keys(
    raw: DataFrame, spec: DatasetSpec, min_rows: int | None, rows: int | None = None
) -> list | None:
    """Hash keys with more than ``min_rows`` of the batch's raw ``rows``.

    Counted on the raw rows (reading the key columns only): a key is at least
    as frequent there as after de-duplication, and treating a key as hot is
    exact either way.
    """
    if min_rows is None:
        return None
    df = clean_columns(raw)
    keys = [_resolve(df, k) for k in spec.hash_keys]
    return hot_keys(with_row_hash(df.select(*keys), keys), min_rows=min_rows, rows=rows) or None


def conformed_table(cfg: LakeConfig, target: Target, spec: DatasetSpec) -> LayerTable:
    return LayerTable(
        cfg.layer_path("conformed", target.subpath),
        cfg.conformed_db,
        target.catalog_table,
        spec.partition_key,
        cfg.fmt,
    )


def append_new(
    spark: SparkSession,
    cfg: LakeConfig,
    lt: LayerTable,
    target: Target,
    stored: DataFrame,
    new: DataFrame,
    rows: int,
    days: list | None,
    touched: list | None,
    died: bool,
) -> str | None:
    """Back up what is stored (A7), then append ``new`` (A6), unless there are
    no ``rows``. ``touched`` are the days that receive rows. Returns the backup."""
    part, backup = lt.partition_col, None
    if rows > 0:
        scope = "table" if cfg.fmt in LOGGED_FORMATS and cfg.backup_scope == "files" else cfg.backup_scope
        root = join_path(cfg.backup, target.subpath)
        if scope == "table":
            before = stored
        elif scope == "partitions" and touched is not None:
            before = prune_to_values(stored, part, touched)
        elif scope == "partitions":  # too many days to list: semi-join on the new rows' days
            before = prune_to_batch(stored, new, part)
        if scope == "files":
            backup = backup_files(spark, lt, stored, root, cfg.backups_kept)
        else:
            backup = snapshot_layer(before, root, part, cfg.fmt, keep_if_empty=scope != "table")
        begin_append(spark, lt.db, lt.table, days)
        save_to_layer(spark, lt, new, touched, mode="append")
    elif died:  # the rows it left are new to every target
        begin_append(spark, lt.db, lt.table, None)
    if died or rows > 0:
        end_append(spark, lt.db, lt.table)
    return backup


def load_conformed(
    spark: SparkSession,
    cfg: LakeConfig,
    target: Target,
    spec: DatasetSpec,
    load_ts: _dt.datetime | None = None,
) -> LoadResult:
    load_ts = load_ts or _dt.datetime.now().replace(microsecond=0)
    lt = conformed_table(cfg, target, spec)
    result = LoadResult("conformed", lt.path)
    raw = read_csv(spark, target.path)
    part = spec.partition_key
    days, raw_rows, no_day = batch_days_and_losses(raw, spec) if raw.columns else ([], 0, 0)
    if raw_rows == 0:  # D6: nothing to load, nothing written
        result.notes.append("empty file")
        result.partitions = []
        result.incoming = result.new = 0
        return result
    result.partitions = days
    if no_day:
        result.failed = {part: no_day}
        if cfg.quarantine:
            quarantine_days(spark, cfg, lt, raw, spec, load_ts)
    # After an append that died, whatever it wrote on any day is recorded.
    died = append_unfinished(spark, lt.db, lt.table)
    heal_partitions(spark, lt, None if died else days)
    stored = open_layer(spark, lt)
    batch = conformed_batch(raw, spec, load_ts)
    seen = Observation("incoming")

    if stored is None:
        # A5: the first load creates the table.
        batch = batch.observe(seen, F.count(F.lit(1)).alias("rows"))
        save_to_layer(spark, lt, batch, days, mode="errorifexists")
        end_append(spark, lt.db, lt.table)
        result.created, result.existing = True, 0
        result.incoming = result.new = result.after = int(seen.get["rows"])
        return result

    if cfg.full_counts:
        result.existing = stored.count()
    # No key can pass the threshold unless the whole batch does.
    hot = None
    if cfg.hot_key_rows is not None and raw_rows > cfg.hot_key_rows:
        hot = batch_hot_keys(raw, spec, cfg.hot_key_rows, raw_rows)
    maps, sure, may = None, Observation("surely-new"), Observation("looked-up")
    present = source_version(spark, lt.db, lt.table)
    if cfg.membership_bits and days is not None and present and cfg.fmt not in LOGGED_FORMATS:
        maps = DayBitmaps(spark, lt.db, lt.table + SUFFIX, lt.path.rstrip("/") + SUFFIX, cfg.membership_bits, part)
        bitmaps = maps.bitmaps(present)
        bitmaps = maps.of_days(maps.build(stored, present) if bitmaps is None else bitmaps, days)
        pruned = prune_to_values(stored, part, days)
        new = new_rows_by_bitmap(batch, pruned, bitmaps, maps.bits, hot=hot, sure_seen=sure, may_seen=may)
    else:
        new = new_lake_rows(batch.observe(seen, F.count(F.lit(1)).alias("rows")), stored, part, days, hot=hot)
    new = new.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # Days that receive rows: the only partitions this append changes or
        # creates. A subset of the batch's bounded day list, so they are
        # gathered by the counting pass itself.
        if days is not None:
            result.new, touched = count_with_values(new, part)
        else:
            result.new, touched = new.count(), None
        if maps is None:
            result.incoming = int(seen.get["rows"])
        else:
            result.looked_up = observed_rows(may)
            result.incoming = observed_rows(sure) + result.looked_up
            if result.new > 0:
                ensure_checkpoint_dir(spark)
                added = new.select(HASH_COL, part).checkpoint()
        result.backup = append_new(spark, cfg, lt, target, stored, new, result.new, days, touched, died)
        if maps is not None and result.new > 0:
            maps.append(added, source_version(spark, lt.db, lt.table))
    finally:
        new.unpersist()
    if cfg.full_counts:
        result.after = result.existing + result.new
    return result
