"""Loading several files of one dataset at once (K5, K9).

The result is that of loading them one after another in name order
(``operators/fold.py``): every file's rows are read and normalised, one
distinct and one fold decide which of them enter, and one append writes them.
Layers that follow take each key once, so rows of a key that came with a later
file than its first are kept from them (``later_entries``), as they would find
the key already stored.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import LakeConfig
from ..functions.keys import HASH_COL, with_row_hash
from ..operators.fold import FILE_COL, MAX_FOLD_FILES, day_files, file_bit, fold_new_rows
from ..operators.increment import MAX_PRUNE_VALUES, count_with_values, hot_keys, prune_to_batch
from ..operators.spec import DatasetSpec
from ..session import ensure_checkpoint_dir
from ..sources.files import read_csv
from ..sources.layers import heal_partitions, open_layer
from ..sources.taken import append_unfinished
from .conformed import _resolve, append_new, conformed_table, finished_rows, normalised_rows, quarantine_days
from .target import LoadResult, Target
from .typed import load_enriched, load_sandbox
from .warehouse import load_warehouse

NO_DAY = "__strata_no_day"


def files_rows(spark: SparkSession, targets: list[Target], spec: DatasetSpec) -> DataFrame | None:
    """Normalised rows of all files with their rank, and whether their
    partition value is no day; None if all are empty."""
    frames = []
    for rank, t in enumerate(targets):
        raw = read_csv(spark, t.path)
        if raw.columns:
            frames.append(normalised_rows(raw, spec, NO_DAY).withColumn(FILE_COL, F.lit(rank)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None


def load_files_at_once(
    spark: SparkSession,
    cfg: LakeConfig,
    targets: list[Target],
    spec: DatasetSpec,
    load_ts: _dt.datetime | None = None,
) -> list[LoadResult]:
    """Every flagged layer for files (in order) that share all of their targets.

    The conformed layer exists. Results: one per file for it, one for each
    layer that follows."""
    if len(targets) > MAX_FOLD_FILES:
        raise ValueError(f"{len(targets)} files: at most {MAX_FOLD_FILES} are loaded at once")
    t = targets[0]
    lt = conformed_table(cfg, t, spec)
    part = spec.partition_key
    results = [LoadResult("conformed", lt.path, incoming=0, new=0, partitions=[]) for _ in targets]
    rows = files_rows(spark, targets, spec)
    # One pass over the partition column alone: the days and their files, and
    # the files with values that are no day.
    found, load_ts = [], load_ts or _dt.datetime.now().replace(microsecond=0)
    if rows is not None:
        lost = F.bit_or(F.when(F.col(NO_DAY), file_bit(F.col(FILE_COL)))).alias("lost")
        per_day = rows.groupBy(part).agg(F.bit_or(file_bit(F.col(FILE_COL))).alias("files"), F.count(F.lit(1)).alias("n"), lost)
        found = per_day.limit(MAX_PRUNE_VALUES + 1).collect()
        if any(r["lost"] for r in found):
            _losses(spark, cfg, lt, targets, spec, rows, results, load_ts)
        rows = rows.drop(NO_DAY)
    days = [r[0] for r in found] if len(found) <= MAX_PRUNE_VALUES else None
    for rank, r in enumerate(results):
        r.partitions = None if days is None else [d[0] for d in found if d["files"] >> rank & 1]
        if r.partitions == []:
            r.notes.append("empty file")
    entered = None
    if found:
        raw_rows = sum(r["n"] for r in found) if days is not None else rows.count()
        entered = _append_files(spark, cfg, lt, t, spec, rows, found, days, raw_rows, results, load_ts)
    out = list(results)
    if t.runs("enrich_layer"):
        out.append(load_enriched(spark, cfg, t, spec, days, entered))
        if t.runs("edw_layer"):
            out.append(load_warehouse(spark, cfg, t, spec, out[-1].partitions))
    elif t.runs("edw_layer"):
        out.append(load_warehouse(spark, cfg, t, spec, None))
    if t.runs("sandbox_layer"):
        out.append(load_sandbox(spark, cfg, t, spec, days, entered))
    return out


def _losses(spark, cfg, lt, targets, spec, rows, results, load_ts) -> None:
    """Count and record the partition values that are no day, by file."""
    for rank, n in rows.filter(F.col(NO_DAY)).groupBy(FILE_COL).count().collect():
        results[rank].failed = {lt.partition_col: n}
        if cfg.quarantine:
            quarantine_days(spark, cfg, lt, read_csv(spark, targets[rank].path), spec, load_ts)


def _append_files(spark, cfg, lt, target, spec, rows, found, days, raw_rows, results, load_ts) -> DataFrame:
    """Fold, back up, append. Returns key, day and file of the new rows."""
    part = spec.partition_key
    died = append_unfinished(spark, lt.db, lt.table)
    heal_partitions(spark, lt, None if died else days)
    stored = open_layer(spark, lt)
    if cfg.full_counts:
        before = stored.count()
    hot = None
    if cfg.hot_key_rows is not None and raw_rows > cfg.hot_key_rows:
        keyed = rows if HASH_COL in rows.columns else with_row_hash(rows, [_resolve(rows, k) for k in spec.hash_keys])
        hot = hot_keys(keyed.select(HASH_COL), min_rows=cfg.hot_key_rows, rows=raw_rows) or None
    batch = finished_rows(rows, spec, load_ts)
    by_day = day_files(batch, part)
    if days is not None:
        by_day = spark.createDataFrame([(r[0], r["files"]) for r in found], by_day.schema)
    seen = Observation("files-incoming")
    pruned = prune_to_batch(stored, batch, part, days)
    new = fold_new_rows(batch, pruned, part, by_day, hot=hot, seen=seen).persist(StorageLevel.MEMORY_AND_DISK)
    # One pass computes the new rows and lists the days they land on; the rest
    # is read from what it kept.
    total, listed = count_with_values(new, part) if days is not None else (new.count(), None)
    incoming = seen.get
    new_of = {r[0]: r[1] for r in new.groupBy(FILE_COL).count().collect()} if total else {}
    for rank, r in enumerate(results):
        r.incoming, r.new = int(incoming[f"f{rank}"]), new_of.get(rank, 0)
        if cfg.full_counts:
            r.existing, r.after = before, before + r.new
            before = r.after
    try:
        # Cut off from the layer, which from here on holds these rows.
        ensure_checkpoint_dir(spark)
        entered = new.select(HASH_COL, part, FILE_COL).checkpoint()
        backup = append_new(spark, cfg, lt, target, stored, new.drop(FILE_COL), total, days, listed, died)
    finally:
        new.unpersist()
    for r in results:
        r.backup = backup if r.new else None
    return entered
