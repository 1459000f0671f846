"""Enriched and sandbox layer loads (K6, K7).

Both read the conformed layer, cast the declared columns to their lake types
(C7), pass undeclared columns through (C9) and append the distinct rows
whose hash is not in the target layer yet (E1, I2). The target is pruned to
the days of the whole conformed layer, which hold all of its rows, so its
whole hash column is the stored side: a hash the target holds on any day
blocks the row.

``partitions`` restricts the *batch* to the conformed days one load touched
(a static filter, so only those conformed folders are read), if the record of
``sources/taken.py`` says that the target has taken all the others. If it does
not (a target switched off for some loads, or a load that failed), or with
``None``, the whole conformed layer is read.
"""

from __future__ import annotations

import datetime as _dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import LakeConfig
from ..functions.keys import HASH_COL
from ..operators.failures import failed_cast, failed_cells, observe_failures, observed_failures
from ..operators.fold import keys_besides, later_entries, without_later
from ..operators.increment import (
    anti_join_new,
    count_with_values,
    hot_keys,
    partition_counts,
    partition_values,
    prune_to_values,
)
from ..operators.project import typed_projection
from ..operators.spec import DatasetSpec
from ..session import ensure_checkpoint_dir
from ..sources.catalog import LOGGED_FORMATS
from ..sources.keyindex import SUFFIX, KeyIndex, new_by_index
from ..sources.quarantine import SUFFIX as FAILED
from ..sources.quarantine import record_failures
from ..sources.layers import LayerTable, heal_partitions, open_layer, save_to_layer, try_read_layer
from ..sources.taken import append_unfinished, begin_append, end_append, rest_taken, set_taken, source_version
from .conformed import conformed_table
from .target import LoadResult, Target


def typed_batch(conformed: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Typed, distinct rows of the conformed layer (pure)."""
    return typed_projection(conformed, spec, "lake").distinct()


def typed_after_load(stored: DataFrame | None, conformed: DataFrame, spec: DatasetSpec) -> DataFrame:
    """All rows of a typed layer after one load (pure): what is stored, and
    the typed conformed rows whose hash it does not hold."""
    batch = typed_batch(conformed, spec)
    return batch if stored is None else stored.unionByName(anti_join_new(batch, stored, HASH_COL), allowMissingColumns=True)


def typed_table(cfg: LakeConfig, layer: str, target: Target, spec: DatasetSpec) -> LayerTable:
    part = spec.partition_key
    ptype = next(c for c in spec.columns if c.name == part).lake()
    return LayerTable(
        cfg.layer_path(layer, target.subpath),
        cfg.layer_db(layer),
        target.catalog_table,
        part,
        cfg.fmt,
        ptype.spark_type,
    )


def account_failures(spark, cfg, lt: LayerTable, rows: DataFrame, tests: list, lost: Observation, result: LoadResult) -> None:
    """Lost values of the rows a load has read: counted in its result and,
    where there are any, recorded in the layer's quarantine table."""
    result.failed = observed_failures(tests, lost)
    if result.failed and cfg.quarantine:
        cells = failed_cells(rows, [t for t in tests if t[0] in result.failed])
        load_ts = _dt.datetime.now().replace(microsecond=0)
        record_failures(spark, lt.db, lt.table + FAILED, lt.path.rstrip("/") + FAILED, cells, load_ts)


def layer_index(spark: SparkSession, cfg: LakeConfig, lt: LayerTable) -> KeyIndex | None:
    if not cfg.key_index or lt.fmt in LOGGED_FORMATS:
        return None
    return KeyIndex(spark, lt.db, lt.table + SUFFIX, lt.path.rstrip("/") + SUFFIX, cfg.key_buckets)


def typed_partition_texts(spark: SparkSession, values: list, dtype: str | None) -> list:
    """Conformed partition texts -> the text form of the lake-typed value.

    Runs on Spark over the (bounded) value list, so the conversion is the
    same cast the typed projection applies.
    """
    if dtype is None:
        return list(values)
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select(F.col("v").try_cast(dtype).cast("string")).distinct().collect()
    return [r[0] for r in rows]


def read_typed_layer(spark: SparkSession, path: str, spec: DatasetSpec, fmt: str = "parquet"):
    """A typed layer read by path, its partition column back in its declared type."""
    df = try_read_layer(spark, path, fmt)
    if df is None:
        return None
    part = spec.partition_key
    ptype = next(c for c in spec.columns if c.name == part).lake()
    return df.withColumn(part, F.col(part).try_cast(ptype.spark_type))


def load_typed_layer(
    spark: SparkSession,
    cfg: LakeConfig,
    layer: str,
    target: Target,
    spec: DatasetSpec,
    partitions: list | None = None,
    entered: DataFrame | None = None,
) -> LoadResult:
    """``entered``: key, day and file of the rows that several files loaded at
    once gave the conformed layer; the layer ends up as if it had been loaded
    after each of them."""
    src = conformed_table(cfg, target, spec)
    dst = typed_table(cfg, layer, target, spec)
    result = LoadResult(layer, dst.path)
    part = spec.partition_key

    conformed = open_layer(spark, src)
    if conformed is None:
        result.notes.append("no conformed layer")
        return result
    version = source_version(spark, src.db, src.table)
    tests, lost = failed_cast(conformed, spec), Observation(f"{layer}-lost")
    cut = (
        partitions is not None
        and open_layer(spark, dst) is not None
        and rest_taken(spark, (src.db, src.table), (dst.db, dst.table), partitions)
    )
    whole = conformed
    if cut:
        if not partitions:
            result.notes.append("no partitions to load")
            result.partitions = []
            result.incoming = result.new = 0
            return result
        conformed = prune_to_values(conformed, part, partitions)
    if entered is not None:
        # Keys stored before the files are all in a target that has the rest.
        later = later_entries(entered, part, None if cut else keys_besides(whole, entered, part))
        if not later.isEmpty():
            conformed = without_later(conformed, later, part)
    batch = typed_batch(observe_failures(conformed, tests, lost), spec)
    # One pass over the conformed partition column (no data columns): the
    # days the batch really holds and its row count. The days are turned
    # into the lake type's text form, as the target stores them; None above
    # the listing limit.
    conformed_days, conformed_rows = partition_counts(conformed, part, part)
    if conformed_rows == 0:
        result.notes.append("no conformed rows to load")
        result.partitions = []
        result.incoming = result.new = 0
        return result
    if conformed_days is not None:
        days = typed_partition_texts(spark, conformed_days, dst.partition_type)
    else:
        days = partition_values(batch, part)
    result.partitions = days
    died = append_unfinished(spark, dst.db, dst.table)
    heal_partitions(spark, dst, None if died else days)
    stored = open_layer(spark, dst)

    if stored is None:
        seen = Observation(f"{layer}-created")
        save_to_layer(
            spark, dst, batch.observe(seen, F.count(F.lit(1)).alias("rows")), days, mode="errorifexists"
        )
        end_append(spark, dst.db, dst.table)
        index = layer_index(spark, cfg, dst)
        if index is not None:
            index.build(spark.table(dst.name), source_version(spark, dst.db, dst.table))
        set_taken(spark, (dst.db, dst.table), version)
        result.created, result.existing = True, 0
        result.incoming = result.new = result.after = int(seen.get["rows"])
        account_failures(spark, cfg, dst, conformed, tests, lost, result)
        return result

    result.incoming = conformed_rows
    if cfg.full_counts:
        result.existing = stored.count()
    # No key can pass the threshold unless the whole batch does.
    hot = None
    if cfg.hot_key_rows is not None and conformed_rows > cfg.hot_key_rows:
        hot = hot_keys(conformed.select(HASH_COL), min_rows=cfg.hot_key_rows, rows=conformed_rows) or None
    # The stored side is the target's whole (de-duplicated) hash column: the
    # target is compared against every conformed day, and its days are a
    # subset of those, so no partition of it can be skipped.
    # Its hashes lie in the key index.
    index, keys = layer_index(spark, cfg, dst), None
    present = source_version(spark, dst.db, dst.table)
    if index is not None and present:
        keys = index.keys(present)
        keys = index.build(stored, present) if keys is None else keys
    new = anti_join_new(batch, stored, HASH_COL, hot) if keys is None else new_by_index(batch, keys, HASH_COL, hot)
    new = new.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if days is not None:
            result.new, touched = count_with_values(new, part)
        else:
            result.new, touched = new.count(), None
        account_failures(spark, cfg, dst, conformed, tests, lost, result)
        if result.new > 0:
            if keys is not None:
                ensure_checkpoint_dir(spark)
                keys = new.select(HASH_COL).checkpoint()
            begin_append(spark, dst.db, dst.table, days)
            save_to_layer(spark, dst, new, touched, mode="append")
        elif died:  # the rows it left are new to the warehouse
            begin_append(spark, dst.db, dst.table, None)
        if died or result.new > 0:
            end_append(spark, dst.db, dst.table)
        if result.new > 0 and keys is not None:
            index.append(keys, source_version(spark, dst.db, dst.table))
    finally:
        new.unpersist()
    set_taken(spark, (dst.db, dst.table), version)
    if cfg.full_counts:
        result.after = result.existing + result.new
    return result


def load_enriched(spark, cfg, target, spec, partitions=None, entered=None) -> LoadResult:
    return load_typed_layer(spark, cfg, "enriched", target, spec, partitions, entered)


def load_sandbox(spark, cfg, target, spec, partitions=None, entered=None) -> LoadResult:
    return load_typed_layer(spark, cfg, "sandbox", target, spec, partitions, entered)
