"""Warehouse load (K8): enriched -> staging table -> typed table -> view.

Declared columns are cast to their warehouse types (C8, with ``varchar(n)``
truncation), undeclared ones pass through (C9). When the target exists, the
rows whose hash it already holds are removed with an equi anti-join against
the target's key index (E2); the rest are staged (A13) and
inserted with a ``DISTINCT`` by column name (A14), sorted within files by
the cluster column, descending (H2).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Observation

from ..config import LakeConfig, join_path
from ..functions.keys import HASH_COL
from ..operators.failures import failed_cast, failed_cells, observe_failures, observed_failures
from ..operators.increment import hot_keys, new_warehouse_rows, prune_to_values
from ..operators.project import typed_projection
from ..operators.spec import DatasetSpec
from ..sources.catalog import create_table, ensure_database, ensure_view, table_exists
from ..sources.keyindex import SUFFIX, KeyIndex, new_by_index
from ..sources.layers import open_layer
from ..sources.quarantine import SUFFIX as FAILED
from ..sources.quarantine import record_failures
from ..sources.warehouse import insert_from_staging, read_warehouse, write_staging
from ..sources.taken import begin_append, end_append, rest_taken, set_taken, source_version
from .target import LoadResult, Target
from .typed import typed_table


def load_warehouse(
    spark,
    cfg: LakeConfig,
    target: Target,
    spec: DatasetSpec,
    partitions: list | None = None,
) -> LoadResult:
    schema, table = target.warehouse_db, target.sql_table
    staging = target.staging_schema
    result = LoadResult("warehouse", f"{schema}.{table}")

    layer = typed_table(cfg, "enriched", target, spec)
    src = open_layer(spark, layer)
    if src is None:
        result.notes.append("no enriched layer")
        return result
    version = source_version(spark, layer.db, layer.table)
    # A table that is new, or that is not known to have taken all the other
    # days, takes the whole enriched layer.
    loaded = table_exists(spark, schema, table) and not read_warehouse(spark, schema, table).isEmpty()
    if partitions is not None and loaded and rest_taken(spark, (layer.db, layer.table), (schema, table), partitions):
        if not partitions:
            result.notes.append("no partitions to load")
            result.incoming = result.new = 0
            return result
        src = prune_to_values(src, spec.partition_key, partitions)
    tests, lost = failed_cast(src, spec, "sql"), Observation("warehouse-lost")
    typed = typed_projection(observe_failures(src, tests, lost), spec, "sql")
    result.incoming = src.count()  # reads file footers only

    ensure_database(spark, schema)  # B3
    ensure_database(spark, staging)
    index, present = None, ""
    if cfg.key_index:
        folder = join_path(cfg.enriched, target.subpath) + f"__{schema}_{table}{SUFFIX}"
        index = KeyIndex(spark, staging, table + SUFFIX, folder, cfg.key_buckets)
    if table_exists(spark, schema, table):  # B4
        stored = read_warehouse(spark, schema, table)  # A12
        if cfg.full_counts:
            result.existing = stored.count()
        hot = None
        # No key can pass the threshold unless the whole batch does.
        if cfg.hot_key_rows is not None and result.incoming > cfg.hot_key_rows:
            hot = hot_keys(src.select(HASH_COL), min_rows=cfg.hot_key_rows, rows=result.incoming) or None
        keys = None
        present = source_version(spark, schema, table)
        if index is not None and present:
            keys = index.keys(present)
            keys = index.build(stored, present) if keys is None else keys
        new = new_warehouse_rows(typed, stored, hot=hot) if keys is None else new_by_index(typed, keys, hot=hot)  # E2
    else:
        create_table(spark, schema, table, spec.warehouse_ddl_columns())  # B5, C10
        result.created, result.existing = True, 0
        new = typed
    write_staging(new, staging, table)  # A13
    result.failed = observed_failures(tests, lost)
    if result.failed and cfg.quarantine:
        cells = failed_cells(src, [t for t in tests if t[0] in result.failed])
        folder = join_path(cfg.enriched, target.subpath) + f"__{schema}_{table}{FAILED}"
        record_failures(spark, staging, table + FAILED, folder, cells, _dt.datetime.now().replace(microsecond=0))
    begin_append(spark, schema, table, None)
    result.new = insert_from_staging(spark, staging, schema, table, spec.cluster_keys)  # A14
    end_append(spark, schema, table)
    if index is not None:
        now = source_version(spark, schema, table)
        if present:
            index.append(read_warehouse(spark, staging, table), now)
        else:
            index.build(read_warehouse(spark, schema, table), now)
    set_taken(spark, (schema, table), version)
    if result.existing is not None:
        result.after = result.existing + result.new
    if target.sql_view:
        ensure_view(spark, schema, target.sql_view, table)  # B7
    return result
