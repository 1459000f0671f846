"""Routing and the whole run (K3, K4, K9).

``route_files`` lists a folder and joins it with the business metadata on
Spark. The raw archive consumes the routed DataFrame directly; the layer
loads need one routed row per file on the driver, and those are streamed in
(dataset, file name) order with ``toLocalIterator``, so the driver holds one
dataset's files at a time rather than the whole listing.

Which of several same-key rows survive depends on the order in which files
arrive, and the result is always that of one file after another; several files
of a dataset are loaded at once all the same (``plans/files.py``). Files of
different datasets are independent and can run concurrently
(``parallel_datasets``), each dataset's files still in order.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LakeConfig
from ..operators.fold import MAX_FOLD_FILES
from ..operators.routing import route
from ..operators.spec import DatasetSpec
from ..sources.archive import archive_files
from ..sources.files import check_format, list_files
from ..sources.layers import open_layer
from .conformed import conformed_table, load_conformed
from .files import load_files_at_once
from .metadata import business_table, spec_for
from .target import LoadResult, Target
from .typed import load_enriched, load_sandbox
from .warehouse import load_warehouse


def route_files(spark: SparkSession, cfg: LakeConfig, folder: str | None = None) -> DataFrame:
    """K3: files in ``folder`` (default: incoming) with their datasets."""
    files = list_files(spark, folder or cfg.incoming)
    return route(files, business_table(spark, cfg))


def land_raw(
    spark: SparkSession,
    cfg: LakeConfig,
    routed: DataFrame,
    day=None,
    source: str | list[str] | None = None,
) -> None:
    """K4: archive every routed file whose dataset has ``raw_layer = 'Y'``.

    ``source`` is the folder (or file list) whose lines are read; default
    the incoming folder.
    """
    raw = routed.filter(F.col("raw_layer") == F.lit("Y"))
    if raw.isEmpty():
        return
    archive_files(spark, raw, source or cfg.incoming, cfg.archive, day, folder=cfg.incoming)


def load_dataset_files(
    spark: SparkSession,
    cfg: LakeConfig,
    targets: list[Target],
    load_ts=None,
) -> list[LoadResult]:
    """Every layer for the files of one dataset, in file-name order.

    Files that share their targets are loaded ``cfg.fold_files`` at a time
    with the result of one after another; the file that creates the conformed
    layer goes alone."""
    results: list[LoadResult] = []
    if not targets:
        return results
    for t in targets:
        check_format(t.path)  # A2: fail before anything of the dataset loads
    spec = spec_for(spark, cfg, targets[0].dataset)
    waiting = sorted(targets, key=lambda t: t.name)
    at_once = min(cfg.fold_files, MAX_FOLD_FILES)
    while waiting:
        t = waiting[0]
        n = 1
        while n < min(at_once, len(waiting)) and waiting[n].same_targets(t):
            n += 1
        if n > 1 and t.runs("conformed_layer") and open_layer(spark, conformed_table(cfg, t, spec)) is not None:
            results += load_files_at_once(spark, cfg, waiting[:n], spec, load_ts)
        else:
            n = 1
            results += load_one_file(spark, cfg, t, spec, load_ts)
        del waiting[:n]
    return results


def load_one_file(spark: SparkSession, cfg: LakeConfig, t: Target, spec: DatasetSpec, load_ts=None) -> list[LoadResult]:
    """Every flagged layer for one file."""
    results: list[LoadResult] = []
    days = None
    if t.runs("conformed_layer"):
        res = load_conformed(spark, cfg, t, spec, load_ts)
        results.append(res)
        days = res.partitions
    if t.runs("enrich_layer"):
        res = load_enriched(spark, cfg, t, spec, days)
        results.append(res)
        if t.runs("edw_layer"):
            results.append(load_warehouse(spark, cfg, t, spec, res.partitions))
    elif t.runs("edw_layer"):
        results.append(load_warehouse(spark, cfg, t, spec, None))
    if t.runs("sandbox_layer"):
        results.append(load_sandbox(spark, cfg, t, spec, days))
    return results


def dataset_groups(routed: DataFrame) -> Iterator[list[Target]]:
    """Routed rows grouped by dataset, streamed in (dataset, name) order."""
    group: list[Target] = []
    for row in routed.orderBy("dataset", "name").toLocalIterator():
        t = Target.from_row(row)
        if group and group[0].dataset != t.dataset:
            yield group
            group = []
        group.append(t)
    if group:
        yield group


def run_routed(
    spark: SparkSession,
    cfg: LakeConfig,
    routed: DataFrame,
    load_ts: _dt.datetime,
    parallel_datasets: int = 1,
    source: str | list[str] | None = None,
) -> list[dict]:
    """Archive, then load every routed file, dataset by dataset."""
    routed = routed.persist()  # read by the archive and by the file loop
    try:
        land_raw(spark, cfg, routed, load_ts.date(), source)
        out: list[dict] = []
        if parallel_datasets <= 1:
            for group in dataset_groups(routed):
                out.extend(r.as_dict() for r in load_dataset_files(spark, cfg, group, load_ts))
            return out
        # At most 2 x parallel_datasets groups are held on the driver at once.
        with ThreadPoolExecutor(max_workers=parallel_datasets) as pool:
            pending: list = []
            for group in dataset_groups(routed):
                pending.append(pool.submit(load_dataset_files, spark, cfg, group, load_ts))
                if len(pending) >= 2 * parallel_datasets:
                    out.extend(r.as_dict() for r in pending.pop(0).result())
            for f in pending:
                out.extend(r.as_dict() for r in f.result())
        return out
    finally:
        routed.unpersist()


def run_pipeline(
    spark: SparkSession,
    cfg: LakeConfig,
    load_ts: _dt.datetime | None = None,
    parallel_datasets: int = 1,
) -> list[dict]:
    """K9: route -> raw archive -> per file: conformed, enriched, sandbox, warehouse.

    Every flagged layer runs for every routed file and adds only the rows it
    is missing, so a re-run after a failure completes the work.
    """
    load_ts = load_ts or _dt.datetime.now().replace(microsecond=0)
    routed = route_files(spark, cfg)
    return run_routed(spark, cfg, routed, load_ts, parallel_datasets)
