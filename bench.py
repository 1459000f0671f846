"""Benchmark: every checked query (but those that run whole loads), plus the
ingest path on lineitem.

Prints one JSON line. Each query is run to completion through the ``noop``
sink (full execution, nothing collected); ingest steps write real layers to
a fresh scratch folder. Reported time per query is the median of
``BENCH_REPS`` runs (default 3) after one warm-up run of the whole set.
``comparison`` (not part of ``value``) times the lineitem append planned the
way the reference plans it against the way the loads here plan it.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import StorageLevel  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata.config import LakeConfig  # noqa: E402
from strata.operators.increment import count_with_values, new_lake_rows  # noqa: E402
from strata.plans.conformed import conformed_batch, load_conformed  # noqa: E402
from strata.plans.target import Target  # noqa: E402
from strata.plans.typed import load_enriched  # noqa: E402
from strata.plans.warehouse import load_warehouse  # noqa: E402
from strata.registry import LINEITEM, LOAD_TS, QUERIES  # noqa: E402
from strata.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
REPS = int(os.environ.get("BENCH_REPS", "3"))


# Rows that run whole loads are timed by the ingest steps instead.
LOAD_ROWS = {"conformed_after_loads", "enriched_after_loads", "warehouse_after_missed_load"}


def _sf(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    return base[2:] if base.startswith("sf") else base


def run_query(spark, fn) -> None:
    fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()


def make_incoming(spark, folder: str) -> tuple[str, str]:
    """Two overlapping CSV batches of lineitem (years overlap by one)."""
    li = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    cutoff_old = F.lit("1999-01-01").cast("timestamp")
    cutoff_new = F.lit("1998-01-01").cast("timestamp")
    b1 = f"{folder}/lineitem_feed__b1.csv"
    b2 = f"{folder}/lineitem_feed__b2.csv"
    li.filter(F.col("l_shipdate") < cutoff_old).write.option("header", True).csv(b1)
    li.filter(F.col("l_shipdate") >= cutoff_new).write.option("header", True).csv(b2)
    return b1, b2


def target(path: str, name: str) -> Target:
    return Target(
        path=path,
        name=name,
        dataset="lineitem_feed",
        root="bench",
        database="tpch",
        schema="core",
        table="lineitem",
        sql_database="dw",
        sql_schema="bench_core",
        sql_table="lineitem",
        sql_view="v_lineitem",
    )


def ingest_once(spark, scratch_root: str, b1: str, b2: str) -> dict[str, float]:
    run_root = tempfile.mkdtemp(prefix="run-", dir=scratch_root)
    cfg = LakeConfig.under(
        run_root,
        conformed_db="bench_conformed",
        enriched_db="bench_enriched",
        sandbox_db="bench_sandbox",
        metadata_db="bench_meta",
    )
    spark.sql("DROP DATABASE IF EXISTS dw__bench_core CASCADE")
    spark.sql("DROP DATABASE IF EXISTS staging_dw__bench_core CASCADE")
    out = {}
    t = time.perf_counter()
    load_conformed(spark, cfg, target(b1, "lineitem_feed__b1.csv"), LINEITEM, LOAD_TS)
    out["ingest_conformed_create"] = time.perf_counter() - t
    t = time.perf_counter()
    r = load_conformed(spark, cfg, target(b2, "lineitem_feed__b2.csv"), LINEITEM, LOAD_TS + dt.timedelta(days=1))
    out["ingest_conformed_append"] = time.perf_counter() - t
    t = time.perf_counter()
    load_enriched(spark, cfg, target(b2, "lineitem_feed__b2.csv"), LINEITEM, None)
    out["ingest_enriched_full"] = time.perf_counter() - t
    t = time.perf_counter()
    load_warehouse(spark, cfg, target(b2, "lineitem_feed__b2.csv"), LINEITEM, None)
    out["ingest_warehouse_create"] = time.perf_counter() - t
    t = time.perf_counter()
    load_enriched(spark, cfg, target(b2, "lineitem_feed__b2.csv"), LINEITEM, r.partitions)
    out["ingest_enriched_rerun"] = time.perf_counter() - t
    return out


def _lineitem_split(spark):
    li = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    stored = conformed_batch(li.filter(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp")), LINEITEM, LOAD_TS)
    batch = conformed_batch(li.filter(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp")), LINEITEM, LOAD_TS)
    return stored, batch


def append_reference_shape(spark) -> None:
    """The reference's append plan on the same data: collected days, a NOT IN
    subquery (null-aware broadcast anti-join), SELECT DISTINCT, then a batch
    count, two new-row counts and the write, all on an uncached plan."""
    stored, batch = _lineitem_split(spark)
    days = [r[0] for r in batch.select("l_shipdate").distinct().collect()]
    stored.filter(F.col("l_shipdate").isin(days)).createOrReplaceTempView("bench_old")
    batch.createOrReplaceTempView("bench_new")
    new = spark.sql(
        "SELECT DISTINCT n.* FROM bench_new n WHERE n.calhashkey NOT IN (SELECT calhashkey FROM bench_old)"
    )
    batch.count()
    new.count()
    new.count()
    new.write.format("noop").mode("overwrite").save()


def append_ours(spark) -> None:
    """The same append as the loads run it: pruned equi anti-join, new rows
    computed once (count with the touched days), then the write."""
    stored, batch = _lineitem_split(spark)
    new = new_lake_rows(batch, stored, "l_shipdate").persist(StorageLevel.MEMORY_AND_DISK)
    count_with_values(new, "l_shipdate")
    new.write.format("noop").mode("overwrite").save()
    new.unpersist()


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="strata-bench-")
    spark = local_session(
        CPUS,
        int(CPUS) * 2 if CPUS.isdigit() else 16,
        app="strata-bench",
        **{
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "6g"),
        },
    )
    times: dict[str, list[float]] = {}
    timed = {name: fn for name, fn in QUERIES.items() if name not in LOAD_ROWS}
    for fn in timed.values():  # warm-up
        run_query(spark, fn)
    for _ in range(REPS):
        for name, fn in timed.items():
            t = time.perf_counter()
            run_query(spark, fn)
            times.setdefault(name, []).append(time.perf_counter() - t)

    b1, b2 = make_incoming(spark, tempfile.mkdtemp(prefix="incoming-", dir=scratch))
    ingest_once(spark, scratch, b1, b2)  # warm-up
    for _ in range(REPS):
        for k, v in ingest_once(spark, scratch, b1, b2).items():
            times.setdefault(k, []).append(v)

    compare: dict[str, list[float]] = {}
    for name, fn in (("append_reference_shape", append_reference_shape), ("append_ours", append_ours)):
        fn(spark)  # warm-up
        for _ in range(REPS):
            t = time.perf_counter()
            fn(spark)
            compare.setdefault(name, []).append(time.perf_counter() - t)

    med = {k: round(statistics.median(v), 3) for k, v in times.items()}
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(med.values()), 3),
                "unit": "sec",
                "queries": med,
                "sf": _sf(SF_DIR),
                "cpus": CPUS,
                "reps": REPS,
                # Not part of "value": the lineitem append planned as the
                # reference plans it vs as the loads here plan it.
                "comparison": {k: round(statistics.median(v), 3) for k, v in compare.items()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
