"""Loads under late switches, mixed-case metadata, crashes and odd names."""

import datetime as dt
import os

import pytest

from strata.config import LakeConfig
from strata.operators import specs_from_rows
from strata.plans import Target, load_conformed, load_enriched, load_sandbox, load_warehouse
from strata.sources.archive import archive_files
from strata.sources.files import list_files, top_entry
from strata.sources.layers import read_layer

KEYS = ("columnname", "colseq", "delta", "sql", "hashkeycheck", "partitionkeycheck", "clusterindexcol")
TS = dt.datetime(2024, 2, 1)


def spec(part="day"):
    return specs_from_rows("ev", [dict(zip(KEYS, r)) for r in (("k", "1", "int", "int", "Y", "N", "Y"), (part, "2", "date", "date", "N", "Y", "N"))])


def config(scratch, tag, **kw):
    return LakeConfig.under(scratch, conformed_db=f"{tag}_c", enriched_db=f"{tag}_e", sandbox_db=f"{tag}_s", **kw)


def feed(cfg, name, text, database="dw", schema="loads"):
    path = f"{cfg.incoming}/{name}"
    os.makedirs(cfg.incoming, exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return Target(path, name, "ev", "r", database, "s", "ev", database, schema, "ev", "v_ev")


def test_layers_switched_on_late_take_everything(spark, scratch):
    cfg = config(scratch, "late")
    spark.sql("DROP DATABASE IF EXISTS dw__late CASCADE")
    load_conformed(spark, cfg, feed(cfg, "ev__1.csv", "k,day\n1,2024-01-01\n2,2024-01-02\n", schema="late"), spec(), TS)
    t = feed(cfg, "ev__2.csv", "k,day\n3,2024-01-03\n", schema="late")
    days = load_conformed(spark, cfg, t, spec(), TS).partitions
    assert days == ["2024-01-03"]
    enriched = load_enriched(spark, cfg, t, spec(), days)
    assert enriched.created and enriched.incoming == enriched.new == 3
    warehouse = load_warehouse(spark, cfg, t, spec(), days)
    assert warehouse.created and warehouse.incoming == warehouse.new == 3
    assert sorted(r.k for r in spark.table("dw__late.ev").collect()) == [1, 2, 3]
    # Now that both exist, a load of one day compares that day only.
    again = load_warehouse(spark, cfg, t, spec(), days)
    assert (again.existing, again.incoming, again.new, again.after) == (None, 1, 0, None)


def test_targets_that_missed_loads_take_them_later(spark, scratch):
    cfg = config(scratch, "missed")
    spark.sql("DROP DATABASE IF EXISTS dw__missed CASCADE")
    targets = [feed(cfg, f"ev__{i}.csv", f"k,day\n{i},2024-01-0{i}\n", schema="missed") for i in range(1, 6)]
    flags = [(True, True), (False, False), (True, False), (True, True), (True, True)]
    incoming = []
    for t, (typed, warehouse) in zip(targets, flags, strict=True):
        days = load_conformed(spark, cfg, t, spec(), TS).partitions
        if typed:
            r = load_enriched(spark, cfg, t, spec(), days)
            load_sandbox(spark, cfg, t, spec(), days)
            w = load_warehouse(spark, cfg, t, spec(), r.partitions).incoming if warehouse else None
            incoming.append((r.incoming, w))
            have = [x.day for x in spark.table("missed_c.missed_ev").collect()]
            for name in ("missed_e.missed_ev", "missed_s.missed_ev") + ("dw__missed.ev",) * warehouse:
                assert sorted(str(x.day) for x in spark.table(name).collect()) == sorted(have), name
    # The loads after one that was missed take all; the others their own day.
    assert incoming == [(1, 1), (3, None), (1, 4), (1, 1)]


def test_rows_of_an_append_that_died_reach_the_targets(spark, scratch, monkeypatch):
    import strata.sources.layers as layers

    cfg = config(scratch, "died")
    targets = [feed(cfg, f"ev__{i}.csv", f"k,day\n{i},2024-01-0{i}\n", schema="died") for i in range(1, 4)]
    days = load_conformed(spark, cfg, targets[0], spec(), TS).partitions
    load_enriched(spark, cfg, targets[0], spec(), days)
    real, calls = layers.add_partitions, []

    def fails_after_write(*a, **kw):
        calls.append(a)
        if len(calls) > 1:
            raise RuntimeError("driver lost")
        return real(*a, **kw)

    monkeypatch.setattr(layers, "add_partitions", fails_after_write)
    with pytest.raises(RuntimeError):
        load_conformed(spark, cfg, targets[1], spec(), TS)
    monkeypatch.setattr(layers, "add_partitions", real)
    days = load_conformed(spark, cfg, targets[2], spec(), TS).partitions
    load_enriched(spark, cfg, targets[2], spec(), days)
    assert sorted(r.k for r in spark.table("died_e.died_ev").collect()) == [1, 2, 3]


def test_partition_column_of_another_case(spark, scratch):
    cfg = config(scratch, "case")
    s = spec("Day")
    r1 = load_conformed(spark, cfg, feed(cfg, "ev__1.csv", "k,day\n1,2024-01-01\n2,2024-01-01\n"), s, TS)
    t = feed(cfg, "ev__2.csv", "k,day\n2,2024-01-01\n3,2024-01-01\n")
    r2 = load_conformed(spark, cfg, t, s, TS)
    assert (r1.new, r2.new) == (2, 1)
    assert spark.table("case_c.loads_ev").count() == 3
    assert load_enriched(spark, cfg, t, s, None).new == 3


def test_crash_between_files_and_catalog(spark, scratch, monkeypatch):
    import strata.sources.layers as layers

    cfg = config(scratch, "crash")
    load_conformed(spark, cfg, feed(cfg, "ev__1.csv", "k,day\n1,2024-01-01\n"), spec(), TS)
    t = feed(cfg, "ev__2.csv", "k,day\n2,2024-01-02\n3,2024-01-02\n")
    real, calls = layers.add_partitions, []

    def fails_after_write(*a, **kw):
        calls.append(a)
        if len(calls) > 1:  # the first call heals, the second follows the write
            raise RuntimeError("driver lost")
        return real(*a, **kw)

    monkeypatch.setattr(layers, "add_partitions", fails_after_write)
    with pytest.raises(RuntimeError):
        load_conformed(spark, cfg, t, spec(), TS)
    monkeypatch.setattr(layers, "add_partitions", real)
    again = load_conformed(spark, cfg, t, spec(), TS)
    assert again.new == 0
    assert sorted(r.k for r in spark.table("crash_c.loads_ev").collect()) == ["1", "2", "3"]


def test_partitions_written_but_never_recorded_block_their_rows(spark, scratch):
    """Files on disk that the catalog does not list are seen all the same."""
    cfg = config(scratch, "orphan")
    load_conformed(spark, cfg, feed(cfg, "ev__1.csv", "k,day\n1,2024-01-01\n"), spec(), TS)
    t = feed(cfg, "ev__2.csv", "k,day\n2,2024-01-02\n")
    load_conformed(spark, cfg, t, spec(), TS)
    spark.sql("ALTER TABLE orphan_c.loads_ev DROP PARTITION (day = '2024-01-02')")
    assert spark.table("orphan_c.loads_ev").count() == 1
    assert load_conformed(spark, cfg, t, spec(), TS).new == 0
    assert spark.table("orphan_c.loads_ev").count() == 2


def test_backups_are_whole_and_replaced_only_when_complete(spark, scratch):
    cfg = config(scratch, "back", backup_scope="table")
    t = feed(cfg, "ev__1.csv", "k,day\n1,2024-01-01\n")
    load_conformed(spark, cfg, t, spec(), TS)
    b2 = load_conformed(spark, cfg, feed(cfg, "ev__2.csv", "k,day\n2,2024-01-02\n"), spec(), TS).backup
    assert sorted(r.k for r in read_layer(spark, b2).collect()) == ["1"]
    b3 = load_conformed(spark, cfg, feed(cfg, "ev__3.csv", "k,day\n3,2024-01-03\n"), spec(), TS).backup
    assert sorted(r.k for r in read_layer(spark, b3).collect()) == ["1", "2"]
    assert os.listdir(os.path.dirname(b3)) == [os.path.basename(b3)] and b2 != b3


def test_warehouse_databases_stay_apart(spark, scratch):
    cfg = config(scratch, "apart")
    for db in ("dw1", "dw2"):
        spark.sql(f"DROP DATABASE IF EXISTS {db}__apart CASCADE")
    for db in ("dw1", "dw2"):
        c = config(f"{scratch}/{db}", f"apart{db}")
        t = feed(c, "ev__1.csv", "k,day\n1,2024-01-01\n2,2024-01-01\n", db, "apart")
        load_conformed(spark, c, t, spec(), TS)
        load_enriched(spark, c, t, spec(), None)
        assert load_warehouse(spark, c, t, spec(), None).new == 2
    with pytest.raises(ValueError):
        feed(cfg, "x.csv", "k\n", "a__b", "c").warehouse_db


def test_archive_of_odd_names(spark, scratch):
    from pyspark.sql import functions as F

    folder = f"{scratch}/in coming"
    names = ["plain.csv", "with blank.csv", "pct%41.csv", "hash#1.csv", "plus+.csv"]
    os.makedirs(folder)
    for n in names:
        with open(f"{folder}/{n}", "w") as f:
            f.write(f"line of {n}\n")
    routes = list_files(spark, folder).withColumns(
        {"deltaLake_root": F.lit("r"), "delta_database_name": F.lit("d")}
    )
    assert sorted(r["name"] for r in routes.collect()) == sorted(names)
    archive_files(spark, routes, folder, f"{scratch}/archive", dt.date(2024, 2, 1), folder)
    got = sorted(r.value for r in spark.read.option("recursiveFileLookup", "true").text(f"{scratch}/archive").collect())
    assert got == sorted(f"line of {n}" for n in names)


@pytest.mark.parametrize(
    ("folder", "path", "entry"),
    [
        ("s3://bucket", "s3://bucket/a.csv", "s3://bucket/a.csv"),
        ("s3://bucket", "s3://bucket/d/part-0", "s3://bucket/d"),
        ("s3://bucket/in", "s3://bucket/in/d/part-0", "s3://bucket/in/d"),
        ("/data/in", "file:/data/in/a.csv", "file:/data/in/a.csv"),
        ("file:///data/in/", "file:///data/in/d/e/part-0", "file:///data/in/d"),
    ],
)
def test_top_entry(spark, folder, path, entry):
    from pyspark.sql import functions as F

    assert spark.range(1).select(top_entry(F.lit(path), folder).alias("e")).first().e == entry


def test_repeated_rows_in_a_chunked_join(spark):
    from pyspark.sql import functions as F

    from strata.operators.broadcast import broadcast_join, checked_chunks

    small = spark.createDataFrame([("a",)] * 5 + [("b",)], "p string")
    assert sum(p.count() for p in checked_chunks(small, limit=3)) == 2
    large = spark.createDataFrame([("xa",), ("xb",), ("xc",)], "n string")
    got = broadcast_join(large, small, F.col("n").contains(F.col("p")), limit=1)
    assert sorted(tuple(r) for r in got.distinct().collect()) == [("xa", "a"), ("xb", "b")]


def test_warehouse_files_hold_disjoint_ranges_despite_a_hot_cluster_value(spark):
    from pyspark.sql import functions as F

    from strata.sources.warehouse import insert_from_staging, write_staging

    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("calhashkey"),
    )
    for db in ("wh_ranges", "staging_wh_ranges"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    spark.sql("DROP TABLE IF EXISTS wh_ranges.t")
    spark.sql("CREATE TABLE wh_ranges.t (k BIGINT, calhashkey STRING) USING parquet")
    write_staging(rows, "staging_wh_ranges", "t")
    # A small batch would be merged into one file.
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merge)
    spark.conf.set(merge, "false")
    try:
        assert insert_from_staging(spark, "staging_wh_ranges", "wh_ranges", "t", ["k"]) == 4000
    finally:
        spark.conf.set(merge, before)
    place = F.struct((-F.col("k")).alias("k"), "calhashkey")
    files = spark.table("wh_ranges.t").groupBy(F.input_file_name().alias("f")).agg(
        F.min(place).alias("lo"), F.max(place).alias("hi"), F.count_if(F.col("k") == 7).alias("hot")
    )
    got = sorted((tuple(r.lo), tuple(r.hi), r.hot) for r in files.collect())
    assert len(got) > 2
    assert all(a[1] < b[0] for a, b in zip(got, got[1:], strict=False))
    assert sum(1 for r in got if r[2]) > 1  # the hot value is in several files


def test_load_counts_take_one_exchange(spark):
    from pyspark.sql import functions as F

    from strata.operators import load_counts

    some = spark.range(10).select(F.col("id").alias("a"))
    got = load_counts(some, some.filter("a < 7"), some.filter("a < 3"))
    assert {r.metric: r.value for r in got.collect()} == {"existing": 10, "incoming": 7, "new": 3, "after": 13}
    assert {r.metric: r.value for r in load_counts(None, some, some).collect()} == {"existing": 0, "incoming": 10, "new": 10, "after": 10}
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange ") == 1, plan
