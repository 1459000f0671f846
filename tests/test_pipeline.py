"""End to end: CSV files through every layer, run twice."""

import datetime as dt
import glob
import os

import pytest

from strata import LakeConfig, load_business_metadata, load_technical_metadata, run_pipeline
from strata.plans.typed import read_typed_layer
from strata.sources.layers import read_layer

BUSINESS = """dataset,deltaLake_root,delta_database_name,delta_schema_name,deltaLake_table_name,sql_database_name,sql_schema_name,sql_table_name,sql_view_name,raw_layer,conformed_layer,enrich_layer,sandbox_layer,edw_layer
orders_feed,sales,tpch,core,orders,dw,core,orders,v_orders,Y,Y,Y,Y,Y
"""

TECHNICAL = """filename,columnname,colseq,delta,sql,hashkeycheck,partitionkeycheck,clusterindexcol
orders_feed,o_orderkey,1,bigint,bigint,Y,N,Y
orders_feed,o_custkey,2,bigint,bigint,Y,N,N
orders_feed,o_orderstatus,3,string,varchar(1),y,N,N
orders_feed,o_totalprice,10,"decimal(12,2)","decimal(12,2)",N,N,N
orders_feed,o_orderdate,11,date,date,N,Y,N
"""

HEADER = "O_OrderKey,O_CustKey,O_OrderStatus,O_TotalPrice,O_OrderDate\n"
FILES = {
    # one exact duplicate, one NULL key part, one unparseable date
    "orders_feed__day1.csv": HEADER
    + "1,10,FX,100.50,1995-01-01\n1,10,FX,100.50,1995-01-01\n2,,O,200.00,1995-01-01\n"
    + "3,30,P,300.25,1995-01-02\n4,40,F,400.00,not-a-date\n",
    # two stored, one new in a stored partition, one in a new partition
    "orders_feed__day2.csv": HEADER
    + "1,10,FX,100.50,1995-01-01\n3,30,P,300.25,1995-01-02\n5,50,O,500.00,1995-01-01\n"
    + "6,60,F,600.00,1995-01-03\n",
    # schema evolution: one extra column
    "orders_feed__day3.csv": "O_OrderKey,O_CustKey,O_OrderStatus,O_TotalPrice,O_OrderDate,Growth %\n"
    + "7,70,O,700.00,1995-01-03,5\n8,80,F,800.00,1995-01-04,6\n",
    "unknown.csv": "a,b\n1,2\n",
}


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.fixture(params=[1_000_000, 0], ids=["plain", "hot-keys"])
def lake(request, spark, scratch):
    # hot_key_rows=0 treats every key as hot: the whole load then runs the
    # hot-key path and must give the same rows.
    cfg = LakeConfig.under(
        scratch,
        conformed_db="t_conformed",
        enriched_db="t_enriched",
        sandbox_db="t_sandbox",
        metadata_db="t_meta",
        full_counts=True,
        hot_key_rows=request.param,
    )
    _write(f"{scratch}/meta/business.csv", BUSINESS)
    _write(f"{scratch}/meta/technical.csv", TECHNICAL)
    assert load_business_metadata(spark, cfg, f"{scratch}/meta/business.csv") == 1
    assert load_technical_metadata(spark, cfg, f"{scratch}/meta/technical.csv") == 5
    for name, text in FILES.items():
        _write(f"{cfg.incoming}/{name}", text)
    for db in ("dw__core", "staging_dw__core"):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    return cfg


def _by_layer(results, layer):
    return [r for r in results if r["layer"] == layer]


def test_pipeline_end_to_end_and_rerun(spark, lake):
    ts = dt.datetime(2024, 2, 1, 12, 0, 0)
    results = run_pipeline(spark, lake, load_ts=ts)
    conf = _by_layer(results, "conformed")
    assert [r["new"] for r in conf] == [4, 2, 2]
    assert conf[0]["created"] and conf[1]["existing"] == 4 and conf[2]["after"] == 8
    assert conf[1]["backup"] is not None

    conformed = read_layer(spark, f"{lake.conformed}/sales/tpch/core/orders")
    assert conformed.count() == 8
    types = dict(conformed.dtypes)
    assert types["o_orderdate"] == "string" and types["o_orderkey"] == "string"
    assert "growth_percent" in conformed.columns
    days = sorted((r.o_orderdate or "NULL") for r in conformed.select("o_orderdate").collect())
    assert days == ["1995-01-01"] * 3 + ["1995-01-02", "1995-01-03", "1995-01-03", "1995-01-04", "NULL"]
    # the NULL key part hashes as if the column were absent
    import hashlib

    row2 = conformed.filter("o_orderkey = '2'").collect()[0]
    assert row2.calhashkey == hashlib.sha256(b"2||O").hexdigest().upper()
    assert row2.calinsertdate == ts and row2.calupdatedate is None

    spec_types = dict(read_typed_layer(spark, f"{lake.enriched}/sales/tpch/core/orders", _spec(spark, lake)).dtypes)
    assert spec_types["o_orderkey"] == "bigint" and spec_types["o_totalprice"] == "decimal(12,2)"
    assert spec_types["o_orderdate"] == "date"
    enriched = read_layer(spark, f"{lake.enriched}/sales/tpch/core/orders")
    sandbox = read_layer(spark, f"{lake.sandbox}/sales/tpch/core/orders")
    assert enriched.count() == sandbox.count() == 8

    wh = spark.table("dw__core.orders")
    assert wh.count() == 8
    assert spark.table("dw__core.v_orders").count() == 8
    whrows = {r.o_orderkey: r for r in wh.collect()}
    assert whrows[1].o_orderstatus == "F"  # varchar(1) truncation
    assert whrows[1].calinsertdate == ts.date()
    assert "growth_percent" in wh.columns and whrows[8].growth_percent == "6"
    # H2: within each warehouse file, rows descend on the cluster column
    from pyspark.sql import functions as F

    located = spark.table("dw__core.orders").select(
        F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("pos"), "o_orderkey"
    ).collect()
    by_file = {}
    for r in sorted(located, key=lambda r: (r.f, r.pos)):
        by_file.setdefault(r.f, []).append(r.o_orderkey)
    assert by_file and all(keys == sorted(keys, reverse=True) for keys in by_file.values())

    assert spark.table("t_conformed.core_orders").count() == 8
    assert dict(spark.table("t_conformed.core_orders").dtypes)["o_orderdate"] == "string"
    assert spark.table("t_enriched.core_orders").count() == 8

    archived = glob.glob(f"{lake.archive}/root=sales/database=tpch/yyyy=2024/mm=02/dd=01/file_name=*")
    assert len(archived) == 3

    again = run_pipeline(spark, lake, load_ts=ts + dt.timedelta(days=1))
    assert all(r["new"] == 0 for r in again), again
    assert read_layer(spark, f"{lake.conformed}/sales/tpch/core/orders").count() == 8
    assert spark.table("dw__core.orders").count() == 8
    # archiving the same files again on the same day replaces them
    from strata.sources.archive import archive_files
    from strata.plans.pipeline import route_files

    routes = route_files(spark, lake).filter("raw_layer = 'Y'")
    archive_files(spark, routes, lake.incoming, lake.archive, ts.date())
    day1 = f"{lake.archive}/root=sales/database=tpch/yyyy=2024/mm=02/dd=01"
    assert spark.read.text(day1).count() == sum(
        len(t.splitlines()) for n, t in FILES.items() if n.startswith("orders")
    )


def test_unsupported_file_fails_before_loading(spark, lake):
    _write(f"{lake.incoming}/orders_feed.txt", "x\n1\n")
    with pytest.raises(ValueError, match="not supported"):
        run_pipeline(spark, lake, load_ts=dt.datetime(2024, 2, 1))


def _spec(spark, cfg):
    from strata.plans.metadata import spec_for

    return spec_for(spark, cfg, "orders_feed")


def test_incoming_stream_loads_only_new_files(spark, lake, scratch):
    from strata.streaming import run_incoming_stream

    ckpt = f"{scratch}/stream-checkpoint"
    ts = dt.datetime(2024, 2, 1, 12, 0, 0)
    first = run_incoming_stream(spark, lake, ckpt, load_ts=ts)
    conf = [r for r in first if r["layer"] == "conformed"]
    assert sorted(r["new"] for r in conf) == [2, 2, 4]
    # nothing new arrived: the checkpoint says every file was handed over
    assert run_incoming_stream(spark, lake, ckpt, load_ts=ts) == []
    _write(f"{lake.incoming}/orders_feed__day4.csv", HEADER + "9,90,O,900.00,1995-01-05\n1,10,FX,100.50,1995-01-01\n")
    later = run_incoming_stream(spark, lake, ckpt, load_ts=ts)
    assert [r["new"] for r in later if r["layer"] == "conformed"] == [1]
    assert read_layer(spark, f"{lake.conformed}/sales/tpch/core/orders").count() == 9


def test_parallel_datasets_match_sequential(spark, scratch):
    """Two datasets loaded in parallel threads give the same layers as one by one."""
    copy_business = BUSINESS + "orders_copy,sales,tpch,core,orders_copy,dw,core2,orders_copy,v_orders_copy,N,Y,Y,N,N\n"
    copy_technical = TECHNICAL + "".join(
        line.replace("orders_feed,", "orders_copy,", 1) + "\n"
        for line in TECHNICAL.strip().splitlines()[1:]
    )
    counts = {}
    for mode, workers in (("seq", 1), ("par", 2)):
        root = f"{scratch}/{mode}"
        cfg = LakeConfig.under(root, conformed_db=f"p_{mode}_c", enriched_db=f"p_{mode}_e",
                               sandbox_db=f"p_{mode}_s", metadata_db=f"p_{mode}_m")
        _write(f"{root}/meta/business.csv", copy_business)
        _write(f"{root}/meta/technical.csv", copy_technical)
        load_business_metadata(spark, cfg, f"{root}/meta/business.csv")
        load_technical_metadata(spark, cfg, f"{root}/meta/technical.csv")
        for name in ("orders_feed__day1.csv", "orders_feed__day2.csv"):
            _write(f"{cfg.incoming}/{name}", FILES[name])
            _write(f"{cfg.incoming}/{name.replace('orders_feed', 'orders_copy')}", FILES[name])
        spark.sql("DROP DATABASE IF EXISTS dw__core CASCADE")
        spark.sql("DROP DATABASE IF EXISTS staging_dw__core CASCADE")
        run_pipeline(spark, cfg, load_ts=dt.datetime(2024, 2, 1), parallel_datasets=workers)
        counts[mode] = {
            t: sorted(tuple(r) for r in read_layer(spark, f"{cfg.enriched}/sales/tpch/core/{t}")
                      .select("calhashkey", "o_orderdate").collect())
            for t in ("orders", "orders_copy")
        }
    assert counts["seq"] == counts["par"]
    assert len(counts["par"]["orders"]) == len(counts["par"]["orders_copy"]) == 6


def test_enriched_blocks_a_key_stored_on_another_day(spark, scratch):
    """Conformed keeps the same key on two days (pruning sees only the file's
    days); the enriched load compares against the whole enriched layer, so the
    second day's row is not added there."""
    from strata.operators import specs_from_rows
    from strata.plans import Target, load_conformed, load_enriched

    keys = ("columnname", "colseq", "delta", "sql", "hashkeycheck", "partitionkeycheck", "clusterindexcol")
    spec = specs_from_rows("ev", [dict(zip(keys, ("user", "1", "bigint", "bigint", "Y", "N", "N"))),
                                  dict(zip(keys, ("day", "2", "date", "date", "N", "Y", "N"))),
                                  dict(zip(keys, ("v", "3", "int", "int", "N", "N", "N")))])
    cfg = LakeConfig.under(scratch, conformed_db="k_c", enriched_db="k_e")
    ts = dt.datetime(2024, 2, 1)
    for i, text in enumerate(["user,day,v\n7,2024-01-01,1\n", "user,day,v\n7,2024-01-05,2\n8,2024-01-05,3\n"]):
        path = f"{cfg.incoming}/ev__{i}.csv"
        _write(path, text)
        t = Target(path, f"ev__{i}.csv", "ev", "r", "d", "s", "ev", "dw", "s", "ev", "v_ev")
        res = load_conformed(spark, cfg, t, spec, ts)
        load_enriched(spark, cfg, t, spec, res.partitions)
    conformed = read_layer(spark, f"{cfg.conformed}/r/d/s/ev")
    enriched = read_layer(spark, f"{cfg.enriched}/r/d/s/ev")
    assert sorted(r.v for r in conformed.collect()) == ["1", "2", "3"]
    assert sorted(r.v for r in enriched.collect()) == [1, 3]


def test_typed_load_with_more_days_than_the_listing_limit(spark, scratch, monkeypatch):
    """Above the day-list limit the loads fall back to unlisted partitions
    (catalog discovery) instead of treating the batch as empty."""
    import strata.operators.increment as inc
    import strata.plans.typed as typed_mod
    from strata.operators import specs_from_rows
    from strata.plans import Target, load_conformed, load_enriched

    keys = ("columnname", "colseq", "delta", "sql", "hashkeycheck", "partitionkeycheck", "clusterindexcol")
    spec = specs_from_rows("lim", [dict(zip(keys, ("k", "1", "int", "int", "Y", "N", "N"))),
                                   dict(zip(keys, ("day", "2", "date", "date", "N", "Y", "N")))])
    cfg = LakeConfig.under(scratch, conformed_db="lim_c", enriched_db="lim_e", backup_scope="partitions")
    path = f"{cfg.incoming}/lim__1.csv"
    _write(path, "k,day\n1,2024-01-01\n2,2024-01-02\n3,2024-01-03\n")
    t = Target(path, "lim__1.csv", "lim", "r", "d", "s", "lim", "dw", "s", "lim", "v_lim")
    load_conformed(spark, cfg, t, spec, dt.datetime(2024, 2, 1))
    monkeypatch.setattr(inc, "MAX_PRUNE_VALUES", 2)
    orig = typed_mod.partition_values
    monkeypatch.setattr(typed_mod, "partition_values", lambda df, col: orig(df, col, limit=2))
    orig_counts = typed_mod.partition_counts
    monkeypatch.setattr(
        typed_mod, "partition_counts", lambda df, col, name: orig_counts(df, col, name, limit=2)
    )
    res = load_enriched(spark, cfg, t, spec, None)
    assert res.partitions is None and res.created and res.new == 3
    assert read_layer(spark, f"{cfg.enriched}/r/d/s/lim").count() == 3
    assert spark.table("lim_e.s_lim").count() == 3

    # conformed append above the limit: no day list, backup by semi-join,
    # partitions found by catalog discovery
    import strata.plans.conformed as conf_mod

    monkeypatch.setattr(conf_mod, "MAX_PRUNE_VALUES", 2)
    path2 = f"{cfg.incoming}/lim__2.csv"
    _write(path2, "k,day\n1,2024-01-01\n4,2024-01-01\n5,2024-01-04\n6,2024-01-05\n")
    t2 = Target(path2, "lim__2.csv", "lim", "r", "d", "s", "lim", "dw", "s", "lim", "v_lim")
    res2 = load_conformed(spark, cfg, t2, spec, dt.datetime(2024, 2, 2))
    assert res2.partitions is None and res2.new == 3
    assert spark.table("lim_c.s_lim").count() == 6
    backup = read_layer(spark, res2.backup)
    # new rows land on 01-01, 01-04, 01-05; of those only 01-01 held stored rows
    assert sorted(r.k for r in backup.collect()) == ["1"]


def test_directory_feed_is_one_file(spark, scratch):
    """A feed written by another Spark job (a directory of part files) routes
    by the directory's name and loads whole; its archive holds all lines."""
    cfg = LakeConfig.under(scratch, conformed_db="dir_c", enriched_db="dir_e", sandbox_db="dir_s",
                           metadata_db="dir_m")
    _write(f"{scratch}/meta/business.csv", BUSINESS.replace(",Y,Y,Y,Y,Y", ",Y,Y,N,N,N"))
    _write(f"{scratch}/meta/technical.csv", TECHNICAL)
    load_business_metadata(spark, cfg, f"{scratch}/meta/business.csv")
    load_technical_metadata(spark, cfg, f"{scratch}/meta/technical.csv")
    rows = [("1", "10", "F", "1.00", "1995-01-01"), ("2", "20", "O", "2.00", "1995-01-02"),
            ("3", "30", "P", "3.00", "1995-01-03")]
    (spark.createDataFrame(rows, "O_OrderKey string, O_CustKey string, O_OrderStatus string, "
                                 "O_TotalPrice string, O_OrderDate string")
     .repartition(3).write.option("header", True).csv(f"{cfg.incoming}/orders_feed__day9.csv"))
    res = run_pipeline(spark, cfg, load_ts=dt.datetime(2024, 2, 1))
    assert [r["new"] for r in res if r["layer"] == "conformed"] == [3]
    arch = spark.read.text(f"{cfg.archive}/root=sales/database=tpch/yyyy=2024/mm=02/dd=01/file_name=orders_feed__day9.csv")
    assert arch.filter("value like 'O_OrderKey%'").count() >= 1 and arch.count() >= 4
