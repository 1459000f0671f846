import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from strata.operators import (
    anti_join_new,
    new_lake_rows,
    partition_values,
    prune_to_batch,
    route,
    specs_from_rows,
    typed_projection,
)
from strata.operators.spec import warehouse_ddl

KEYS = ("columnname", "colseq", "delta", "sql", "hashkeycheck", "partitionkeycheck", "clusterindexcol")


def spec(rows, name="ds"):
    return specs_from_rows(name, [dict(zip(KEYS, r)) for r in rows])


ORDERS_META = [
    ("o_orderkey", "1", "bigint", "bigint", "Y", "N", "Y"),
    ("o_custkey", "2", "bigint", "bigint", "Y", "N", "N"),
    ("o_orderstatus", "3", "string", "varchar(1)", "y", "N", "N"),
    ("o_totalprice", "10", "decimal(12,2)", "decimal(12,2)", "N", "N", "N"),
    ("o_orderdate", "11", "date", "date", "N", "Y", "N"),
]


def test_spec_sorts_numerically_and_reads_flags():
    s = spec(list(reversed(ORDERS_META)))
    assert s.names == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    assert s.hash_keys == ["o_orderkey", "o_custkey", "o_orderstatus"]
    assert s.partition_key == "o_orderdate"
    assert s.cluster_keys == ["o_orderkey"]
    ddl = warehouse_ddl(s)
    assert ddl.startswith("`o_orderkey` bigint, `o_custkey` bigint, `o_orderstatus` varchar(1)")
    assert ddl.endswith("`calhashkey` varchar(300), `calinsertdate` date, `calupdatedate` date")


def test_partition_key_must_be_single():
    two = spec([("a", "1", "date", "date", "N", "Y", "N"), ("b", "2", "date", "date", "N", "Y", "N")])
    with pytest.raises(ValueError):
        _ = two.partition_key
    with pytest.raises(ValueError):
        _ = spec([("a", "1", "int", "int", "Y", "N", "N")]).partition_key


def test_typed_projection_order_casts_and_passthrough(spark):
    df = spark.createDataFrame(
        [("7", "x", "OPEN", "12.345", "1995-01-02", "extra")],
        "o_orderdate string, o_custkey string, o_orderstatus string, o_totalprice string, o_orderkey string, note string",
    )
    df = df.withColumn("o_orderdate", F.lit("1995-01-02")).withColumn("o_orderkey", F.lit("7"))
    s = spec(ORDERS_META)
    lake = typed_projection(df, s, "lake")
    assert lake.columns == s.names + ["note"]
    r = lake.collect()[0]
    assert r.o_orderkey == 7 and r.o_custkey is None and r.o_orderdate == dt.date(1995, 1, 2)
    assert str(r.o_totalprice) == "12.35"
    wh = typed_projection(df, s, "sql").collect()[0]
    assert wh.o_orderstatus == "O"


def test_typed_projection_missing_declared_column(spark):
    df = spark.createDataFrame([("1",)], "o_orderkey string")
    with pytest.raises(ValueError):
        typed_projection(df, spec(ORDERS_META), "lake")


def _layer(spark, rows):
    return spark.createDataFrame(rows, "calhashkey string, p string, v int")


def test_pruned_anti_join_semantics(spark):
    stored = _layer(spark, [("h1", "d1", 1), ("h2", "d9", 2), ("h3", None, 3)])
    batch = _layer(spark, [("h1", "d1", 10), ("h2", "d1", 20), ("h3", None, 30), ("h4", "d2", 40)])
    got = sorted(r.v for r in new_lake_rows(batch, stored, "p").collect())
    # h1 stored on d1 (in batch) blocks; h2 is stored only on d9 (not in the
    # batch) and does not block; h3 is in the NULL partition, which the
    # batch has, so it blocks.
    assert got == [20, 40]


def test_pruning_fallback_is_exact(spark):
    stored = _layer(spark, [("h1", "d1", 1), ("h2", "d9", 2), ("h3", None, 3)])
    batch = _layer(spark, [("h1", "d1", 10), ("h2", "d1", 20), ("h3", None, 30), ("h4", "d2", 40)])
    assert partition_values(batch, "p", limit=2) is None
    pruned = prune_to_batch(stored, batch, "p", limit=2)
    assert sorted(r.v for r in pruned.collect()) == [1, 3]


def test_anti_join_keeps_column_order(spark):
    batch = _layer(spark, [("h1", "d1", 1), ("h2", "d1", 2)])
    stored = _layer(spark, [("h1", "d1", 1)])
    out = anti_join_new(batch, stored)
    assert out.columns == ["calhashkey", "p", "v"]
    assert [r.v for r in out.collect()] == [2]


def test_plan_prunes_partitions_and_avoids_null_aware_join(spark, scratch):
    from strata.sources.layers import read_layer, write_layer

    path = f"{scratch}/layer"
    write_layer(_layer(spark, [("h1", "2024-01-01", 1), ("h2", "2024-01-02", 2)]), path, "p", mode="errorifexists")
    stored = read_layer(spark, path)
    assert dict(stored.dtypes)["p"] == "string"
    batch = _layer(spark, [("h1", "2024-01-01", 5), ("h9", "2024-01-03", 6)])
    new = new_lake_rows(batch, stored, "p")
    plan = explain_text(new)
    # A static IN list on the partition column reaches the layer scan, which
    # reads the hash column only; the anti-join is not null-aware.
    assert re.search(r"PartitionFilters: \[p#\d+ IN \(2024-01-01,2024-01-03\)\]", plan), plan
    assert "ReadSchema: struct<calhashkey:string>" in plan
    assert "LeftAnti" in plan and "NullAware" not in plan and "isnull(" not in plan
    assert sorted(r.v for r in new.collect()) == [6]


def test_route_like_and_chunks(spark):
    from strata.operators.routing import BUSINESS_COLUMNS

    files = spark.createDataFrame(
        [("/in/orders__feed_day1.csv", "orders__feed_day1.csv"), ("/in/unknown.csv", "unknown.csv"), ("/in/ORDERSXFEED.csv", "ORDERSXFEED.csv")],
        "path string, name string",
    ).withColumn("d_name", F.replace("name", F.lit("__"), F.lit("_")))
    meta_rows = [
        tuple([ds] + [f"{ds}_{i}" for i in range(1, len(BUSINESS_COLUMNS))])
        for ds in (" Orders_Feed ", "day1", "nothing", "csv")
    ]
    meta = spark.createDataFrame(meta_rows, ", ".join(f"{c} string" for c in BUSINESS_COLUMNS))
    one = route(files, meta)
    chunked = route(files, meta, limit=1)
    pairs = lambda df: sorted((r.name, r.dataset.strip()) for r in df.collect())
    assert pairs(one) == pairs(chunked)
    got = pairs(one)
    # "_" in a dataset name is a LIKE wildcard: ORDERSXFEED matches orders_feed.
    assert ("ORDERSXFEED.csv", "Orders_Feed") in got
    assert ("orders__feed_day1.csv", "Orders_Feed") in got
    assert ("orders__feed_day1.csv", "day1") in got
    assert ("unknown.csv", "csv") in got and not any(d == "nothing" for _, d in got)
    assert "catalog_table" in one.columns and "staging_schema" in one.columns


def explain_text(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_hot_key_split_is_exact(spark):
    from strata.operators import hot_keys

    rows = [("HOT", "d1", i) for i in range(30)] + [("WARM", "d1", 100 + i) for i in range(12)]
    rows += [(f"k{i}", "d1", 200 + i) for i in range(20)]
    batch = _layer(spark, rows)
    stored = _layer(spark, [("HOT", "d1", -1), ("k3", "d1", -2), ("k4", "d9", -3)])
    hot = hot_keys(batch, min_rows=10)
    assert hot == ["HOT", "WARM"]  # most frequent first, bounded by the threshold
    plain = sorted(r.v for r in new_lake_rows(batch, stored, "p").collect())
    split = sorted(r.v for r in new_lake_rows(batch, stored, "p", hot=hot).collect())
    assert split == plain
    # HOT is stored on a batch day: all 30 rows go; WARM is new: all 12 stay;
    # k3 is stored on d1 (blocked), k4 only on d9 (not in the batch, kept).
    assert len(plain) == 12 + 19
    assert hot_keys(batch, min_rows=10, limit=1) == ["HOT"]


def test_checked_broadcast_join_chunks_exactly(spark):
    from strata.operators.broadcast import broadcast_join, checked_chunks

    large = spark.range(200).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    small = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    pieces = checked_chunks(small, limit=7)
    assert len(pieces) > 1 and all(p.count() <= 7 for p in pieces)
    assert sum(p.count() for p in pieces) == 50
    got = sorted(tuple(r) for r in broadcast_join(large, small, "k", limit=7).collect())
    want = sorted(tuple(r) for r in large.join(small, "k").collect())
    assert got == want
    with pytest.raises(ValueError):
        broadcast_join(large, small, "k", how="left_semi")


def test_hot_key_split_reads_the_batch_once(spark):
    from strata.operators import hot_keys

    rows = [("HOT", "d1", i) for i in range(30)] + [(f"k{i}", "d1", 100 + i) for i in range(20)]
    batch = _layer(spark, rows).distinct()
    stored = _layer(spark, [("k1", "d1", -1)])
    hot = hot_keys(batch, min_rows=10)
    out = new_lake_rows(batch, stored, "p", values=["d1"], hot=hot)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # one scan of the batch and one of the stored side: hot rows are not a
    # second branch over the batch
    assert plan.count("Scan ExistingRDD") == 2, plan
    assert out.count() == 49


def test_hot_key_split_with_integer_keys_and_tilde_values(spark):
    from strata.operators import anti_join_new

    batch = spark.createDataFrame([(1, i) for i in range(5)] + [(2, 9), (3, 8)], "k bigint, v int")
    stored = spark.createDataFrame([(1,), (3,)], "k bigint")
    plain = sorted(tuple(r) for r in anti_join_new(batch, stored, "k").collect())
    split = sorted(tuple(r) for r in anti_join_new(batch, stored, "k", hot=[1, 2]).collect())
    assert plain == split == [(2, 9)]
    sbatch = spark.createDataFrame([("~1", 1), ("~1", 2), ("x", 3)], "k string, v int")
    sstored = spark.createDataFrame([("~7",), ("x",)], "k string")
    got = sorted(tuple(r) for r in anti_join_new(sbatch, sstored, "k", hot=["~1"]).collect())
    assert got == [("~1", 1), ("~1", 2)]


def test_hot_keys_are_whole_and_few_by_share(spark, monkeypatch):
    import strata.operators.increment as inc

    monkeypatch.setattr(inc, "MAX_HOT_KEYS", 4)
    batch = spark.createDataFrame([(k,) for k, n in (("a", 8), ("b", 6), ("c", 6), ("d", 4)) for _ in range(n)], "k string")
    # 24 rows: a key is listed from more than a quarter of them, or min_rows.
    assert inc.hot_keys(batch, "k", min_rows=1) == ["a"]
    assert set(inc.hot_keys(batch, "k", min_rows=1, rows=20)) == {"a", "b", "c"}
    assert inc.hot_keys(batch, "k", min_rows=8) == []


def test_broadcast_is_bounded_in_bytes(spark):
    from strata.operators.broadcast import broadcast_join, checked_chunks

    small = spark.createDataFrame([(i, "x" * 200) for i in range(20)], "k int, t string")
    pieces = checked_chunks(small, max_bytes=1500)
    assert len(pieces) > 1 and sorted(r["k"] for p in pieces for r in p.collect()) == list(range(20))
    large = spark.range(40).select((F.col("id") % 20).cast("int").alias("n"))
    got = broadcast_join(large, small, F.col("n") == F.col("k"), max_bytes=1500)
    assert sorted(r["k"] for r in got.collect()) == sorted(i % 20 for i in range(40))


def test_partition_range_and_semi_join_above_the_limit(spark):
    stored = spark.createDataFrame([(p, i) for i, p in enumerate(["a", "c", "d", "f", None])], "p string, v int")
    for days, want in ((["c", "f", "g"], {1, 3}), (["c", None, "d"], {1, 2, 4}), ([None, None], {4})):
        batch = spark.createDataFrame([(p,) for p in days], "p string")
        assert {r["v"] for r in prune_to_batch(stored, batch, "p", limit=0).collect()} == want
