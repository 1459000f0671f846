"""The key index of a target: plans, appends, and when it is not believed."""

import datetime as dt
import re

import pytest

from strata.config import LakeConfig
from strata.functions.keys import HASH_COL
from strata.plans import load_conformed, load_enriched, load_warehouse
from strata.sources.keyindex import KeyIndex, new_by_index
from test_loads import TS, config, feed, spec


@pytest.fixture()
def index(spark, scratch):
    spark.sql("CREATE DATABASE IF NOT EXISTS keyindex_t")
    spark.sql("DROP TABLE IF EXISTS keyindex_t.k__keys")
    return KeyIndex(spark, "keyindex_t", "k__keys", f"{scratch}/k__keys", buckets=4)


def hashes(spark, *values):
    return spark.createDataFrame([(v,) for v in values], f"{HASH_COL} string")


def test_second_load_moves_the_batch_only(spark, index):
    keys = index.build(hashes(spark, *[f"h{i}" for i in range(100)], "h1"), "v1")
    assert keys.count() == 100
    index.append(hashes(spark, "x1", "x2"), "v2")
    assert index.keys("v1") is None and index.keys("") is None
    keys = index.keys("v2")
    assert keys.count() == 102
    batch = hashes(spark, "h5", "new", "x2", "new")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = new_by_index(batch, keys)
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and "SelectedBucketsCount" in plan
    # The one exchange is the batch's; the stored side has none, nor a distinct.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "HashAggregate" not in plan
    assert sorted(r[0] for r in new.collect()) == ["new", "new"]


def test_index_is_written_anew_after_many_appends(spark, index, monkeypatch):
    import strata.sources.keyindex as keyindex

    monkeypatch.setattr(keyindex, "MAX_APPENDS", 2)
    index.build(hashes(spark, "a"), "v0")
    for i in range(3):
        index.append(hashes(spark, f"b{i}"), f"v{i + 1}")
    assert index.keys("v3") is None  # the load builds it again


def test_loads_use_and_extend_the_index(spark, scratch, monkeypatch):
    cfg = config(scratch, "kidx")
    spark.sql("DROP DATABASE IF EXISTS dw__kidx CASCADE")
    built = []
    real = KeyIndex.build
    monkeypatch.setattr(KeyIndex, "build", lambda self, rows, version: built.append(self.table) or real(self, rows, version))
    counts = []
    for i in range(1, 4):
        t = feed(cfg, f"ev__{i}.csv", f"k,day\n{i},2024-01-0{i}\n1,2024-01-0{i}\n", schema="kidx")
        days = load_conformed(spark, cfg, t, spec(), TS).partitions
        e = load_enriched(spark, cfg, t, spec(), days)
        w = load_warehouse(spark, cfg, t, spec(), e.partitions)
        counts.append((e.new, w.new))
    assert counts == [(1, 1), (1, 1), (1, 1)]
    assert len(built) == 2  # once for each target, when it was created
    assert spark.table("kidx_e.kidx_ev__keys").count() == spark.table("kidx_e.kidx_ev").count() == 3
    assert spark.table("staging_dw__kidx.ev__keys").count() == 3


def test_index_of_a_load_that_died_is_not_believed(spark, scratch, monkeypatch):
    cfg = config(scratch, "kdied")
    t = feed(cfg, "ev__1.csv", "k,day\n1,2024-01-01\n", schema="kdied")
    load_enriched(spark, cfg, t, spec(), load_conformed(spark, cfg, t, spec(), TS).partitions)
    t = feed(cfg, "ev__2.csv", "k,day\n2,2024-01-02\n", schema="kdied")
    days = load_conformed(spark, cfg, t, spec(), TS).partitions

    def fails(*a):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(KeyIndex, "append", fails)
        with pytest.raises(RuntimeError):
            load_enriched(spark, cfg, t, spec(), days)
    # The rows are there, their hashes are not: nothing is added twice.
    assert load_enriched(spark, cfg, t, spec(), days).new == 0
    assert sorted(r.k for r in spark.table("kdied_e.kdied_ev").collect()) == [1, 2]
    assert spark.table("kdied_e.kdied_ev__keys").count() == 2


def test_loads_without_an_index(spark, scratch):
    cfg = LakeConfig.under(scratch, conformed_db="noidx_c", enriched_db="noidx_e", sandbox_db="noidx_s", key_index=False)
    for i, want in ((1, 1), (2, 1)):
        t = feed(cfg, f"ev__{i}.csv", f"k,day\n{i},2024-01-01\n", schema="noidx")
        days = load_conformed(spark, cfg, t, spec(), TS + dt.timedelta(days=i)).partitions
        assert load_enriched(spark, cfg, t, spec(), days).new == want
    assert not spark.catalog.tableExists("noidx_e.noidx_ev__keys")
