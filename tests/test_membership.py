"""Membership bitmaps: the rows of the plain anti-join, most of them unjoined."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from strata.functions.keys import HASH_COL
from strata.operators import new_lake_rows
from strata.operators.increment import prune_to_batch
from strata.plans import load_conformed
from strata.operators.membership import BUCKET_BITS, MAX_BITS, day_bitmaps, domain_bits, new_rows_by_bitmap, observed_rows, with_chance
from test_loads import TS, config, feed, spec

SCHEMA = f"{HASH_COL} string, p string, v int"
ROWS = st.lists(st.tuples(st.sampled_from([f"k{i}" for i in range(9)]), st.sampled_from(["d1", "d2", None]), st.integers(0, 1)), max_size=9)
FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@FEW
@given(stored=ROWS, batch=ROWS, hot=st.sampled_from([None, ["k1"]]))
def test_rows_of_the_anti_join(spark, stored, batch, hot):
    kept = spark.createDataFrame(stored, SCHEMA)
    new = spark.createDataFrame(batch, SCHEMA).distinct()
    pruned = prune_to_batch(kept, new, "p")
    got = new_rows_by_bitmap(new, pruned, day_bitmaps(pruned, "p", BUCKET_BITS), BUCKET_BITS, hot=hot)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, new_lake_rows(new, kept, "p").collect()))


def test_rows_with_a_clear_bit_skip_the_join(spark):
    stored = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias(HASH_COL), F.lit("d").alias("p"))
    batch = spark.range(10_000, 60_000).select(F.sha2(F.col("id").cast("string"), 256).alias(HASH_COL), F.lit("d").alias("p"))
    bits = domain_bits(20_000)
    assert bits == 1 << 18
    sure, may = Observation("sure"), Observation("may")
    # Bitmaps that came in several appends of one day.
    halves = day_bitmaps(stored.limit(9_000), "p", bits).unionByName(day_bitmaps(stored, "p", bits))
    new = new_rows_by_bitmap(batch, stored, halves, bits, sure_seen=sure, may_seen=may)
    assert new.agg(F.countDistinct(HASH_COL)).collect()[0][0] == 40_000
    # The 10,000 stored ones, and about a thirteenth of the others.
    assert observed_rows(sure) + observed_rows(may) == 50_000 and 12_000 < observed_rows(may) < 14_000
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Nested" not in plan


def test_loads_keep_bitmaps_and_look_up_little(spark, scratch):
    cfg = config(f"{scratch}/a", "bits", membership_bits=1 << 16)
    plain = config(f"{scratch}/b", "nobits")
    results = []
    for i in range(1, 5):
        text = "k,day\n" + "".join(f"{i * 100 + j},2024-01-0{1 + j % 3}\n" for j in range(50)) + f"{i * 100 - 60},2024-01-02\n,no day\n"
        results.append([load_conformed(spark, c, feed(c, f"ev__{i}.csv", text, schema=s), spec(), TS) for c, s in ((cfg, "bits"), (plain, "nobits"))])
    for with_bits, without in results:
        assert (with_bits.incoming, with_bits.new) == (without.incoming, without.new)
    # Each file's null day and one key of the file before.
    assert [r.looked_up for r, _ in results] == [None, 2, 2, 2]
    rows = [sorted(map(str, spark.table(f"{t}_c.{t}_ev").collect())) for t in ("bits", "nobits")]
    assert rows[0] == rows[1]
    assert {r.day for r in spark.table("bits_c.bits_ev__bits").collect()} == {"2024-01-01", "2024-01-02", "2024-01-03", None}


def test_a_domain_is_bounded(spark):
    assert domain_bits(0) == BUCKET_BITS and domain_bits(10**12) == MAX_BITS
    one = spark.createDataFrame([("k", "d", 1)], SCHEMA)
    with pytest.raises(ValueError, match="broadcast bound"):
        with_chance(one, day_bitmaps(one, "p", 2 * MAX_BITS), 2 * MAX_BITS, "x")
