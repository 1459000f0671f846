"""Properties of incremental loading, checked on random small batches."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import hot_keys, new_lake_rows

SCHEMA = "calhashkey string, p string, v int"

rows_strategy = st.lists(
    st.tuples(
        st.sampled_from(["h1", "h2", "h3", "h4"]),
        st.sampled_from(["d1", "d2", "d3", None]),
        st.integers(0, 3),
    ),
    min_size=1,
    max_size=14,
)

SETTINGS = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def _load_in_parts(spark, parts):
    """Sequential loads: each part's distinct rows against what is stored."""
    stored = None
    before = 0
    for part in parts:
        batch = spark.createDataFrame(part, SCHEMA).distinct()
        new = new_lake_rows(batch, stored, "p")
        new_rows = new.collect()
        stored_rows = (stored.collect() if stored is not None else []) + new_rows
        # after = before + new
        assert len(stored_rows) == before + len(new_rows)
        before = len(stored_rows)
        stored = spark.createDataFrame([tuple(r) for r in stored_rows], SCHEMA)
    return stored


@SETTINGS
@given(rows=rows_strategy, cut=st.integers(0, 14))
def test_split_file_keeps_hash_set(spark, rows, cut):
    whole = _load_in_parts(spark, [rows])
    parts = [p for p in (rows[:cut], rows[cut:]) if p]
    split = _load_in_parts(spark, parts)
    hashes = lambda df: {r[0] for r in df.select("calhashkey").collect()}
    assert hashes(whole) == hashes(split)


@SETTINGS
@given(rows=rows_strategy)
def test_loading_twice_adds_nothing(spark, rows):
    stored = _load_in_parts(spark, [rows])
    again = new_lake_rows(spark.createDataFrame(rows, SCHEMA).distinct(), stored, "p")
    assert again.count() == 0


@SETTINGS
@given(batch_rows=rows_strategy, stored_rows=rows_strategy, threshold=st.integers(0, 4))
def test_hot_key_split_equals_plain(spark, batch_rows, stored_rows, threshold):
    batch = spark.createDataFrame(batch_rows, SCHEMA).distinct()
    stored = spark.createDataFrame(stored_rows, SCHEMA)
    hot = hot_keys(batch, min_rows=threshold)
    plain = sorted((tuple(r) for r in new_lake_rows(batch, stored, "p").collect()), key=repr)
    split = sorted((tuple(r) for r in new_lake_rows(batch, stored, "p", hot=hot).collect()), key=repr)
    assert plain == split


def test_property_helpers_notice_a_difference(spark):
    # guard: the sequential helper really drops a row stored on a batch day
    stored = _load_in_parts(spark, [[("h1", "d1", 0)], [("h1", "d1", 1), ("h1", "d2", 2)]])
    assert sorted(r.v for r in stored.filter(F.col("calhashkey") == "h1").collect()) == [0]
