"""The trigram index of dataset names against the plain LIKE join."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.routing import BUSINESS_COLUMNS, match_condition, route
from strata.plans import Target

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
PART = st.lists(st.sampled_from(["ab", "abc", "Day", "_", "%", "1", " ", "é", "x.y", "__"]), min_size=0, max_size=4).map("".join)


def files_of(spark, names):
    df = spark.createDataFrame([(f"/in/{n}", n) for n in names], "path string, name string")
    return df.withColumn("d_name", F.replace("name", F.lit("__"), F.lit("_")))


def meta_of(spark, names):
    rows = [(n, *[f"c{i}" for i in range(1, len(BUSINESS_COLUMNS))]) for n in names]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in BUSINESS_COLUMNS))


@FEW
@given(files=st.lists(PART, max_size=8), names=st.lists(st.one_of(st.none(), PART), max_size=8))
def test_index_equals_the_plain_join(spark, files, names):
    f, m = files_of(spark, files), meta_of(spark, names)
    got = sorted((r.name, r.dataset) for r in route(f, m).collect())
    plain = f.join(m, match_condition(F.col("d_name"), F.col("dataset"))).select("name", "dataset").distinct()
    assert got == sorted(map(tuple, plain.collect()))


def test_many_names_need_no_nested_loop(spark):
    files = files_of(spark, [f"feed_{i}_part_{i % 7}.csv" for i in range(500)])
    routed = route(files, meta_of(spark, [f"feed_{i}_part" for i in range(3000)]))
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert routed.select("dataset").distinct().count() == 500


def test_routed_names_are_those_of_the_load(spark):
    row = route(files_of(spark, ["feed_1.csv"]), meta_of(spark, ["feed"])).collect()[0]
    t = Target.from_row(row)
    assert (row.layer_subpath, row.catalog_table) == (t.subpath, t.catalog_table)
    assert (row.warehouse_table, row.staging_schema) == (f"{t.warehouse_db}.{t.sql_table}", t.staging_schema)
