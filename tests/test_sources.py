import os

import pytest
from pyspark.sql import functions as F

from strata.sources import list_files, read_csv
from strata.sources.catalog import add_partitions, known_partitions, quote, register_layer_table
from strata.sources.layers import LayerTable, layer_exists, open_layer, save_to_layer


def test_quote_rejects_injection():
    assert quote("core_orders") == "`core_orders`"
    for bad in ("a b", "x`; DROP TABLE y", "", None, "a.b"):
        with pytest.raises(ValueError):
            quote(bad)


def test_listing_missing_folder_is_empty(spark, scratch):
    assert list_files(spark, f"{scratch}/nope").count() == 0
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/a__b.csv", "w") as f:
        f.write("x\n1\n")
    rows = list_files(spark, f"{scratch}/in").collect()
    assert [(r.name, r.d_name) for r in rows] == [("a__b.csv", "a_b.csv")]


def test_read_csv_gate_and_strings(spark, scratch):
    with pytest.raises(ValueError):
        read_csv(spark, f"{scratch}/file.txt")
    path = f"{scratch}/f.csv"
    with open(path, "w") as f:
        f.write("A,B\n1,2.5\n")
    assert read_csv(spark, path).dtypes == [("A", "string"), ("B", "string")]


def test_layer_table_roundtrip_with_null_partition(spark, scratch):
    lt = LayerTable(f"{scratch}/layer", "t_src", "events_layer", "p")
    spark.sql("DROP TABLE IF EXISTS t_src.events_layer")
    assert open_layer(spark, lt) is None and not layer_exists(spark, lt.path)
    df = spark.createDataFrame([("h1", "2024-01-01"), ("h2", None)], "calhashkey string, p string")
    save_to_layer(spark, lt, df, ["2024-01-01", None], mode="errorifexists")
    assert known_partitions(spark, "t_src", "events_layer") == {"2024-01-01", "__HIVE_DEFAULT_PARTITION__"}
    more = spark.createDataFrame([("h3", "2024-01-02", "x")], "calhashkey string, p string, extra string")
    save_to_layer(spark, lt, more, ["2024-01-02"], mode="append")
    got = open_layer(spark, lt)
    assert got.count() == 3 and "extra" in got.columns
    assert dict(got.dtypes)["p"] == "string"
    assert got.filter(F.col("p").isNull()).count() == 1
    # a new session-like state: drop the catalog entry, the path is adopted again
    spark.sql("DROP TABLE t_src.events_layer")
    assert open_layer(spark, lt).count() == 3


def test_add_partitions_sends_only_new(spark, scratch):
    path = f"{scratch}/t"
    spark.createDataFrame([("a", "d1")], "v string, p string").write.partitionBy("p").parquet(path)
    spark.sql("DROP TABLE IF EXISTS t_src.tp")
    register_layer_table(spark, "t_src", "tp", path, "parquet",
                         spark.createDataFrame([], "v string, p string").schema, "p", ["d1"])
    add_partitions(spark, "t_src", "tp", "p", ["d1", "d1"])
    assert known_partitions(spark, "t_src", "tp") == {"d1"}


def test_typed_partition_texts(spark):
    from strata.plans.typed import typed_partition_texts

    assert sorted(typed_partition_texts(spark, ["1995-01-01", None], "date"), key=str) == ["1995-01-01", None]
    assert typed_partition_texts(spark, ["1995-01-01"], "timestamp") == ["1995-01-01 00:00:00"]
    assert typed_partition_texts(spark, ["x"], None) == ["x"]


def test_empty_file_loads_nothing(spark, scratch):
    from strata import LakeConfig
    from strata.operators import specs_from_rows
    from strata.plans import Target, load_conformed

    keys = ("columnname", "colseq", "delta", "sql", "hashkeycheck", "partitionkeycheck", "clusterindexcol")
    spec = specs_from_rows("ds", [dict(zip(keys, ("id", "1", "int", "int", "Y", "N", "N"))),
                                  dict(zip(keys, ("day", "2", "date", "date", "N", "Y", "N")))])
    path = f"{scratch}/ds__empty.csv"
    with open(path, "w") as f:
        f.write("id,day\n")
    cfg = LakeConfig.under(scratch, conformed_db="t_empty")
    t = Target(path, "ds__empty.csv", "ds", "r", "d", "s", "t", "dw", "s", "t", "v")
    res = load_conformed(spark, cfg, t, spec)
    assert res.new == 0 and "empty file" in res.notes
    assert not layer_exists(spark, cfg.layer_path("conformed", t.subpath))


def _delta_available(spark, folder) -> bool:
    try:
        spark.range(1).write.format("delta").mode("overwrite").save(f"{folder}/delta-probe")
        return True
    except Exception:
        return False


def test_logged_format_layer_roundtrip(spark, scratch):
    """The Delta path: catalog points at the location, the log keeps schema."""
    if not _delta_available(spark, scratch):
        pytest.skip("no Delta jar on the classpath")
    lt = LayerTable(f"{scratch}/dlayer", "t_src", "delta_layer", "p", fmt="delta")
    df = spark.createDataFrame([("h1", "2024-01-01")], "calhashkey string, p string")
    save_to_layer(spark, lt, df, ["2024-01-01"], mode="errorifexists")
    more = spark.createDataFrame([("h2", "2024-01-02", "x")], "calhashkey string, p string, extra string")
    save_to_layer(spark, lt, more, ["2024-01-02"], mode="append")
    got = open_layer(spark, lt)
    assert got.count() == 2 and "extra" in got.columns


def test_adopting_a_typed_layer_restores_partition_type(spark, scratch):
    lt = LayerTable(f"{scratch}/typed", "t_src", "typed_layer", "d", partition_type="date")
    spark.sql("DROP TABLE IF EXISTS t_src.typed_layer")
    df = spark.createDataFrame([("h1", 1)], "calhashkey string, v int").withColumn("d", F.lit("1995-01-02").cast("date"))
    save_to_layer(spark, lt, df, ["1995-01-02"], mode="errorifexists")
    spark.sql("DROP TABLE t_src.typed_layer")  # a new session: only the folders remain
    got = open_layer(spark, lt)
    assert dict(got.dtypes)["d"] == "date"
    assert got.filter(F.col("d") == F.lit("1995-01-02").cast("date")).count() == 1


def test_listing_maps_part_files_to_their_directory(spark, scratch):
    folder = f"{scratch}/in"
    os.makedirs(folder)
    with open(f"{folder}/orders_feed__a.csv", "w") as f:
        f.write("k,day\n1,2024-01-01\n")
    two = spark.createDataFrame([(2, "2024-01-02"), (3, "2024-01-03")], "k int, day string")
    two.repartition(2).write.option("header", True).csv(f"{folder}/orders_feed__b.csv")
    rows = sorted((r.name, r.d_name) for r in list_files(spark, folder).collect())
    assert rows == [("orders_feed__a.csv", "orders_feed_a.csv"), ("orders_feed__b.csv", "orders_feed_b.csv")]
    entry = [r.path for r in list_files(spark, folder).collect() if r.name == "orders_feed__b.csv"][0]
    assert read_csv(spark, entry).count() == 2
