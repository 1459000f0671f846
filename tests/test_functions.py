import hashlib

import pytest
from pyspark.sql import functions as F

from strata.functions import (
    clean_column_name,
    clean_columns,
    clean_name_expr,
    parse_type,
    partition_day,
    row_hash,
    with_audit_columns,
)

# Hand-derived expectations for the cleaning rules.
CASES = [
    ("Growth %", "growth_percent"),
    ("Price [USD]", "price_"),
    (" Depth (ft) ", "depth_ft"),
    ("Oil/Gas: Rate, net", "oil_gas__rate_net"),
    ("a[%]b", "ab"),
    ("O_OrderKey", "o_orderkey"),
    ("O_TotalPrice [USD]", "o_totalprice_"),
    ("x[y][z]w", "xw"),
    ("semi;colon", "semicolon"),
]


@pytest.mark.parametrize("raw,expected", CASES)
def test_clean_column_name(raw, expected):
    assert clean_column_name(raw) == expected


def test_clean_expr_matches_driver_rules(spark):
    df = spark.createDataFrame([(r,) for r, _ in CASES], "raw string")
    got = dict(df.select("raw", clean_name_expr("raw").alias("c")).collect())
    assert got == {r: e for r, e in CASES}


def test_clean_columns_one_projection_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`Growth %` int, `Price [USD]` int")
    assert clean_columns(df).columns == ["growth_percent", "price_"]
    clash = spark.createDataFrame([(1, 2)], "`A B` int, `a_b` int")
    with pytest.raises(ValueError):
        clean_columns(clash)


def test_row_hash_matches_sha256_and_skips_nulls(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("1", "2", "3")], "x string, y string, z string")
    got = [r[0] for r in df.select(row_hash(["x", "y", "z"])).collect()]
    want_ab = hashlib.sha256(b"a||b").hexdigest().upper()
    assert got[0] == got[1] == want_ab
    assert got[2] == hashlib.sha256(b"1||2||3").hexdigest().upper()


def test_row_hash_needs_keys():
    with pytest.raises(ValueError):
        row_hash([])


def test_partition_day_text_and_unparseable(spark):
    df = spark.createDataFrame(
        [("1995-03-15",), ("1995-03-15 10:11:12",), ("15/03/1995",), ("garbage",), (None,)], "d string"
    )
    got = [r[0] for r in df.select(partition_day("d")).collect()]
    assert got == ["1995-03-15", "1995-03-15", None, None, None]


def test_audit_columns(spark):
    import datetime as dt

    df = with_audit_columns(spark.range(2), dt.datetime(2024, 2, 1))
    rows = df.collect()
    assert all(r.calinsertdate == dt.datetime(2024, 2, 1) and r.calupdatedate is None for r in rows)
    assert dict(df.dtypes)["calupdatedate"] == "timestamp"


def test_parse_type_dialects(spark):
    v = parse_type("varchar(3)", "sql")
    assert (v.max_length, v.pad, v.ddl) == (3, False, "varchar(3)")
    c = parse_type("char(4)", "sql")
    assert c.pad and c.ddl == "char(4)"
    assert parse_type("float", "sql").spark_type == "double"
    assert parse_type("float", "lake").spark_type == "float"
    assert parse_type("varchar(3)", "lake").max_length is None
    with pytest.raises(ValueError):
        parse_type("struct<a:int>")
    from strata.functions import cast_to

    df = spark.createDataFrame([("abcdef",), ("ab",)], "s string")
    got = [tuple(r) for r in df.select(cast_to("s", v), cast_to("s", c), cast_to("s", parse_type("int"))).collect()]
    assert got == [("abc", "abcd", None), ("ab", "ab  ", None)]
