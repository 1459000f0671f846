"""Lost values: counted in load results, kept in quarantine tables."""

from pyspark.sql import functions as F

from strata.operators import specs_from_rows
from strata.operators.failures import failed_cast, failed_cells, failure_counts
from strata.plans import load_conformed, load_enriched, load_warehouse
from strata.plans.files import load_files_at_once
from test_loads import KEYS, TS, config, feed

SPEC = specs_from_rows(
    "ev",
    [
        dict(zip(KEYS, r, strict=True))
        for r in (("k", "1", "int", "smallint", "Y", "N", "Y"), ("day", "2", "date", "date", "N", "Y", "N"), ("v", "3", "decimal(6,2)", "decimal(3,1)", "N", "N", "N"))
    ],
)
TEXT = "k,day,v\n1,2024-01-01,1.5\n2,2024-13-45,x\n,2024-01-02,\n40000,soon,123.4\nten,,2\n"


def cells(spark, name):
    return sorted((r.column, r.value, r.wanted) for r in spark.table(name).collect())


def test_counts_and_cells_of_a_frame(spark):
    df = spark.createDataFrame([("1", "2024-01-01", "x"), ("a", None, None), (None, "no", "1")], "k string, day string, v string")
    tests = failed_cast(df, SPEC)
    assert {r["column"]: r.failures for r in failure_counts(df, tests).collect()} == {"k": 1, "day": 1, "v": 1}
    got = failed_cells(df.withColumn("calhashkey", F.col("k")), tests).collect()
    assert sorted((str(r.calhashkey), r.column, r.value, r.wanted) for r in got) == [
        ("1", "v", "x", "decimal(6,2)"),
        ("None", "day", "no", "date"),
        ("a", "k", "a", "int"),
    ]


def test_loads_account_for_lost_values(spark, scratch):
    cfg = config(scratch, "lost")
    for db in ("dw__lost", "staging_dw__lost"):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    t = feed(cfg, "ev__1.csv", TEXT, schema="lost")
    first = load_conformed(spark, cfg, t, SPEC, TS)
    typed = load_enriched(spark, cfg, t, SPEC, first.partitions)
    warehouse = load_warehouse(spark, cfg, t, SPEC, typed.partitions)
    assert (first.failed, typed.failed, warehouse.failed) == ({"day": 2}, {"k": 1, "v": 1}, {"k": 1, "v": 1})
    assert cells(spark, "lost_c.lost_ev__failed") == [("day", "2024-13-45", "yyyy-MM-dd"), ("day", "soon", "yyyy-MM-dd")]
    assert cells(spark, "lost_e.lost_ev__failed") == [("k", "ten", "int"), ("v", "x", "decimal(6,2)")]
    assert cells(spark, "staging_dw__lost.ev__failed") == [("k", "40000", "smallint"), ("v", "123.40", "decimal(3,1)")]
    # Once more, and with a file that adds one: nothing is recorded twice.
    load_conformed(spark, cfg, t, SPEC, TS)
    load_enriched(spark, cfg, t, SPEC, None)
    more = feed(cfg, "ev__2.csv", "k,day,v\n7,later,y\n", schema="lost")
    third = feed(cfg, "ev__3.csv", "k,day,v\n8,2024-01-05,2\n", schema="lost")
    on = dict.fromkeys(("conformed_layer", "enrich_layer"), "Y")
    from dataclasses import replace

    results = load_files_at_once(spark, cfg, [replace(x, flags=on) for x in (more, third)], SPEC, TS)
    assert [r.failed for r in results] == [{"day": 1}, {}, {"k": 1, "v": 2}]
    assert cells(spark, "lost_c.lost_ev__failed") == [("day", "2024-13-45", "yyyy-MM-dd"), ("day", "later", "yyyy-MM-dd"), ("day", "soon", "yyyy-MM-dd")]
    assert cells(spark, "lost_e.lost_ev__failed") == [("k", "ten", "int"), ("v", "x", "decimal(6,2)"), ("v", "y", "decimal(6,2)")]


def test_quarantine_switched_off(spark, scratch):
    cfg = config(scratch, "noq", quarantine=False)
    t = feed(cfg, "ev__1.csv", TEXT, schema="noq")
    assert load_conformed(spark, cfg, t, SPEC, TS).failed == {"day": 2}
    assert not spark.catalog.tableExists("noq_c.noq_ev__failed")
