"""Day sets as runs: exact above the listing limit, as static filters."""

import datetime as dt
import random
import re

import pytest

from strata.operators import new_lake_rows
from strata.operators.increment import day_runs, prune_to_batch
from strata.sources.layers import read_layer, write_layer
from test_operators import explain_text

SCHEMA = "calhashkey string, p string, v int"


def day(n):
    return str(dt.date(2024, 1, 1) + dt.timedelta(days=n))


def frame(spark, days):
    return spark.createDataFrame([(d,) for d in days], "t string").distinct()


def test_runs_are_maximal(spark):
    days = [day(n) for n in (0, 1, 2, 5, 6, 9, 40)]
    runs, exact = day_runs(frame(spark, [*days, None]), "t")
    assert exact and runs == [(day(0), day(2)), (day(5), day(6)), (day(9), day(9)), (day(40), day(40)), (None, None)]
    runs, exact = day_runs(frame(spark, days), "t", limit=2)  # the widest gap stays
    assert not exact and runs == [(day(0), day(9)), (day(40), day(40))]
    assert day_runs(frame(spark, []), "t") == ([], True)
    runs, exact = day_runs(frame(spark, [day(0), day(1), "odd", "text"]), "t")
    assert exact and runs == [(day(0), day(1)), ("odd", "odd"), ("text", "text")]


@pytest.mark.parametrize("limit", [200, 3])
def test_rows_are_those_of_the_day_list(spark, monkeypatch, limit):
    import strata.operators.increment as inc

    r = random.Random(limit)
    stored = spark.createDataFrame([(f"k{r.randint(0, 30)}", r.choice([day(r.randint(0, 60)), None]), i) for i in range(120)], SCHEMA)
    batch = spark.createDataFrame([(f"k{r.randint(0, 60)}", r.choice([day(r.randint(20, 50)), None]), i) for i in range(40)], SCHEMA)
    want = sorted(map(str, new_lake_rows(batch, stored, "p").collect()))
    monkeypatch.setattr(inc.day_runs, "__defaults__", (limit,))
    monkeypatch.setattr(inc.prune_to_batch, "__defaults__", (None, 2))
    assert sorted(map(str, new_lake_rows(batch, stored, "p").collect())) == want


def test_runs_reach_the_partition_filters(spark, scratch):
    path = f"{scratch}/layer"
    rows = [(f"k{n}", day(n), n) for n in range(30)]
    write_layer(spark.createDataFrame(rows, SCHEMA), path, "p", mode="errorifexists")
    batch = spark.createDataFrame([(f"x{n}", day(n), n) for n in (3, 4, 5, 6, 20, 21)], SCHEMA)
    pruned = prune_to_batch(read_layer(spark, path), batch, "p", limit=2)
    plan = explain_text(pruned)
    filters = re.search(r"PartitionFilters: \[(.*)\]", plan)[1]
    assert f">= {day(3)}" in filters and f"<= {day(6)}" in filters and f"<= {day(21)}" in filters
    assert "Join" not in plan and sorted(r.v for r in pruned.collect()) == [3, 4, 5, 6, 20, 21]
