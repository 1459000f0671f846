"""Loading several files at once equals loading them one after another."""

import datetime as dt
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.config import LakeConfig
from strata.operators import specs_from_rows
from strata.operators.fold import FILE_COL, MAX_FOLD_FILES, fold_new_rows
from strata.operators.increment import new_lake_rows
from strata.plans import Target
from strata.plans.pipeline import load_dataset_files

SCHEMA = "calhashkey string, p string, v int"
FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

file_rows = st.lists(
    st.tuples(st.sampled_from(["k1", "k2", "k3", "k4", "k5"]), st.sampled_from(["d1", "d2", "d3", "d4", None]), st.integers(0, 2)),
    max_size=6,
)


def serial(stored, files):
    """The rows that each file adds, by the rule of one load."""
    have, added = list(stored), []
    for rows in files:
        days = {d for _, d, _ in rows}
        blocked = {k for k, d, _ in have if d in days}
        new = [r for r in dict.fromkeys(rows) if r[0] not in blocked]
        have += new
        added.append(new)
    return added


@FEW
@given(stored=file_rows, files=st.lists(file_rows, min_size=1, max_size=6), hot=st.sampled_from([None, ["k1"], ["k1", "k2"]]))
def test_fold_equals_serial_loads(spark, stored, files, hot):
    rows = [(*r, i) for i, f in enumerate(files) for r in f]
    batch = spark.createDataFrame(rows, SCHEMA + f", {FILE_COL} int").distinct()
    kept = spark.createDataFrame(stored, SCHEMA) if stored else None
    got = fold_new_rows(batch, kept, "p", hot=hot).collect()
    want = [(*r, i) for i, f in enumerate(serial(stored, files)) for r in f]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_fold_of_as_many_files_as_a_long_has_bits(spark):
    r = random.Random(3)
    files = [[(f"k{r.randint(0, 30)}", f"d{r.randint(0, 40)}", 0) for _ in range(5)] for _ in range(MAX_FOLD_FILES)]
    batch = spark.createDataFrame([(*x, i) for i, f in enumerate(files) for x in f], SCHEMA + f", {FILE_COL} int").distinct()
    want = [(*x, i) for i, f in enumerate(serial([], files)) for x in f]
    assert sorted(map(tuple, fold_new_rows(batch, None, "p").collect())) == sorted(want)


def test_fold_reads_the_batch_rows_once_and_joins_by_key(spark):
    batch = spark.createDataFrame([("k", "d", 1, 0)], SCHEMA + f", {FILE_COL} int")
    stored = spark.createDataFrame([("k", "d", 1)], SCHEMA)
    plan = fold_new_rows(batch, stored, "p")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


KEYS = ("columnname", "colseq", "delta", "sql", "hashkeycheck", "partitionkeycheck", "clusterindexcol")
TS = dt.datetime(2024, 2, 1)
SPEC = specs_from_rows(
    "ev", [dict(zip(KEYS, r, strict=True)) for r in (("k", "1", "string", "varchar(9)", "Y", "N", "Y"), ("day", "2", "date", "date", "N", "Y", "N"))]
)


def lake(scratch, tag, files, fold, flags=None, **kw):
    cfg = LakeConfig.under(f"{scratch}/{tag}", conformed_db=f"{tag}_c", enriched_db=f"{tag}_e", sandbox_db=f"{tag}_s", fold_files=fold, **kw)
    os.makedirs(cfg.incoming, exist_ok=True)
    flags = flags or dict.fromkeys(("conformed_layer", "enrich_layer", "sandbox_layer", "edw_layer"), "Y")
    out = []
    for name, text in files.items():
        path = f"{cfg.incoming}/{name}"
        with open(path, "w") as f:
            f.write(text)
        out.append(Target(path, name, "ev", "r", "d", "s", "ev", "dw", tag, "ev", "v_ev", flags))
    return cfg, out


def rows_of(df, drop=("calinsertdate",)):
    cols = sorted(c for c in df.columns if c not in drop)
    return cols, sorted(map(repr, (tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())))


def tables(spark, tag):
    names = [f"{tag}_c.{tag}_ev", f"{tag}_e.{tag}_ev", f"{tag}_s.{tag}_ev", f"dw__{tag}.ev"]
    return [rows_of(spark.table(n)) for n in names]


def make_files(seed, n):
    r = random.Random(seed)
    files = {}
    for i in range(n):
        extra = i % 3 == 2  # a column that other files lack
        lines = ["k,day" + (",extra" if extra else "")]
        for _ in range(r.randint(0, 7)):
            day = r.choice([f"2024-01-0{r.randint(1, 6)}", "", "no day"])
            lines.append(f"k{r.randint(1, 8)},{day}" + (f",x{r.randint(0, 1)}" if extra else ""))
        files[f"ev__{i:02d}.csv"] = "\n".join(lines) + "\n"
    return files


@pytest.fixture()
def steps(monkeypatch):
    """load_dataset_files with the metadata given."""
    import strata.plans.pipeline as pipeline

    monkeypatch.setattr(pipeline, "spec_for", lambda *a: SPEC)


@pytest.mark.parametrize("seed, fold", [(1, 62), (2, 3)])
def test_loads_of_many_files_equal_serial_loads(spark, scratch, steps, seed, fold):
    files = make_files(seed, 5)
    results = {}
    for tag, fold in ((f"one{seed}", 1), (f"all{seed}", fold)):
        for db in (f"dw__{tag}", f"staging_dw__{tag}"):
            spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
        cfg, targets = lake(scratch, tag, files, fold, full_counts=True)
        first = load_dataset_files(spark, cfg, targets, TS)
        results[tag] = first, tables(spark, tag)
    again = load_dataset_files(spark, cfg, targets, TS)
    assert not any(r.new for r in again) and tables(spark, tag) == results[tag][1]
    serial_results, serial_tables = results.pop(f"one{seed}")
    for folded, found in results.values():
        assert found == serial_tables
        of_file = [(r.existing, r.incoming, r.new, r.after, sorted(r.partitions, key=repr)) for r in folded if r.layer == "conformed"]
        assert of_file == [(r.existing, r.incoming, r.new, r.after, sorted(r.partitions, key=repr)) for r in serial_results if r.layer == "conformed"]
        for layer in ("enriched", "sandbox", "warehouse"):
            assert sum(r.new or 0 for r in folded if r.layer == layer) == sum(r.new or 0 for r in serial_results if r.layer == layer)


def test_many_files_for_targets_that_missed_loads(spark, scratch, steps):
    """Conformed loads alone, then files with every layer on."""
    files = make_files(5, 6)
    names = sorted(files)
    off = {"conformed_layer": "Y"}
    found = []
    for tag, fold in (("missone", 1), ("missall", 62)):
        spark.sql(f"DROP DATABASE IF EXISTS dw__{tag} CASCADE")
        for part, flags in ((names[:1], None), (names[1:4], off), (names[4:], None)):
            cfg, targets = lake(scratch, tag, {n: files[n] for n in part}, fold, flags)
            load_dataset_files(spark, cfg, targets, TS)
        found.append(tables(spark, tag))
    assert found[0] == found[1]


def test_rows_of_a_fold_that_died_are_not_added_twice(spark, scratch, steps, monkeypatch):
    import strata.sources.layers as layers

    files = make_files(6, 4)
    cfg, targets = lake(scratch, "folddied", files, 62)
    cfg2, targets2 = lake(scratch, "foldwell", files, 62)
    load_dataset_files(spark, cfg2, targets2, TS)
    real, calls = layers.add_partitions, []

    def fails(*a, **kw):
        calls.append(a)
        if len(calls) > 2:
            raise RuntimeError("driver lost")
        return real(*a, **kw)

    monkeypatch.setattr(layers, "add_partitions", fails)
    with pytest.raises(RuntimeError):
        load_dataset_files(spark, cfg, targets, TS)
    monkeypatch.setattr(layers, "add_partitions", real)
    load_dataset_files(spark, cfg, targets, TS)
    assert tables(spark, "folddied")[0] == tables(spark, "foldwell")[0]
    assert spark.table("folddied_c.folddied_ev").filter(F.col("k").isNull()).count() == 0


def test_new_lake_rows_is_a_fold_of_one_file(spark):
    stored = spark.createDataFrame([("a", "d1", 1), ("b", "d2", 1)], SCHEMA)
    batch = spark.createDataFrame([("a", "d1", 2), ("a", "d3", 2), ("b", "d1", 2), ("c", None, 3)], SCHEMA)
    one = fold_new_rows(batch.withColumn(FILE_COL, F.lit(0)), stored, "p").drop(FILE_COL)
    assert sorted(one.collect()) == sorted(new_lake_rows(batch, stored, "p").collect())
