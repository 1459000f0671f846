"""Backups that copy only files no kept backup holds, and their restore."""

import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from strata.plans import load_conformed
from strata.plans.conformed import conformed_table
from strata.sources import backup as bk
from test_loads import TS, config, feed, spec


def rows(df):
    cols = sorted(df.columns)
    return sorted(map(repr, (tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())))


def loads(spark, cfg, n, tag):
    """n files, each with a day of its own and one of the file before."""
    out, states = [], []
    for i in range(1, n + 1):
        name = f"{cfg.conformed_db}.{tag}_ev"
        states.append(rows(spark.table(name)) if spark.catalog.tableExists(name) else None)
        extra = ",x" if i == 3 else ""
        text = f"k,day{extra}\n" + "".join(f"{i}{j},2024-01-0{i - j}{extra}\n" for j in range(2)) + f"n{i},no day{extra}\n"
        t = feed(cfg, f"ev__{i}.csv", text, schema=tag)
        out.append((t, load_conformed(spark, cfg, t, spec(), TS)))
    return out, states


def test_restore_is_the_whole_table_before_the_append(spark, scratch):
    cfg = config(scratch, "bkup", backups_kept=9)
    done, states = loads(spark, cfg, 4, "bkup")
    assert done[0][1].backup is None
    for (_, result), before in list(zip(done, states, strict=True))[1:]:
        restored = bk.restored_rows(spark, result.backup)
        have = [c for c in restored.columns if c != "x" or result is done[3][1].backup]
        assert rows(restored.select(*have)) == before or rows(restored) == before
        assert all(r.intact for r in bk.verify_backup(spark, result.backup).collect())
    # Each backup copied the files of one append only.
    last = spark.read.parquet(done[3][1].backup)
    assert last.select("folder").distinct().count() == 3
    assert spark.read.parquet(done[1][1].backup).count() < last.count()
    total = sum(spark.read.parquet(f"{bk._root(done[3][1].backup)}/data/{f}").count() for f in bk.folders(spark, done[3][1].backup))
    assert total == len(states[3])  # no row is held twice


def test_kept_backups_decide_which_folders_stay(spark, scratch):
    cfg = config(scratch, "bkeep")
    done, states = loads(spark, cfg, 4, "bkeep")
    backup = done[3][1].backup
    root = bk._root(backup)
    assert bk.backups(spark, root) == [backup]
    assert sorted(os.listdir(f"{root}/data")) == bk.folders(spark, backup)
    assert rows(bk.restored_rows(spark, backup)) == states[3]
    # A table made anew is another set of files: nothing of the old is held.
    lt = conformed_table(cfg, done[0][0], spec())
    stored = spark.table(lt.name)
    again = bk.backup_files(spark, lt, stored, root)
    assert bk.backup_files(spark, lt, stored, root) == again  # no new file, no new backup
    kept = sorted(os.listdir(f"{root}/data"))
    folder = f"{lt.path}/day=2024-01-01"
    for f in os.listdir(folder):
        os.remove(f"{folder}/{f}")
    spark.catalog.refreshTable(lt.name)
    fewer = bk.backup_files(spark, lt, spark.table(lt.name), root)
    assert fewer != again and sorted(os.listdir(f"{root}/data")) == kept
    assert rows(bk.restored_rows(spark, fewer)) == rows(spark.table(lt.name).filter("day <> '2024-01-01' or day is null"))


def test_a_backup_that_died_does_not_count(spark, scratch, monkeypatch):
    cfg = config(scratch, "bdied")
    done, _ = loads(spark, cfg, 2, "bdied")
    backup, t = done[1][1].backup, feed(cfg, "ev__9.csv", "k,day\n9,2024-01-09\n", schema="bdied")
    before = rows(spark.table("bdied_c.bdied_ev"))

    class Dies(Observation):
        @property
        def get(self):  # read between the rows and the manifest
            raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(bk, "Observation", Dies)
        with pytest.raises(RuntimeError):
            load_conformed(spark, cfg, t, spec(), TS)
    root = bk._root(backup)
    assert bk.backups(spark, root) == [backup] and len(os.listdir(f"{root}/data")) == 2
    result = load_conformed(spark, cfg, t, spec(), TS)
    assert rows(bk.restored_rows(spark, result.backup)) == before
    assert sorted(os.listdir(f"{root}/data")) == bk.folders(spark, result.backup)


def test_restored_layer_and_damage(spark, scratch):
    cfg = config(scratch, "bres")
    done, states = loads(spark, cfg, 3, "bres")
    backup = done[2][1].backup
    other = config(f"{scratch}/other", "bres2")
    lt = conformed_table(other, done[0][0], spec())
    bk.restore_layer(spark, lt, backup)
    assert rows(spark.table(lt.name)) == states[2]
    folder = f"{bk._root(backup)}/data/{bk.folders(spark, backup)[0]}"
    spark.read.parquet(folder).limit(1).withColumn("k", F.lit("other")).write.mode("append").parquet(folder)
    assert sorted(r.intact for r in bk.verify_backup(spark, backup).collect()) == [False, True]
