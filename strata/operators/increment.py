"""Incremental new-row detection.

A row is new when its hash key is not stored yet. The stored side is
restricted to the partitions the batch touches (D3), with the partition
values turned into a static ``IN`` list so they become ``PartitionFilters``
on the layer scan: only the matching partition folders are listed and only
the ``calhashkey`` column is read from them.

The anti-join is an equi ``left_anti`` on the hash (never NULL), not
``NOT IN``: ``NOT IN`` compiles to a null-aware broadcast join that ships the
whole stored side to every task. The stored keys are de-duplicated first
(map-side partial aggregate) so a key repeated across many stored rows
crosses the shuffle once per map task; Spark then broadcasts the
de-duplicated side when it is small at runtime (AQE, size-checked) or runs a
sort-merge join.

Hot keys: AQE's skew-join split does not apply here — the de-duplicating
aggregate sits directly under the join, so the stored side is not a bare
shuffle. Keys that carry a large share of a batch (``hot_keys``) are
therefore settled outside the join: the stored side is filtered to those few
keys, the batch's hot rows cross the shuffle under a salted key (spread by a
hash of the whole row) and are kept or dropped by a static predicate. The
split is exact; it only changes where the work runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.keys import HASH_COL

# Above this many distinct partition values in one batch the value list is no
# longer a sensible static filter; the stored side is then cut to the maximal
# runs of the batch's days (still exact, see day_runs).
MAX_PRUNE_VALUES = 10_000

# Runs of consecutive days that become one static filter each.
MAX_DAY_RUNS = 200

# A key with more rows than this in one batch, and more than one row in
# MAX_HOT_KEYS of the batch, is settled outside the shuffle. Fewer than
# MAX_HOT_KEYS keys can hold such a share, so the list needs no cut.
HOT_KEY_ROWS = 1_000_000
MAX_HOT_KEYS = 10_000

_STORED_KEY = "__stored_key"
_JOIN_KEY = "__join_key"
_HOT_FLAG = "__hot"
_SALTS = 1024
_VALUE_SEP = "\u0001"
_BATCH_PART = "__batch_part"


def partition_values(df: DataFrame, col: str, limit: int = MAX_PRUNE_VALUES) -> list | None:
    """Distinct partition values of a batch (F2), or None above ``limit``.

    At most ``limit + 1`` values ever reach the driver.
    """
    rows = df.select(F.col(col).cast("string").alias(col)).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    return [r[0] for r in rows]


def partition_counts(
    df: DataFrame, col: str | Column, name: str, limit: int = MAX_PRUNE_VALUES
) -> tuple[list | None, int]:
    """Distinct values of a partition expression and the total row count.

    One aggregation reading only that column; at most ``limit + 1``
    (value, count) pairs reach the driver. Above ``limit`` the values are
    None (too many for a static list) and the rows are counted by themselves.
    """
    expr = F.col(col) if isinstance(col, str) else col
    rows = df.groupBy(expr.cast("string").alias(name)).count().limit(limit + 1).collect()
    if len(rows) > limit:
        return None, df.count()
    return [r[0] for r in rows], sum(r[1] for r in rows)


def partition_predicate(col: str, values: list) -> Column:
    """``p IN (values) [OR p IS NULL]`` — NULL is matched explicitly (D3)."""
    present = [v for v in values if v is not None]
    cond = F.col(col).isin(present) if present else F.lit(False)
    if len(present) != len(values):
        cond = cond | F.col(col).isNull()
    return cond


def prune_to_values(stored: DataFrame, col: str, values: list) -> DataFrame:
    return stored.filter(partition_predicate(col, values))


def prune_to_batch(
    stored: DataFrame,
    batch: DataFrame,
    col: str,
    values: list | None = None,
    limit: int = MAX_PRUNE_VALUES,
) -> DataFrame:
    """Stored rows whose partition value occurs in the batch (D3).

    ``values`` may be passed when the caller already collected them.
    """
    if values is None:
        values = partition_values(batch, col, limit)
    if values is not None:
        return prune_to_values(stored, col, values)
    parts = batch.select(F.col(col).cast("string").alias(_BATCH_PART)).distinct()
    runs, exact = day_runs(parts, _BATCH_PART)
    kept = stored.filter(runs_predicate(F.col(col).cast("string"), runs))
    if exact:
        return kept
    # Some runs were joined over a gap: the semi-join makes the cut exact.
    return kept.join(parts, F.col(col).cast("string").eqNullSafe(F.col(_BATCH_PART)), "left_semi")


def day_runs(days: DataFrame, col: str, limit: int = MAX_DAY_RUNS) -> tuple[list[tuple[str | None, str | None]], bool]:
    """Maximal runs of consecutive days among distinct day texts, at most
    ``limit`` of them: (first, last), and (None, None) for a NULL day.

    Runs are split at the widest gaps; whether all gaps were kept is the second
    result. A text that is no date is a run of its own, as long as all of them
    fit the limit. The window orders distinct days, which the calendar bounds."""
    day = F.col(col).try_cast("date")
    order = Window.orderBy(F.col("d").asc_nulls_last(), F.col("t"))
    dated = days.filter(F.col(col).isNotNull()).select(F.col(col).alias("t"), day.alias("d"))
    gap = F.datediff("d", F.lag("d").over(order))
    steps = dated.withColumn("gap", F.when(F.lag("t").over(order).isNull(), 0).otherwise(F.coalesce(gap, F.lit(2**30))))
    widest = F.row_number().over(Window.orderBy(F.desc("gap"), "t"))
    cuts = steps.withColumn("cut", ((F.col("gap") > 1) & (widest < F.lit(limit))).cast("int"))
    numbered = cuts.withColumn("run", F.sum("cut").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = numbered.groupBy("run").agg(F.min("t"), F.max("t"), F.count_if((F.col("gap") > 1) & (F.col("cut") == 0))).collect()
    runs: list[tuple[str | None, str | None]] = sorted((r[1], r[2]) for r in rows)
    if not days.filter(F.col(col).isNull()).isEmpty():
        runs.append((None, None))
    return runs, not any(r[3] for r in rows)


def runs_predicate(text: Column, runs: list[tuple[str | None, str | None]]) -> Column:
    """Whether a day text lies in one of the runs: a filter on the partition
    column alone, so folders outside the runs are not read."""
    tests = [text.isNull() if first is None else text.between(F.lit(first), F.lit(last)) for first, last in runs]
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def stored_keys(stored: DataFrame, key: str = HASH_COL) -> DataFrame:
    """The distinct stored keys, renamed so the anti-join is never ambiguous."""
    return stored.select(F.col(key).alias(_STORED_KEY)).distinct()


def hot_keys(
    df: DataFrame,
    key: str = HASH_COL,
    min_rows: int = HOT_KEY_ROWS,
    limit: int | None = None,
    rows: int | None = None,
) -> list:
    """Keys carrying more than ``min_rows`` rows and more than one in
    ``MAX_HOT_KEYS`` of the batch's ``rows`` (counted when not given), most
    frequent first.

    A partial aggregate per map task; fewer than ``MAX_HOT_KEYS`` keys can
    hold that share, so that many at most reach the driver and none that does
    is left out. ``limit`` asks for the top few only; loads do not use it.
    """
    if rows is None:
        rows = df.count()
    least = max(min_rows, rows // MAX_HOT_KEYS)
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    found = counted.filter(F.col("__rows") > F.lit(least)).orderBy(F.col("__rows").desc())
    if limit is not None:
        found = found.limit(limit)
    return [r[0] for r in found.collect()]


def anti_join_new(
    batch: DataFrame,
    stored: DataFrame,
    key: str = HASH_COL,
    hot: list | None = None,
    distinct_stored: bool = True,
) -> DataFrame:
    """Batch rows whose key is not among the stored keys.
    ``distinct_stored=False``: the stored side holds each key once already.

    Keeps the batch's column order. ``hot`` lists keys that carry a large
    share of the batch: they are settled by a lookup of those few keys on the
    stored side and a static predicate, while their rows are spread over the
    shuffle by a salted join key, so no task receives all of a hot key's rows.
    """
    keys = stored_keys(stored, key) if distinct_stored else stored.select(F.col(key).alias(_STORED_KEY))
    if not hot:
        return batch.join(keys, F.col(key) == F.col(_STORED_KEY), "left_anti")
    is_hot = F.col(key).isin(hot)
    stored_hot = {r[0] for r in stored.filter(is_hot).select(key).distinct().collect()}
    fresh_hot = [k for k in hot if k not in stored_hot]
    # Hot rows join on a salted key and a flag that rules out every match:
    # they pass the anti-join spread over many reducers by a hash of the
    # whole row, and the static list then keeps those whose key is not
    # stored. The batch is read once.
    salt = F.concat(F.lit("~"), F.pmod(F.xxhash64(*batch.columns), F.lit(_SALTS)).cast("string"))
    joined = batch.withColumns(
        {
            _JOIN_KEY: F.when(is_hot, salt).otherwise(F.col(key).cast("string")),
            _HOT_FLAG: is_hot,
        }
    )
    cond = (F.col(_JOIN_KEY) == F.col(_STORED_KEY).cast("string")) & ~F.col(_HOT_FLAG)
    out = joined.join(keys, cond, "left_anti")
    keep = ~is_hot | F.col(key).isin(fresh_hot) if fresh_hot else ~is_hot
    return out.filter(keep).drop(_JOIN_KEY, _HOT_FLAG)


def new_lake_rows(
    batch: DataFrame,
    stored: DataFrame | None,
    partition_col: str,
    values: list | None = None,
    key: str = HASH_COL,
    hot: list | None = None,
) -> DataFrame:
    """Lake load: distinct batch rows not stored in the batch's partitions.

    ``batch`` must already be distinct (the conformed and typed batches are);
    de-duplicating before the anti-join lets the map-side aggregate collapse
    repeated copies before they are shuffled.
    """
    if stored is None:
        return batch
    return anti_join_new(batch, prune_to_batch(stored, batch, partition_col, values), key, hot)


def new_warehouse_rows(
    batch: DataFrame, stored: DataFrame | None, key: str = HASH_COL, hot: list | None = None
) -> DataFrame:
    """Warehouse load: no pruning, no distinct here — that comes at insert."""
    if stored is None:
        return batch
    return anti_join_new(batch, stored, key, hot)


def count_with_values(df: DataFrame, col: str) -> tuple[int, list | None]:
    """Row count and the distinct values of ``col`` (as text), in one job.

    For frames whose ``col`` is already known to take few values (a subset
    of a batch's bounded partition list): the set is gathered by the same
    pass that counts, instead of a second distinct job.
    """
    obs = Observation("rows-and-values")
    # Observed metrics come back as scalars, so the set travels as one text.
    df.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.concat_ws(_VALUE_SEP, F.collect_set(F.col(col).cast("string"))).alias("values"),
        F.max(F.col(col).isNull().cast("int")).alias("nulls"),
    ).count()
    got = obs.get
    if "rows" not in got:  # no metrics when the plan had no rows to observe
        # Exact fallback; None when there are too many values to list.
        return df.count(), partition_values(df, col)
    text = got.get("values") or ""
    values = sorted(text.split(_VALUE_SEP)) if text else []
    if got.get("nulls"):
        values.append(None)
    return int(got["rows"]), values


def load_counts(stored: DataFrame | None, incoming: DataFrame, new: DataFrame) -> DataFrame:
    """F1 as a DataFrame: (metric, value) for existing, incoming, new, after.

    Each frame is read once and all are counted by one aggregate; ``after`` is
    the sum of existing and new rows, not another count.
    """
    frames = {"existing": stored, "incoming": incoming, "new": new}
    marks = [df.select(F.lit(metric).alias("of")) for metric, df in frames.items() if df is not None]
    rows = reduce(DataFrame.unionAll, marks)
    counted = rows.agg(*[F.count_if(F.col("of") == metric).alias(metric) for metric in frames])
    counted = counted.withColumn("after", F.col("existing") + F.col("new"))
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in (*frames, "after")]
    return counted.select(F.inline(F.array(*pairs)))
