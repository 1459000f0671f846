"""Several files of one dataset loaded at once, exactly as one after another.

Loading files in order, a key's rows of file *i* enter when the key is stored
on none of the days that file *i* holds, be it from before or from an earlier
file. What decides is therefore small: for every key the files it occurs in,
and for each of them the files whose days it would block.

Files have ranks 0, 1, ... and a set of files is a long, one bit a rank, so a
run folds up to ``MAX_FOLD_FILES`` files (more files are a chain of folds).
``day_files`` says of each day which files hold it. A key's rows in one file
OR those sets over their days (a map-side combined aggregate): the files that
are blocked once the rows have entered. Stored rows give the set that is
blocked from the start. An ``aggregate`` over the key's files in order settles
which of them enter. A key is at most ``MAX_FOLD_FILES`` pairs of numbers,
however many rows it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.keys import HASH_COL

#: Bits of a long that can stand for files (the sign bit stays clear).
MAX_FOLD_FILES = 62
#: The rank of the file a row came from.
FILE_COL = "__strata_file"

_DAY, _FILES, _BLOCKED, _ENTERED = "__day", "__files", "__blocked", "__entered"
_FOLD_KEY, _LOOKUP, _HOT_ENTERED = "__fold_key", "__lookup", "__hot_entered"
_SALTS = 1024


def file_bit(rank: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), rank.cast("int"))


def holds_file(files: Column, rank: Column) -> Column:
    return files.bitwiseAND(file_bit(rank)) != F.lit(0)


def file_counts() -> list[Column]:
    """Rows of every file, as columns f0, f1, ..."""
    return [F.count_if(F.col(FILE_COL) == F.lit(i)).alias(f"f{i}") for i in range(MAX_FOLD_FILES)]


def day_files(batch: DataFrame, part: str) -> DataFrame:
    """(day, set of files) for every day that occurs in a file."""
    return batch.groupBy(F.col(part).alias(_DAY)).agg(F.bit_or(file_bit(F.col(FILE_COL))).alias(_FILES))


def entered_files(batch: DataFrame, stored: DataFrame | None, part: str, days: DataFrame, key: str = HASH_COL) -> DataFrame:
    """(key, set of files whose rows with that key enter), for every key of
    ``batch``. ``stored`` need hold no other days than those of ``days``."""
    on_day = F.col(part).eqNullSafe(F.col(_DAY))
    per_file = (
        batch.select(key, FILE_COL, part)
        .join(days, on_day)
        .groupBy(key, FILE_COL)
        .agg(F.bit_or(_FILES).alias(_FILES))
    )
    per_key = per_file.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(FILE_COL, _FILES))).alias(_FILES))
    start = F.lit(0).cast("bigint")
    if stored is not None:
        held = (
            stored.select(F.col(key).alias(_LOOKUP), part)
            .join(days, on_day)
            .groupBy(_LOOKUP)
            .agg(F.bit_or(_FILES).alias(_BLOCKED))
        )
        per_key = per_key.join(held, F.col(key) == F.col(_LOOKUP), "left").drop(_LOOKUP)
        start = F.coalesce(F.col(_BLOCKED), start)

    def step(state: Column, file: Column) -> Column:
        blocked = holds_file(state["blocked"], file[FILE_COL])
        bit = file_bit(file[FILE_COL])
        return F.struct(
            F.when(blocked, state["blocked"]).otherwise(state["blocked"].bitwiseOR(file[_FILES])).alias("blocked"),
            F.when(blocked, state["entered"]).otherwise(state["entered"].bitwiseOR(bit)).alias("entered"),
        )

    zero = F.struct(start.alias("blocked"), F.lit(0).cast("bigint").alias("entered"))
    return per_key.select(key, F.aggregate(_FILES, zero, step, lambda s: s["entered"]).alias(_ENTERED))


def fold_new_rows(
    batch: DataFrame,
    stored: DataFrame | None,
    part: str,
    days: DataFrame | None = None,
    key: str = HASH_COL,
    hot: list | None = None,
    seen: Observation | None = None,
) -> DataFrame:
    """Rows of ``batch`` (distinct rows with their ``FILE_COL``) that a load of
    its files one after another adds to ``stored``. ``seen`` observes how many
    rows of each file were looked at (``file_counts``).

    ``hot`` lists keys with a large share of the rows: their few decisions are
    broadcast, and their rows cross the join spread by a hash of the row."""
    entered = entered_files(batch, stored, part, day_files(batch, part) if days is None else days, key)
    taken = F.col(_ENTERED)
    joined = batch if seen is None else batch.observe(seen, *file_counts())
    if hot:
        is_hot = F.col(key).isin(hot)
        # At most one row a hot key, and hot keys are bounded in number.
        few = entered.filter(is_hot).select(F.col(key).alias(_FOLD_KEY), F.col(_ENTERED).alias(_HOT_ENTERED))
        joined = joined.join(F.broadcast(few), F.col(key) == F.col(_FOLD_KEY), "left").drop(_FOLD_KEY)
        salt = F.concat(F.lit("~"), F.pmod(F.xxhash64(*batch.columns), F.lit(_SALTS)).cast("string"))
        joined = joined.withColumn(_FOLD_KEY, F.when(F.col(_HOT_ENTERED).isNotNull(), salt).otherwise(F.col(key).cast("string")))
        entered = entered.filter(~is_hot).withColumn(key, F.col(key).cast("string"))
        taken = F.coalesce(F.col(_HOT_ENTERED), taken)
    else:
        joined = joined.withColumn(_FOLD_KEY, F.col(key))
    entered = entered.withColumnRenamed(key, _LOOKUP)
    joined = joined.join(entered, F.col(_FOLD_KEY) == F.col(_LOOKUP), "left" if hot else "inner")
    return joined.filter(holds_file(taken, F.col(FILE_COL))).select(*batch.columns)


def later_entries(entered: DataFrame, part: str, before: DataFrame | None = None, key: str = HASH_COL) -> DataFrame:
    """(key, day) pairs that entered from a later file than the key's first.

    ``entered`` has the key, day and file of rows that entered. A layer that
    takes each key once, loaded after every file, never sees these rows: the
    key is there when they come. ``before`` are the keys stored before the
    files; all of their rows count as of the first file. A (key, day) pair
    enters from one file only, so the pair names the rows."""
    rows = entered.select(key, F.col(part).alias(_DAY), FILE_COL).distinct()
    first = rows.groupBy(F.col(key).alias(_LOOKUP)).agg(F.min(FILE_COL).alias("__first"))
    if before is not None:
        known = before.select(F.col(key).alias(_FOLD_KEY)).distinct()
        first = first.join(known, F.col(_LOOKUP) == F.col(_FOLD_KEY), "left")
        first = first.select(_LOOKUP, F.when(F.col(_FOLD_KEY).isNotNull(), 0).otherwise(F.col("__first")).alias("__first"))
    late = rows.join(first, F.col(key) == F.col(_LOOKUP)).filter(F.col(FILE_COL) > F.col("__first"))
    return late.select(F.col(key).alias(_LOOKUP), _DAY)


def without_later(rows: DataFrame, later: DataFrame, part: str, key: str = HASH_COL) -> DataFrame:
    """``rows`` without those of the (key, day) pairs of ``later_entries``."""
    same = (F.col(key) == F.col(_LOOKUP)) & F.col(part).eqNullSafe(F.col(_DAY))
    return rows.join(later, same, "left_anti")


def keys_besides(rows: DataFrame, entered: DataFrame, part: str, key: str = HASH_COL) -> DataFrame:
    """Keys that ``rows`` hold on other (key, day) pairs than ``entered``."""
    pairs = entered.select(F.col(key).alias(_LOOKUP), F.col(part).alias(_DAY)).distinct()
    return without_later(rows.select(key, part), pairs, part, key).select(key)
