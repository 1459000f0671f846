"""Row hash key, audit columns and partition-day normalisation."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the audit columns, the key separator and the
# partition-day format.
HASH_COL = "calhashkey"
INSERT_COL = "calinsertdate"
UPDATE_COL = "calupdatedate"
AUDIT_COLS = (HASH_COL, INSERT_COL, UPDATE_COL)
KEY_SEPARATOR = "||"
DAY_FORMAT = "yyyy-MM-dd"


def row_hash(cols: list[str]) -> Column:
    """upper(sha2(concat_ws('||', cols...), 256)).

    ``concat_ws`` skips NULLs and is never NULL itself, so the key is never
    NULL: ``(a, NULL, b)`` and ``(a, b, NULL)`` share a key (kept on purpose).
    """
    if not cols:
        raise ValueError("no hash-key column is flagged for this dataset")
    parts = [F.col(c).cast("string") for c in cols]
    return F.upper(F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256))


def with_row_hash(df: DataFrame, cols: list[str], name: str = HASH_COL) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"hash-key columns not in the data: {missing}")
    return df.withColumn(name, row_hash(cols))


def load_time_literal(load_ts: _dt.datetime | str | None) -> Column:
    """The load time as a timestamp Column (``current_timestamp`` when None)."""
    if load_ts is None:
        return F.current_timestamp()
    if isinstance(load_ts, str):
        return F.lit(load_ts).cast(T.TimestampType())
    return F.lit(load_ts).cast(T.TimestampType())


def with_audit_columns(df: DataFrame, load_ts=None) -> DataFrame:
    """calinsertdate = load time, calupdatedate = NULL timestamp (C4)."""
    return df.withColumns(
        {
            INSERT_COL: load_time_literal(load_ts),
            UPDATE_COL: F.lit(None).cast(T.TimestampType()),
        }
    )


def partition_day(col: Column | str, dtype: T.DataType | None = None) -> Column:
    """Normalise a partition value to a ``yyyy-MM-dd`` string.

    Text that does not parse as a timestamp becomes NULL instead of failing
    the load (``try_cast``), whatever the ANSI setting.
    """
    c = F.col(col) if isinstance(col, str) else col
    if not isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        c = c.try_cast(T.TimestampType())
    return F.date_format(c, DAY_FORMAT)


def with_partition_day(df: DataFrame, col: str) -> DataFrame:
    if col not in df.columns:
        raise ValueError(f"partition column {col!r} not in the data")
    return df.withColumn(col, partition_day(col, df.schema[col].dataType))
