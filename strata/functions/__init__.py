"""Column-level functions: name cleaning, row keys, partition day, casts."""

from .keys import (
    AUDIT_COLS,
    DAY_FORMAT,
    HASH_COL,
    INSERT_COL,
    KEY_SEPARATOR,
    UPDATE_COL,
    load_time_literal,
    partition_day,
    row_hash,
    with_audit_columns,
    with_partition_day,
    with_row_hash,
)
from .names import NAME_RULES, clean_column_name, clean_columns, clean_name_expr, cleaned_names
from .types import TypeSpec, cast_to, parse_type

__all__ = [
    "AUDIT_COLS",
    "DAY_FORMAT",
    "HASH_COL",
    "INSERT_COL",
    "KEY_SEPARATOR",
    "NAME_RULES",
    "TypeSpec",
    "UPDATE_COL",
    "cast_to",
    "clean_column_name",
    "clean_columns",
    "clean_name_expr",
    "cleaned_names",
    "load_time_literal",
    "parse_type",
    "partition_day",
    "row_hash",
    "with_audit_columns",
    "with_partition_day",
    "with_row_hash",
]
