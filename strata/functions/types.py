"""Metadata type text -> Spark casts (used by C7, C8, C10).

The technical metadata holds type names as free text. Lake types (``delta``)
are Spark SQL types. Warehouse types (``sql``) are the warehouse dialect:
``varchar(n)`` and ``char(n)`` truncate to ``n`` characters on cast (Spark's
own cast to varchar does not), ``float`` is 8 bytes, ``bit`` is boolean and
so on. Every cast is a ``try_cast``: a value that does not convert becomes
NULL rather than failing the load under ANSI mode.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Warehouse type names that mean something else (or nothing)
# in Spark SQL, mapped to the Spark type text with the warehouse meaning.
WAREHOUSE_TYPE_ALIASES: dict[str, str] = {
    "float": "double",
    "real": "float",
    "bit": "boolean",
    "tinyint": "smallint",
    "datetime": "timestamp",
    "datetime2": "timestamp",
    "smalldatetime": "timestamp",
    "datetimeoffset": "timestamp",
    "money": "decimal(19,4)",
    "smallmoney": "decimal(10,4)",
    "numeric": "decimal(18,0)",
    "decimal": "decimal(18,0)",
    "text": "string",
    "ntext": "string",
    "uniqueidentifier": "string",
}

_LENGTH_TYPE = re.compile(r"^\s*(n?)(var)?char\s*\(\s*(\d+|max)\s*\)\s*$", re.I)


@dataclass(frozen=True)
class TypeSpec:
    """A parsed metadata type: the Spark cast target plus string length rules."""

    text: str
    spark_type: str  # Spark SQL type text, resolved by the analyzer
    max_length: int | None = None  # truncate strings to this many characters
    pad: bool = False  # char(n): pad with blanks to n

    @property
    def ddl(self) -> str:
        """Type text for a Spark CREATE TABLE."""
        if self.max_length is not None:
            return f"{'char' if self.pad else 'varchar'}({self.max_length})"
        return self.spark_type


def parse_type(text: str, dialect: str = "lake") -> TypeSpec:
    """Parse a type text of the ``delta`` (lake) or ``sql`` (warehouse) column."""
    if text is None or not str(text).strip():
        raise ValueError("empty type text in the technical metadata")
    raw = str(text).strip()
    m = _LENGTH_TYPE.match(raw)
    if m:
        n = m.group(3)
        if n.lower() == "max":
            return TypeSpec(raw, "string")
        if dialect == "sql":
            return TypeSpec(raw, "string", int(n), pad=m.group(2) is None)
        # Spark lake tables keep varchar/char as plain strings.
        return TypeSpec(raw, "string")
    key = raw.lower()
    if dialect == "sql":
        key = WAREHOUSE_TYPE_ALIASES.get(key, key)
    if ":" in key or "<" in key:
        raise ValueError(f"type {raw!r}: nested types cannot be cast from text")
    return TypeSpec(raw, key)


def cast_to(col: Column | str, spec: TypeSpec) -> Column:
    """``try_cast`` to the spec, with warehouse string-length semantics."""
    c = F.col(col) if isinstance(col, str) else col
    if spec.max_length is not None:
        out = F.left(c.cast(StringType()), F.lit(spec.max_length))
        if spec.pad:
            out = F.rpad(out, spec.max_length, " ")
        return out
    return c.try_cast(spec.spark_type)
