"""Column-name cleaning.

One rule table drives two forms of the same cleaning:

* ``clean_column_name(str) -> str`` runs on the driver over ``df.columns``
  (a list of names, never rows) and feeds a single ``toDF`` rename;
* ``clean_name_expr(Column) -> Column`` is the same rule chain built from
  JVM-side string functions, for cleaning names that live in data (for
  example the ``columnname`` column of the technical metadata, or header
  text that has to be normalised across a whole table).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The cleaning rules, applied in this order. Each entry is
# (kind, pattern, replacement); "lower" and "strip" take no arguments,
# "regex" uses a regular expression, "text" replaces a literal substring.
# The bracket rule empties whatever sits between "[" and "]" (at least one
# character); the brackets themselves are deleted by the later text rules.
NAME_RULES: tuple[tuple[str, str, str], ...] = (
    ("lower", "", ""),
    ("text", "%", "percent"),
    ("regex", r"\[[^\]]+\]", "[]"),
    ("strip", "", ""),
    ("text", "]", ""),
    ("text", "[", ""),
    ("text", "(", ""),
    ("text", ";", ""),
    ("text", ")", ""),
    ("text", " ", "_"),
    ("text", ",", ""),
    ("text", "/", "_"),
    ("text", ":", "_"),
)


def clean_column_name(name: str) -> str:
    """Clean one raw header name."""
    out = name
    for kind, pattern, repl in NAME_RULES:
        if kind == "lower":
            out = out.lower()
        elif kind == "strip":
            out = out.strip()
        elif kind == "regex":
            out = re.sub(pattern, repl, out)
        else:
            out = out.replace(pattern, repl)
    return out


def clean_name_expr(col: Column | str) -> Column:
    """The same rule chain as a Column expression (stays in codegen)."""
    out = F.col(col) if isinstance(col, str) else col
    for kind, pattern, repl in NAME_RULES:
        if kind == "lower":
            out = F.lower(out)
        elif kind == "strip":
            out = F.regexp_replace(out, r"^\s+|\s+$", "")
        elif kind == "regex":
            out = F.regexp_replace(out, pattern, repl)
        else:
            out = F.replace(out, F.lit(pattern), F.lit(repl))
    return out


def cleaned_names(columns: list[str]) -> list[str]:
    """Map raw names to cleaned names; raise when two collide."""
    names = [clean_column_name(c) for c in columns]
    seen: dict[str, str] = {}
    for raw, new in zip(columns, names):
        key = new.lower()  # Spark resolves names case-insensitively
        if key in seen:
            raise ValueError(
                f"column names {seen[key]!r} and {raw!r} both clean to {new!r}"
            )
        if not new:
            raise ValueError(f"column name {raw!r} cleans to an empty name")
        seen[key] = raw
    return names


def clean_columns(df: DataFrame) -> DataFrame:
    """Rename every column by C1 in one projection."""
    names = cleaned_names(df.columns)
    if names == df.columns:
        return df
    return df.toDF(*names)
