"""Metadata-driven typed projections.

One ``select``: declared columns first, in ``colseq`` order, each cast to its
declared type; then every undeclared column of the input, unchanged and in
the input's own order. Everything is a built-in expression, so the whole
projection stays inside one whole-stage-codegen span and column pruning
reaches the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.types import cast_to
from .spec import DatasetSpec


def _declared(df: DataFrame, spec: DatasetSpec) -> list[str]:
    lower = {c.lower(): c for c in df.columns}
    missing = [n for n in spec.names if n.lower() not in lower]
    if missing:
        raise ValueError(
            f"dataset {spec.dataset!r}: declared columns missing from the data: {missing}"
        )
    return [lower[n.lower()] for n in spec.names]


def typed_columns(df: DataFrame, spec: DatasetSpec, dialect: str = "lake") -> list[Column]:
    """The select list of a typed projection (C7 for lake, C8 for warehouse)."""
    actual = _declared(df, spec)
    out: list[Column] = []
    for col_spec, name in zip(spec.columns, actual):
        ts = col_spec.lake() if dialect == "lake" else col_spec.warehouse()
        out.append(cast_to(F.col(name), ts).alias(col_spec.name))
    declared = {n.lower() for n in spec.names}
    # Undeclared columns pass through, in the input's order.
    out.extend(F.col(c) for c in df.columns if c.lower() not in declared)
    return out


def typed_projection(df: DataFrame, spec: DatasetSpec, dialect: str = "lake") -> DataFrame:
    return df.select(*typed_columns(df, spec, dialect))
