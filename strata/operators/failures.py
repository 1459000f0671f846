"""Values that a cast loses (C5, C7, C8): counted, and kept with their text.

A typed projection turns text that does not parse into NULL. ``failed_cast``
is true where a value was there and its cast is not. All columns of a dataset
are counted by one observed vector in the pass that reads the batch anyway;
``failed_cells`` gives a row for each lost value, for a quarantine table.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import HASH_COL, partition_day
from ..functions.types import cast_to
from .project import _declared
from .spec import DatasetSpec

#: Columns of ``failed_cells`` besides the key.
CELL_COLUMNS = ("column", "value", "wanted")
DAY_TYPE = "yyyy-MM-dd"


def failed_cast(df: DataFrame, spec: DatasetSpec, dialect: str = "lake") -> list[tuple[str, str, Column, Column]]:
    """(column, wanted type, its value, whether the cast loses it) for every
    declared column that its type can lose."""
    out = []
    for col_spec, name in zip(spec.columns, _declared(df, spec), strict=True):
        wanted = col_spec.lake() if dialect == "lake" else col_spec.warehouse()
        if wanted.spark_type == "string":
            continue  # any value has a text
        value = F.col(f"`{name}`")
        out.append((col_spec.name, wanted.text, value, value.isNotNull() & cast_to(value, wanted).isNull()))
    return out


def failed_day(df: DataFrame, part: str) -> list[tuple[str, str, Column, Column]]:
    """The same for the partition column on its way to a day."""
    value = F.col(f"`{part}`")
    kind = df.schema[part].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return []
    return [(part, DAY_TYPE, value, value.isNotNull() & partition_day(part, kind).isNull())]


def observe_failures(df: DataFrame, tests: list[tuple[str, str, Column, Column]], seen: Observation) -> DataFrame:
    """``df``, counting lost values by column as it is read."""
    if not tests:
        return df
    return df.observe(seen, *[F.count_if(t[3]).alias(f"c{i}") for i, t in enumerate(tests)])


def observed_failures(tests: list[tuple[str, str, Column, Column]], seen: Observation) -> dict[str, int]:
    """Columns that lost values, and how many, once the frame has been read."""
    try:
        got = seen.get if tests else {}
    except Py4JJavaError:  # Spark left an empty branch out
        got = {}
    return {t[0]: int(got[f"c{i}"]) for i, t in enumerate(tests) if got.get(f"c{i}")}


def failure_counts(df: DataFrame, tests: list[tuple[str, str, Column, Column]]) -> DataFrame:
    """(column, wanted, failures) of every column tested, in one aggregate."""
    if not tests:
        return df.sparkSession.createDataFrame([], "column string, wanted string, failures bigint")
    counts = df.agg(*[F.count_if(t[3]).alias(f"c{i}") for i, t in enumerate(tests)])
    rows = [
        F.struct(F.lit(t[0]).alias("column"), F.lit(t[1]).alias("wanted"), F.col(f"c{i}").alias("failures"))
        for i, t in enumerate(tests)
    ]
    return counts.select(F.inline(F.array(*rows)))


def failed_cells(df: DataFrame, tests: list[tuple[str, str, Column, Column]], key: str = HASH_COL) -> DataFrame:
    """(key, column, value, wanted): a row for each lost value. Rows without
    one end at the filter; the text of the others is kept whole."""
    kind = df.schema[key].dataType.simpleString()
    if not tests:
        return df.sparkSession.createDataFrame([], f"`{key}` {kind}, column string, value string, wanted string")
    cells = [
        F.when(failed, F.struct(F.lit(name).alias("column"), value.cast("string").alias("value"), F.lit(wanted).alias("wanted")))
        for name, wanted, value, failed in tests
    ]
    lost = F.filter(F.array(*cells), lambda c: c.isNotNull())
    return df.select(F.col(f"`{key}`"), F.explode(lost).alias("c")).select(key, *[F.col(f"c.{n}").alias(n) for n in CELL_COLUMNS])
