"""Which state of its source each layer has taken, in table properties.

Every append to a layer gives it a new version, set before the files are
written, with the version it had and a digest of the days of the load. A
target that has come through a load records the version of its source. A load
may be cut to its own days only when all the rest is known to be taken: the
target holds the source's present version, or the one before and the days are
those of the last append. A missing record (a layer adopted by a new session)
or an append that did not end never counts as taken.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import SparkSession

from .catalog import qualified, table_exists

_VERSION, _BEFORE, _DAYS, _OPEN, _TAKEN = (f"strata.{x}" for x in ("version", "before", "days", "open", "taken"))


def get_properties(spark: SparkSession, db: str, table: str) -> dict[str, str]:
    if not table_exists(spark, db, table):
        return {}
    return {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {qualified(db, table)}").collect()}


def set_properties(spark: SparkSession, db: str, table: str, values: dict[str, str]) -> None:
    body = ", ".join(f"'{k}' = '{v}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {qualified(db, table)} SET TBLPROPERTIES ({body})")


def _digest(days: list | None) -> str:
    if days is None:
        return ""
    return hashlib.sha256(repr(sorted(set(days), key=repr)).encode()).hexdigest()


def append_unfinished(spark: SparkSession, db: str, table: str) -> bool:
    """Whether files may be there that the catalog does not show: an append
    died, or nothing is known of the last one."""
    return get_properties(spark, db, table).get(_OPEN) != "N"


def begin_append(spark: SparkSession, db: str, table: str, days: list | None) -> None:
    """Before files are written: a new version. ``days`` are those the load was
    given, which its targets are handed too."""
    have = get_properties(spark, db, table)
    before = have.get(_VERSION, "") if have.get(_OPEN) == "N" else ""
    set_properties(spark, db, table, {_VERSION: uuid.uuid4().hex, _BEFORE: before, _DAYS: _digest(days), _OPEN: "Y"})


def end_append(spark: SparkSession, db: str, table: str) -> None:
    """Files are written and recorded. A layer without a version (just created)
    gets its first."""
    have = get_properties(spark, db, table)
    set_properties(spark, db, table, {_OPEN: "N"} | ({} if _VERSION in have else {_VERSION: uuid.uuid4().hex, _BEFORE: "", _DAYS: ""}))


def source_version(spark: SparkSession, db: str, table: str) -> str:
    """The version a target reads now; empty when it cannot be told. Taken
    before the read, so a later append is never recorded as taken."""
    have = get_properties(spark, db, table)
    return have.get(_VERSION, "") if have.get(_OPEN) == "N" else ""


def rest_taken(spark: SparkSession, source: tuple[str, str], target: tuple[str, str], days: list) -> bool:
    """Whether ``target`` has taken all of ``source`` but these days."""
    have, taken = get_properties(spark, *source), get_properties(spark, *target).get(_TAKEN)
    if not taken or have.get(_OPEN) != "N":
        return False
    return taken == have.get(_VERSION) or (taken == have.get(_BEFORE) and _digest(days) == have.get(_DAYS))


def set_taken(spark: SparkSession, target: tuple[str, str], version: str) -> None:
    set_properties(spark, *target, {_TAKEN: version})
