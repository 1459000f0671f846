"""Names derived from business metadata (C13), for a row and for a column alike.

Every rule is a sequence of parts. Given texts it makes a text, given columns
a Column, so what routing shows is what the loads create.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _joined(*parts: str | Column) -> str | Column:
    if any(isinstance(p, Column) for p in parts):
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return "".join(parts)


def layer_subpath(root, database, schema, table):
    return _joined(root, "/", database, "/", schema, "/", table)


def catalog_table(sql_schema, sql_table):
    return _joined(sql_schema, "_", sql_table)


def warehouse_db(sql_database, sql_schema):
    """One catalog database per warehouse database and schema."""
    return _joined(sql_database, "__", sql_schema)


def warehouse_table(sql_database, sql_schema, sql_table):
    return _joined(warehouse_db(sql_database, sql_schema), ".", sql_table)


def staging_db(sql_database, sql_schema):
    return _joined("staging_", warehouse_db(sql_database, sql_schema))
