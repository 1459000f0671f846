"""Dataset routing: files x business metadata.

A file belongs to every dataset whose trimmed, lower-cased name occurs in the
file's name (a ``LIKE '%dataset%'`` test, so ``_`` and ``%`` in a dataset
name act as wildcards). As a theta join every file would be compared with
every name. Instead an inverted index finds the candidates: a name that
matches a file has all of its literal trigrams in it, so the files are joined
by equality on the one trigram of the name that the fewest files have, and
``LIKE`` judges the pairs that meet. A trigram that no file has ends its name
there.

Names without three literal letters in a row (and those with a backslash,
which ``LIKE`` reads as an escape) keep the nested loop, with its size-checked
broadcast (``operators.broadcast``): above the limit they are split into hash
chunks that each fit, and the chunk joins are unioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import targets
from .broadcast import MAX_BROADCAST_ROWS, broadcast_join

# Business metadata columns, in the order routed rows carry them.
BUSINESS_COLUMNS = (
    "dataset",
    "deltaLake_root",
    "delta_database_name",
    "delta_schema_name",
    "deltaLake_table_name",
    "sql_database_name",
    "sql_schema_name",
    "sql_table_name",
    "sql_view_name",
    "raw_layer",
    "conformed_layer",
    "enrich_layer",
    "sandbox_layer",
    "edw_layer",
)
LAYER_FLAGS = ("raw_layer", "conformed_layer", "enrich_layer", "sandbox_layer", "edw_layer")


def match_condition(file_name: Column, dataset: Column) -> Column:
    """``lower(name) LIKE '%' || lower(trim(dataset)) || '%'``."""
    pattern = F.concat(F.lit("%"), F.lower(F.trim(dataset)), F.lit("%"))
    return F.like(F.lower(file_name), pattern)


def _trigrams(text: Column) -> Column:
    """Distinct runs of three characters; none of a shorter text."""
    places = F.sequence(F.lit(1), F.length(text) - 2)
    found = F.array_distinct(F.transform(places, lambda i: F.substring(text, i, 3)))
    return F.when(F.length(text) >= 3, found).otherwise(F.array().cast("array<string>"))


def _literal_trigrams(pattern: Column) -> Column:
    """Trigrams that a text must have to be LIKE ``%pattern%``."""
    parts = F.split(pattern, "[%_]+")
    return F.array_distinct(F.flatten(F.transform(parts, _trigrams)))


def indexed_pairs(files: DataFrame, names: DataFrame) -> DataFrame:
    """``files`` with the ``pattern`` of every name in ``names`` (distinct
    ``pattern`` with its literal ``grams``) that they are LIKE."""
    grams = files.withColumn("gram", F.explode(_trigrams(F.lower("d_name"))))
    held = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("held"))
    wanted = names.select("pattern", F.explode("grams").alias("gram"))
    # Trigrams of names only meet the files' counts: the few rows decide.
    rarest = wanted.join(held, "gram", "left").groupBy("pattern").agg(
        F.min_by("gram", F.struct(F.coalesce("held", F.lit(0)), "gram")).alias("gram"),
        F.min(F.coalesce("held", F.lit(0))).alias("held"),
    )
    rarest = rarest.filter(F.col("held") > 0).drop("held")
    met = grams.join(rarest, "gram").drop("gram")
    return met.filter(F.like(F.lower("d_name"), F.concat(F.lit("%"), F.col("pattern"), F.lit("%"))))


def route(files: DataFrame, business: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Routed rows: (path, name, business columns..., derived names), distinct.

    ``files`` needs ``path``, ``name`` and ``d_name`` (``name`` with ``__``
    replaced by ``_``).
    """
    files = files.select("path", "name", "d_name").distinct()
    meta = business.select(*[F.col(c) for c in BUSINESS_COLUMNS])
    pattern = F.lower(F.trim("dataset"))
    named = meta.withColumn("pattern", pattern).filter(F.col("pattern").isNotNull())
    grams = F.when(F.contains("pattern", F.lit("\\")), F.array().cast("array<string>")).otherwise(_literal_trigrams(F.col("pattern")))
    named = named.withColumn("grams", grams)
    long = named.filter(F.size("grams") > 0)
    pairs = indexed_pairs(files, long.select("pattern", "grams").distinct())
    joined = pairs.join(long.drop("grams"), "pattern").select("path", "name", *BUSINESS_COLUMNS)
    short = named.filter(F.size("grams") == 0).select(*BUSINESS_COLUMNS)
    if not short.isEmpty():
        looped = broadcast_join(files, short, match_condition(F.col("d_name"), F.col("dataset")), limit=limit)
        joined = joined.unionByName(looped.select("path", "name", *BUSINESS_COLUMNS))
    return with_target_names(joined.distinct())


def with_target_names(routed: DataFrame) -> DataFrame:
    """Derived target names."""
    sql = F.col("sql_database_name"), F.col("sql_schema_name"), F.col("sql_table_name")
    lake = [F.col(c) for c in ("deltaLake_root", "delta_database_name", "delta_schema_name", "deltaLake_table_name")]
    return routed.withColumns(
        {
            "layer_subpath": targets.layer_subpath(*lake),
            "catalog_table": targets.catalog_table(*sql[1:]),
            "warehouse_table": targets.warehouse_table(*sql),
            "staging_schema": targets.staging_db(*sql[:2]),
        }
    )
