"""Cross-site boilerplate lines (operator 3).

A line's spread is the number of distinct sites it stands on. Each line hash
carries a HyperLogLog sketch of its sites that merges through the aggregation;
lines whose estimate is near the threshold get an exact distinct count. Lines
that reach ``min_sites`` are boilerplate and are removed everywhere but at
their first place (lowest id, then position), so no content leaves the corpus.

A line is the text between line breaks without outer spaces and tabs; empty
lines are kept and never counted. Its key is 96 bits of two hashes.

Defined results: a null site counts for no line; a null text has no lines and
stays null, an empty one stays empty; rows that repeat an id and a text are
one document for the first-place rule (all its copies keep the line); rows
with a null id come first in the order and are cleaned like others; an empty
table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import fresh, stage, table

MIN_SITES = 10
#: Sketches of 2^8 registers: standard error about 6.5 %.
LOG_REGISTERS = 8
#: Estimates within this share of the threshold are counted exactly (4 standard errors).
NEAR = 0.26


def keyed(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """Id, text hash (tells apart rows of one id) and the array of lines."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
        F.col(site_col).cast("string").alias("site"),
        F.split(F.col(text_col), "\n").alias("lines"),
    )


def line_rows(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """One row per non-empty line: where it stands and its key, not its text."""
    lines = keyed(docs, id_col, text_col, site_col).select(
        "doc_id", "text_hash", "site", F.posexplode("lines").alias("pos", "line")
    )
    clean = lines.withColumn("line", F.expr("trim(both ' \t\r' from line)")).filter("line <> ''")
    return clean.select("doc_id", "text_hash", "site", "pos", F.xxhash64("line").alias("h1"), F.crc32(F.encode("line", "UTF-8")).alias("h2"))


def boilerplate(lines: DataFrame, min_sites: int) -> DataFrame:
    """Keys of lines on at least ``min_sites`` sites, with the first place."""
    spread = stage(
        lines.groupBy("h1", "h2")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS))).alias("sites"),
            F.min(F.struct("doc_id", "text_hash", "pos")).alias("first"),
        )
        .filter(F.col("sites") >= int(min_sites * (1 - NEAR))),
        "line-spread",
    )
    sure = F.col("sites") > min_sites * (1 + NEAR)
    near = spread.filter(~sure)
    exact = (
        lines.join(near.select("h1", "h2"), ["h1", "h2"])
        .filter("site is not null")
        .select("h1", "h2", "site")
        .distinct()
        .groupBy("h1", "h2")
        .count()
        .filter(F.col("count") >= min_sites)
        .select("h1", "h2")
    )
    return spread.filter(sure).unionByName(near.join(exact, ["h1", "h2"], "left_semi")).drop("sites")


def removed_lines(docs: DataFrame, min_sites: int, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """Per document that loses lines: their positions."""
    lines = line_rows(docs, id_col, text_col, site_col)
    found = stage(boilerplate(lines, min_sites), "line-boilerplate")
    here = F.struct("doc_id", "text_hash", "pos")
    hits = lines.drop("site").join(found, ["h1", "h2"]).filter(~here.eqNullSafe(F.col("first")))
    return hits.select("doc_id", "text_hash", "pos").distinct().groupBy("doc_id", "text_hash").agg(F.collect_list("pos").alias("removed"))


def remove_boilerplate(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    count_col: str = "lines_removed",
) -> DataFrame:
    """``docs`` with cleaned text; a new last column ``count_col`` counts what
    each row lost (a column of that name is replaced)."""
    key, text_hash, removed, lines = fresh(docs, "line_id", "line_hash", "line_removed", "line_list")
    gone = removed_lines(docs, min_sites, id_col, text_col, site_col).select(
        F.col("doc_id").alias(key), F.col("text_hash").alias(text_hash), F.col("removed").alias(removed)
    )
    same = F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(F.col(text_col)) == F.col(text_hash))
    joined = docs.join(gone, same, "left")
    joined = joined.withColumn(lines, F.when(F.col(removed).isNotNull(), F.split(F.col(text_col), "\n")))
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(removed))
    left = F.array_join(F.transform(places, lambda i: F.get(F.col(lines), i)), "\n")
    kept = F.when(F.col(removed).isNull(), F.col(text_col)).otherwise(left)
    others = [F.col(f"`{c}`") if c != text_col else kept.alias(c) for c in docs.columns if c.lower() != count_col.lower()]
    return joined.select(*others, F.coalesce(F.size(removed), F.lit(0)).cast("long").alias(count_col))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    return remove_boilerplate(docs.select("doc_id", "text", "source")).select(
        "doc_id",
        "lines_removed",
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text.cast("binary"), 256).alias("kept_sha256"),
    )


#: The same by exact counts alone.
OP3_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, text, pos, trim(string_split(text, chr(10))[pos], ' ' || chr(9) || chr(13)) AS line
  FROM (SELECT doc_id, source, text, unnest(generate_series(1, len(string_split(text, chr(10))))) AS pos
        FROM documents WHERE text IS NOT NULL)
), spread AS (
  SELECT line, min((doc_id, pos)) AS first FROM lines WHERE line <> ''
  GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}
), marked AS (
  SELECT l.doc_id, l.pos, string_split(l.text, chr(10))[l.pos] AS raw,
         s.line IS NOT NULL AND (l.doc_id, l.pos) <> s.first AS gone
  FROM lines l LEFT JOIN spread s USING (line)
), kept AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS lines_removed,
         coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(k.lines_removed, 0) AS lines_removed,
       strlen(coalesce(k.text, '')) AS n_bytes, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
