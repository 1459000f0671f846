"""A training-corpus pipeline over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet in the shared folder and read again as the next stage's
``docs``. All but the last return the columns of ``documents``. Stages that hand
texts to Python workers bound the session's Arrow batches (``bound_batches``).

1. ``language_id`` drops documents without a letter and those in which no
   language holds ``MIN_LANGUAGE_SCORE`` of the letters.
2. ``line_dedup`` removes lines that stand on many sites, all but the first of
   each, and drops documents of which nothing is left.
3. ``near_dedup`` keeps the smallest id of every group of near-duplicates.
4. ``decontamination`` drops documents that hold a benchmark item.
5. ``packing`` packs what is left into sequences: a row per piece.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, langid, linededup, minhash, packing
from strata.llm.common import bound_batches, fresh, held_out, scratch_path, table

MIN_LANGUAGE_SCORE = 0.4
SEQUENCE_LENGTH = 2048
END_ID = 0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    model = langid.fit(docs, F.col("lang"), ~held_out(F.col("doc_id")))
    return langid.drop_unidentified(docs, model, MIN_LANGUAGE_SCORE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    (lost,) = fresh(docs, "lines_removed")
    cleaned = linededup.remove_boilerplate(docs, count_col=lost)
    emptied = (F.col(lost) > 0) & (F.trim("text") == "")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if "n_chars" in docs.columns:
        size = F.when(F.col(lost) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        columns = [size.alias("n_chars") if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return cleaned.filter(~F.coalesce(emptied, F.lit(False))).select(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return minhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return packing.pack_documents(docs, SEQUENCE_LENGTH, END_ID)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Models, signatures and tokenizers are not SQL: tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
