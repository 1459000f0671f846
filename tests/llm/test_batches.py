"""The pipeline's stages bound the Arrow batches that hold texts."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm.common import BATCH_BYTES, bound_batches

BOUND = 4_000_000


@pytest.fixture()
def unset(spark):
    spark.conf.unset(BATCH_BYTES)
    yield
    spark.conf.unset(BATCH_BYTES)


def largest_batch(spark):
    """Bytes of the largest batch of 9 MB of texts in one partition."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64()), "size": pa.array([b.nbytes], pa.int64())})

    texts = spark.range(0, 3000, 1, 1).select("id", F.repeat(F.lit("some text "), 300).alias("text"))
    got = texts.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 3000
    return max(r.size for r in got)


@pytest.mark.parametrize("name", ["language_id", "near_dedup", "decontamination", "packing"])
def test_stages_bound_batches(spark, unset, tmp_path, name):
    assert largest_batch(spark) > 2 * BOUND
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(1, "some words of a text", "en", "s1", 20), (2, None, None, None, None)], schema)
    spark.createDataFrame([(1, "other words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path))
    assert largest_batch(spark) <= BOUND + 10_000  # and one row


def test_a_limit_of_the_session_stays(spark, unset):
    spark.conf.set(BATCH_BYTES, "1m")
    bound_batches(spark)
    assert spark.conf.get(BATCH_BYTES) == "1m"
