"""Stages on tables whose columns have the names that stages would use."""

import corpus_pipeline
from pyspark.sql import functions as F
from strata.llm import decontaminate, minhash

NAMES = ["line_id", "line_hash", "line_removed", "line_list", "kept_id", "kept_hash", "kept_group", "hit_id", "hit_hash", "lines_removed", "__id", "__hash", "_line_id"]


def test_stages_keep_columns_of_any_name(spark):
    rows = [(i, "Common line of all the sites.\nown words of number " + " ".join(f"w{i}x{j}" for j in range(30)), f"s{i}") for i in range(12)]
    rows += [(12, rows[3][1], "s3"), (13, None, None), (14, "Common line of all the sites.", "s4")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({n: F.lit(7) for n in NAMES})
    cleaned = corpus_pipeline.line_dedup(spark, docs, "").cache()
    kept = minhash.drop_near_duplicates(cleaned)
    items = spark.createDataFrame([(1, " ".join(f"w5x{j}" for j in range(20)))], "item_id long, text string")
    left = decontaminate.drop_contaminated(kept, items)
    assert left.columns == kept.columns == cleaned.columns == docs.columns
    got = sorted(left.collect())
    assert [r.doc_id for r in got] == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10, 11, 13]
    assert all(r[n] == 7 for r in got for n in NAMES)
    assert got[0].text.startswith("Common") and got[1].text.startswith("own words")
