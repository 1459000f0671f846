"""The subpackage's checked queries, one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm.ann import op4_nearest
from strata.llm.crosstoken import op11_token_alignment
from strata.llm.decontaminate import op1_decontamination
from strata.llm.htmltext import op12_html_text
from strata.llm.langid import op2_language_id
from strata.llm.licenses import op6_license_scan
from strata.llm.linededup import OP3_SQL, op3_line_dedup
from strata.llm.minhash import op9_near_duplicates
from strata.llm.packing import op10_packing
from strata.llm.pfor import op5_token_files
from strata.llm.quality import op7_quality
from strata.llm.suffix import op8_repeats
from strata.llm.whitening import op13_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_language_id": op2_language_id,
    "op3_line_dedup": op3_line_dedup,
    "op4_nearest": op4_nearest,
    "op5_token_files": op5_token_files,
    "op6_license_scan": op6_license_scan,
    "op7_quality": op7_quality,
    "op8_repeats": op8_repeats,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_packing": op10_packing,
    "op11_token_alignment": op11_token_alignment,
    "op12_html_text": op12_html_text,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL: dict[str, str] = {"op3_line_dedup": OP3_SQL}
