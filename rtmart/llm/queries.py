"""Named queries of the training-data operators, and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rtmart.llm.audit import op12_filter_interaction_audit
from rtmart.llm.embeddings import op4_embedding_near_dedup
from rtmart.llm.langid import op10_language_id
from rtmart.llm.licenses import op9_license_scans
from rtmart.llm.lines import op2_line_dedup
from rtmart.llm.mixing import op8_mixing
from rtmart.llm.oracle import ORACLES
from rtmart.llm.packing import op7_packing
from rtmart.llm.quality import op3_quality_rules
from rtmart.llm.secrets import op5_secret_scans
from rtmart.llm.simhash import op6_simhash_near_dedup
from rtmart.llm.toxicity import op11_toxicity
from rtmart.llm.urls import op1_url_filters
from rtmart.llm.vectors import op13_vector_code_compression

QUERIES = [op1_url_filters, op2_line_dedup, op3_quality_rules, op4_embedding_near_dedup,
           op5_secret_scans, op6_simhash_near_dedup, op7_packing, op8_mixing,
           op9_license_scans, op10_language_id, op11_toxicity,
           op12_filter_interaction_audit, op13_vector_code_compression]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
