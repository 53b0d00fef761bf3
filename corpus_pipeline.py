"""The corpus pipeline: each stage calls one operator of ``rtmart.llm``.

A stage takes (spark, docs, sf_dir); its result is written as Parquet and
reread as the next stage's docs. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rtmart.llm.lines import without_boilerplate
from rtmart.llm.mixing import mixed_documents
from rtmart.llm.packing import pack
from rtmart.llm.quality import keep_good
from rtmart.llm.simhash import one_of_each_group
from rtmart.llm.text import documents
from rtmart.operators.lineage import cut_lineage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines frequent in a host go from the texts, and documents that the rules reject go."""
    return keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cross-site boilerplate lines go from the texts."""
    return without_boilerplate(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return one_of_each_group(docs, shingle=3, radius=3)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their targets; rows are drawn pieces of documents."""
    return mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in length buckets and token-budget batches."""
    return pack(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", simhash_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Fingerprint components and pseudorandom draws are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
