"""Parquet table reads (S6/S7). Column pruning and filter pushdown happen in the
scan because callers select/filter lazily on the returned DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query_list(spark: SparkSession, sql: str) -> DataFrame:
    """S6 + P16: run a SQL query and return each row as a JSON object keyed by
    column name (column ``value``). Catalyst plans the SQL like any
    DataFrame: projections and filters reach the scan."""
    rows = spark.sql(sql)
    return rows.select(F.to_json(F.struct(*[F.col(c) for c in rows.columns])).alias("value"))
