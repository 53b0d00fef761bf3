"""Cutting lineage through the shared folder.

A plan consumed by several branches (or expensive to recompute after a lost
executor) is written once as parquet under ``spark.checkpoint.dir`` and read
back. Unlike ``DataFrame.checkpoint()`` this computes the plan once (the RDD
checkpoint recomputes it for the write), and the result keeps parquet
statistics for pruning; unlike ``localCheckpoint`` it survives executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from rtmart.session import shared_path


def write_and_read(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    w = df.write.mode("overwrite")
    (w.option("compression", compression) if compression else w).parquet(path)
    return df.sparkSession.read.parquet(path)


def cut_lineage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Materialise ``df`` in a fresh folder below the shared checkpoint dir."""
    return write_and_read(df, shared_path(df.sparkSession, name), compression)


def cut_small(df: DataFrame, name: str) -> DataFrame:
    """``cut_lineage`` for rows that are many: stored with zstd."""
    return write_and_read(df, shared_path(df.sparkSession, name), "zstd")
