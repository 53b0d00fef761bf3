"""File sinks (K1/K2 file form, K5, K6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rtmart.functions import millis_to_day

PREVIEW_ROWS = 1000   # the reference printed up to 1000 rows per batch


def write_topics(df: DataFrame, path: str, mode: str = "append") -> None:
    """K1/K2: one folder per topic; rows keep ``key`` (if any) and ``value``.

    ``rebalance`` clusters rows by topic before the write (few files per
    topic) while AQE splits a topic that holds most of the rows.
    """
    cols = [c for c in ("topic", "key", "value") if c in df.columns]
    (df.select(*cols).hint("rebalance", "topic")
       .write.mode(mode).partitionBy("topic").parquet(path))


def archive_log_lines(raw: DataFrame, path: str, value_col: str = "value",
                      mode: str = "append") -> None:
    """K6: the raw text of every log line, one folder per event day ``dt``."""
    dt = millis_to_day(F.get_json_object(F.col(value_col), "$.ts").try_cast("bigint"))
    (raw.select(F.coalesce(dt, F.lit("unknown")).alias("dt"), F.col(value_col).alias("value"))
        .hint("rebalance", "dt")      # per-day files; a hot day is split by AQE
        .write.mode(mode).partitionBy("dt").text(path))


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> None:
    """K5: print up to ``n`` rows (a debugging aid, not a data path)."""
    df.show(n, truncate=False)
