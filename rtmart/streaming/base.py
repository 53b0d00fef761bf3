"""What the streaming jobs share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MICRO_BATCH = "5 seconds"   # the reference's batch interval


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def trigger(writer, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=MICRO_BATCH)
