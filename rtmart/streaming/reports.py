"""Counts per day and hour, kept up to date by the device job.

The device table says which record of a device-day is the first, so a record
that comes late but lies earlier moves its device-day to another hour. Each
micro-batch therefore compares its firsts with those stored before it and
takes back one from the old hour where they moved. For every day it touches it
writes the day's whole hours as the day's next version and removes those
before the last but one, so a report reads at most two times 24 rows a day,
however many devices the day has. A replayed batch starts from the versions
before it and overwrites its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rtmart.operators.joins import broadcast_if_small
from rtmart.operators.upsert import file_system, latest_per_key, path_exists, read_versions

HOURS = "dt string, batch_id long, hr string, cnt long"
KEPT_VERSIONS = 2


def hour_changes(firsts: DataFrame, before: DataFrame | None) -> DataFrame:
    """(dt, hr, change) of the hour counts when ``firsts`` join the firsts ``before``.

    Both have the columns dt, mid, ts, event_id and hr, one row per device-day.
    A device-day counts in the hour of the smallest (ts, event_id).
    """
    if before is None:
        return firsts.groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("change"))
    old = before.select(F.col("dt").alias("_dt"), F.col("mid").alias("_mid"),
                        F.struct("ts", "event_id").alias("_at"), F.col("hr").alias("_hr"))
    both = firsts.join(old, (F.col("dt") == F.col("_dt")) & (F.col("mid") == F.col("_mid")), "left")
    known, earlier = F.col("_mid").isNotNull(), F.struct("ts", "event_id") < F.col("_at")
    one = lambda hr, n: F.struct(F.col(hr).alias("hr"), F.lit(n).cast("long").alias("change"))
    changes = F.when(~known, F.array(one("hr", 1))).when(
        earlier & (F.col("hr") != F.col("_hr")), F.array(one("hr", 1), one("_hr", -1)))
    return (both.select("dt", F.inline(changes)).groupBy("dt", "hr")
            .agg(F.sum("change").alias("change")).where(F.col("change") != 0))


def _stored_firsts(spark: SparkSession, table_path: str, batch_id: int, firsts: DataFrame,
                   days: list[str]) -> DataFrame | None:
    """The stored first of each device-day of the batch, from the versions before it."""
    if not path_exists(spark, table_path):
        return None
    stored = read_versions(spark, table_path, before=batch_id).withColumn("dt", F.col("dt").cast("string"))
    keys = broadcast_if_small(firsts.select("dt", "mid"), max_bytes=None)
    stored = (stored.where(F.col("dt").isin(days)).select("dt", "mid", "ts", "event_id", "hr")
              .join(keys, ["dt", "mid"], "left_semi"))       # other days' folders are not read
    return latest_per_key(stored, ["dt", "mid"], ["ts", "event_id"], first=True)


def update_hour_counts(firsts: DataFrame, table_path: str, hours_path: str, batch_id: int) -> None:
    """Bring the hour counts up to a batch, before its device-days are written.

    ``firsts``: the batch's first record of each device-day (persisted).
    """
    spark = firsts.sparkSession
    days = [r["dt"] for r in firsts.select("dt").distinct().collect()]      # days, not records
    changes = hour_changes(firsts, _stored_firsts(spark, table_path, batch_id, firsts, days))
    changes = changes.withColumnRenamed("change", "cnt")
    if path_exists(spark, hours_path):
        old = read_hour_counts(spark, hours_path, days, before=batch_id, zeros=True)
        changes = changes.unionByName(old)
    counts = changes.groupBy("dt", "hr").agg(F.sum("cnt").alias("cnt"))
    # at most 24 rows a day; only this batch's folders are overwritten. Days are dealt out
    # by a shuffle: a coalesce would run all aggregates before it in one task, one after
    # another, and hold the memory of each
    (counts.select("hr", "cnt", "dt", F.lit(int(batch_id)).cast("long").alias("batch_id"))
     .hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt", "batch_id").parquet(hours_path))
    _drop_old(spark, hours_path, days)


def _drop_old(spark: SparkSession, hours_path: str, days: list[str]) -> None:
    jvm, _, fs = file_system(spark, hours_path)
    Path = jvm.org.apache.hadoop.fs.Path
    for day in days:
        folder = Path(f"{hours_path.rstrip('/')}/dt={day}")
        if not fs.exists(folder):
            continue
        numbers = sorted(int(st.getPath().getName().split("=", 1)[1]) for st in fs.listStatus(folder)
                         if st.getPath().getName().startswith("batch_id="))
        for n in numbers[:-KEPT_VERSIONS]:
            fs.delete(Path(folder, f"batch_id={n}"), True)


def read_hour_counts(spark: SparkSession, hours_path: str, days: list[str] | None = None,
                     before: int | None = None, zeros: bool = False) -> DataFrame:
    """(dt, hr, cnt), the last version of each day; other days' folders are not read."""
    rows = spark.read.schema(HOURS).option("basePath", hours_path).parquet(hours_path)
    if days is not None:
        rows = rows.where(F.col("dt").isin(days))
    if before is not None:
        rows = rows.where(F.col("batch_id") < F.lit(int(before)))
    last = latest_per_key(rows.select("dt", "hr", "batch_id", "cnt"), ["dt", "hr"], ["batch_id"])
    return (last if zeros else last.where(F.col("cnt") != 0)).select("dt", "hr", "cnt")
