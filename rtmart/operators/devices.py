"""Distinct devices over days, from bitmaps.

Each device gets a dense number from a dictionary that only grows. A day's
devices are then a bitmap of 4 KB pieces, one piece for each 32,768 numbers,
and the distinct devices of any range of days are the bits of the pieces
or-ed together: neither logs nor device-days are read again, and a repeated
day changes nothing.

Numbers are given without one task that sees all devices: new devices are
dealt to BUCKETS by hash, a bucket's offset is the size of those before it
(BUCKETS counts on the driver), and a device's place within its bucket is a
window over the bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rtmart.operators.lineage import cut_lineage
from rtmart.operators.upsert import path_exists, read_versions, write_version

BUCKETS = 1024


def numbered(devices: DataFrame, known: DataFrame | None, buckets: int = BUCKETS) -> DataFrame:
    """(mid, number) of the devices that ``known`` (mid, number) does not hold, counted on from it."""
    new = devices.where(F.col("mid").isNotNull()).select("mid").distinct()
    first = 0
    if known is not None:
        new = new.join(known, "mid", "left_anti")
        first = (known.agg(F.max("number")).first()[0] or 0) + 1
    new = cut_lineage(new.withColumn("bucket", F.pmod(F.xxhash64("mid"), F.lit(buckets)).cast("int")),
                      "new-devices")
    sizes = {r["bucket"]: r["n"] for r in
             new.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}     # BUCKETS rows
    offsets = []
    for b in range(buckets):
        offsets.append(first)
        first += sizes.get(b, 0)
    start = F.get(F.array(*[F.lit(x).cast("long") for x in offsets]), F.col("bucket"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("mid"))
    return new.select("mid", (start + place - 1).alias("number"))


def extend_dictionary(spark: SparkSession, path: str, devices: DataFrame, version: int,
                      buckets: int = BUCKETS) -> DataFrame:
    """Give new devices their numbers, as version ``version``; the whole dictionary.

    Numbers count on from the versions before ``version``, so a replay gives
    the same ones.
    """
    known = None
    if path_exists(spark, path):
        known = read_versions(spark, path, "mid string, number long", before=version).select("mid", "number")
    write_version(numbered(devices, known, buckets), path, version)
    return read_versions(spark, path).where(F.col("batch_id") <= version).select("mid", "number")


def day_bitmaps(dau: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(dt, piece, devices): the bitmap of each day's devices (rows may repeat a device-day)."""
    rows = dau.select("dt", "mid").join(dictionary, "mid")
    return rows.groupBy("dt", F.bitmap_bucket_number("number").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("devices"))


def merged(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """Pieces of several days or versions, or-ed together per ``by`` and piece."""
    return bitmaps.groupBy(*by, "piece").agg(F.bitmap_or_agg("devices").alias("devices"))


def devices_between(bitmaps: DataFrame, first: str, last: str) -> DataFrame:
    """One row: distinct devices of the days ``first`` .. ``last``."""
    days = bitmaps.where(F.col("dt").between(F.lit(first), F.lit(last)))
    return merged(days, []).agg(F.coalesce(F.sum(F.bitmap_count("devices")), F.lit(0)).alias("devices"))


def trailing_devices(bitmaps: DataFrame, days: int = 7) -> DataFrame:
    """(dt, devices): distinct devices of the ``days`` days that end with each active day."""
    until = F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda k: F.date_format(
        F.date_add(F.to_date("dt"), k), "yyyy-MM-dd"))
    spread = bitmaps.select(F.explode(until).alias("dt"), "piece", "devices")
    totals = merged(spread, ["dt"]).groupBy("dt").agg(F.sum(F.bitmap_count("devices")).alias("devices"))
    return totals.join(bitmaps.select("dt").distinct(), "dt", "left_semi")


def new_devices(bitmaps: DataFrame) -> DataFrame:
    """(dt, new_mid): devices whose first active day is ``dt``, by the growth of the running or.

    A piece's days (4 KB each) run through one window; the pieces are what
    spreads the work.
    """
    so_far = Window.partitionBy("piece").orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    days = merged(bitmaps, ["dt"])
    known = days.select("dt", "piece", F.bitmap_count(F.bitmap_or_agg("devices").over(so_far)).alias("n"))
    before = F.lag("n", 1, 0).over(Window.partitionBy("piece").orderBy("dt"))
    grown = known.select("dt", (F.col("n") - before).alias("new_mid"))
    return grown.groupBy("dt").agg(F.sum("new_mid").alias("new_mid"))


def device_report(bitmaps: DataFrame, days: int = 7) -> DataFrame:
    """(dt, devices, trailing, new_mid) of each active day, from bitmaps alone."""
    own = merged(bitmaps, ["dt"]).groupBy("dt").agg(F.sum(F.bitmap_count("devices")).alias("devices"))
    return (own.join(trailing_devices(bitmaps, days).withColumnRenamed("devices", "trailing"), "dt")
            .join(new_devices(bitmaps), "dt"))
