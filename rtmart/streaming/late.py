"""Late rows split off before the stateful operators.

A stateful operator drops what comes later than its watermark. ``start_split``
puts a stateless job in front of it: each micro-batch is cut at the largest
event time of all batches before it, less the allowed delay. Rows at or after
this bound go to the on-time topic, which the stateful job reads and of which
its watermark never drops a row; earlier ones go to the late topic, which a
scheduled pass works off. Nothing is only counted.

The bound of a batch is stored beside the topics before its rows are written,
and a version of a topic that is complete is not written again, so a replayed
batch is cut and named as before. Both topics have a folder for each span of
event time (an hour unless said otherwise), so a pass over late rows reads the
spans they touch only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rtmart.functions import parse_typed
from rtmart.operators import wide as W
from rtmart.operators.asof import last_pin, newest_version, pinned, read_pin
from rtmart.operators.upsert import path_exists, read_versions, write_version, write_version_once
from rtmart.schemas import DWD_ORDER_INFO_FIELDS, ORDER_DETAIL_FIELDS, ORDER_WIDE_COLUMNS
from rtmart.session import setting
from rtmart.streaming.base import trigger

ON_TIME, LATE = "on_time", "late"
SPAN_S = 3600
NO_TIME = -1        # the folder of rows without an event time
OPEN_SPANS = 32     # files that a task holds open at once: one a span, so that no text is sorted


def span_of(seconds: Column, span_s: int) -> Column:
    """The folder of an event time in epoch seconds."""
    return F.floor(seconds / F.lit(span_s)).cast("long")


def split_batch(batch: DataFrame, batch_id: int, seconds: Column, base: str, delay_s: int,
                span_s: int = SPAN_S) -> None:
    """Write one micro-batch to the two topics below ``base``.

    ``seconds`` is the rows' event time in epoch seconds; rows without one are
    late by definition (folder ``NO_TIME``). On-time rows lie between the bound
    and the largest time, in few spans: they are written as they lie. Late rows
    may be of any span and are shuffled by it first.
    """
    spark = batch.sparkSession
    rows = batch.withColumn("_t", seconds.cast("double")).persist()
    try:
        def cut() -> dict:
            before = (last_pin(spark, base, batch_id) or {}).get("seen")
            here = rows.agg(F.max("_t")).first()[0]
            seen = max((t for t in (before, here) if t is not None), default=None)
            return {"bound": None if before is None else before - delay_s, "seen": seen}

        bound = pinned(spark, base, batch_id, cut)["bound"]
        late = F.col("_t").isNull() | (F.lit(False) if bound is None else F.col("_t") < F.lit(bound))
        out = rows.withColumn("_bound", F.lit(bound).cast("double")).withColumn(
            "span", F.coalesce(span_of(F.col("_t"), span_s), F.lit(NO_TIME).cast("long")))
        for topic, some in ((ON_TIME, ~late), (LATE, late)):
            part = out.where(some)
            if not part.isEmpty():
                with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_SPANS)):
                    write_version_once(part, f"{base}/{topic}", batch_id, partition_by=["span"],
                                       compression="zstd", rebalance=topic == LATE)
    finally:
        rows.unpersist()


def start_split(rows: DataFrame, seconds: Column, base: str, checkpoint: str, delay_s: int,
                available_now: bool = False, span_s: int = SPAN_S):
    """The splitting job: topics ``on_time`` and ``late`` below ``base``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            split_batch(batch, int(batch_id), seconds, base.rstrip("/"), delay_s, span_s)

    w = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    return trigger(w, available_now).start()


def topic_rows(spark: SparkSession, base: str, topic: str, schema: str,
               after: int = -1, upto: int | None = None) -> DataFrame:
    """The rows of a topic's versions ``after`` < version <= ``upto`` (with ``span`` and ``batch_id``).

    ``schema`` names the columns of the split rows; a topic without a version
    yet has no rows.
    """
    path = f"{base.rstrip('/')}/{topic}"
    full = f"{schema}, _t double, _bound double"
    if not path_exists(spark, path) or newest_version(spark, path) is None:
        return spark.createDataFrame([], f"{full}, batch_id long, kind string, span long")
    found = read_versions(spark, path, f"{full}, batch_id long, kind string, span long")
    found = found.where(F.col("batch_id") > F.lit(after))
    return found if upto is None else found.where(F.col("batch_id") <= F.lit(upto))


def bound_of(spark: SparkSession, base: str) -> float | None:
    """The event time from which on rows may still come on time; None before the second batch."""
    return (last_pin(spark, base, 1 << 62) or {}).get("bound")


# ---------------------------------------------------------------- W2: late counts

def late_counts(spark: SparkSession, base: str, schema: str, counts_path: str,
                window_s: int = W.WINDOW_SECONDS, slide_s: int = W.SLIDE_SECONDS) -> int | None:
    """Count the late rows not counted yet, per window, as one version below ``counts_path``.

    Windows are sums, so a late row needs no other row: a pass takes the late
    versions since the last one. Its version number is the last late version
    it took; a pass that is run again writes the same version.
    """
    upto = newest_version(spark, f"{base.rstrip('/')}/{LATE}")
    done = newest_version(spark, counts_path)
    if upto is None or (done is not None and done >= upto):
        return None
    rows = topic_rows(spark, base, LATE, schema, -1 if done is None else done, upto)
    rows = rows.where(F.col("_t").isNotNull()).select(F.timestamp_micros(
        (F.col("_t") * 1_000_000).cast("long")).alias("_ts"))
    write_version(W.sliding_window_counts(rows, "_ts", window_s, slide_s), counts_path, upto)
    return upto


# ---------------------------------------------------------------- J1/D2: late wide rows

MESSAGE = "value string"


def _seen(spark: SparkSession, base: str, fields, keys: list[str], spans: list[int], after: int,
          upto: int | None) -> DataFrame:
    """The messages of some spans, each once, with ``_first``: the late version that brought it.

    ``_first`` is null for a message that came on time, however often it came
    again. ``_new`` says that this pass has to join it.
    """
    on_time = topic_rows(spark, base, ON_TIME, MESSAGE).where(F.col("span").isin(spans))
    late = topic_rows(spark, base, LATE, MESSAGE, -1, -1 if upto is None else upto)
    late = late.where(F.col("span").isin(spans))
    both = on_time.select("value", F.lit(-1).cast("long").alias("_first")).unionByName(
        late.select("value", F.col("batch_id").cast("long").alias("_first")))
    typed = parse_typed(both, "value", fields, keep=["_first"])
    rest = [n for n, _ in fields if n not in keys]
    # by the order's id alone: the join that follows finds the rows as they lie
    once = typed.repartition(keys[0]).groupBy(*keys).agg(F.min("_first").alias("_first"), F.min(F.struct(*rest)).alias("_r"))
    return once.select(*keys, "_r.*", F.col("_first"), (F.col("_first") > after).alias("_new"))


def _mature(spark: SparkSession, base: str, after: int, bound_s: int, other: float | None,
            final: bool) -> int | None:
    """The last late version to work off: no on-time partner of its rows can come any more."""
    if final:
        return newest_version(spark, f"{base.rstrip('/')}/{LATE}")
    if other is None:
        return None
    cuts = topic_rows(spark, base, LATE, MESSAGE, after).groupBy("batch_id").agg(
        F.max("_bound").alias("b"))
    young = cuts.where(F.col("b") + bound_s > other).agg(F.min("batch_id")).first()[0]
    ripe = cuts if young is None else cuts.where(F.col("batch_id") < young)
    return ripe.agg(F.max("batch_id")).first()[0]


def late_wide(spark: SparkSession, info_base: str, detail_base: str, late_path: str,
              bound_s: int = 10, span_s: int = SPAN_S, final: bool = False) -> int | None:
    """One scheduled pass: the wide rows that late messages are part of, as a version of ``late_path``.

    Works off the versions of the two late topics since the last pass, reading
    of all topics only the spans of event time that those touch. A pair is
    owed when one of its messages never came on time (else the stream has
    joined it) and this pass is the first to see one of them. A late version is
    worked off once the other side's bound has passed all partners that it may
    have; with ``final`` (no more input) at once. Returns the pass's number,
    or None where there was nothing to do.
    """
    number = newest_version(spark, late_path)
    number = 0 if number is None else number + 1
    # a pass that failed half-way finds its own bounds again
    done = last_pin(spark, late_path, number) or {"info": -1, "detail": -1}

    def bounds() -> dict:
        info = _mature(spark, info_base, done["info"], bound_s, bound_of(spark, detail_base), final)
        detail = _mature(spark, detail_base, done["detail"], bound_s, bound_of(spark, info_base), final)
        return {"info": max(done["info"], -1 if info is None else info),
                "detail": max(done["detail"], -1 if detail is None else detail)}

    upto = read_pin(spark, late_path, number) or bounds()
    if upto == done:
        return None
    upto = pinned(spark, late_path, number, lambda: upto)
    new = [topic_rows(spark, base, LATE, MESSAGE, done[k], upto[k]).select("_t")
           for k, base in (("info", info_base), ("detail", detail_base))]
    touched = new[0].unionByName(new[1]).where(F.col("_t").isNotNull()).select(F.explode(F.array(
        *[span_of(F.col("_t") + d, span_s) for d in (-bound_s, 0, bound_s)])).alias("span")).distinct()
    spans = [r["span"] for r in touched.collect()]          # stretches of time, not rows
    info = _seen(spark, info_base, DWD_ORDER_INFO_FIELDS, ["id"], spans, done["info"], upto["info"])
    detail = _seen(spark, detail_base, ORDER_DETAIL_FIELDS, ["order_id", "id"], spans, done["detail"],
                   upto["detail"])
    owed = F.col("_new") | F.col("_detail_new")
    pairs = W.order_wide_interval(
        info, detail.withColumnsRenamed({"_new": "_detail_new", "_first": "_detail_first"}), bound_s,
        info_more=("_new",), detail_more=("_detail_new",)).where(owed)
    write_version(pairs.select(*ORDER_WIDE_COLUMNS), late_path, number)
    return number


def read_wide(spark: SparkSession, sink_path: str, late_path: str | None = None) -> DataFrame:
    """The wide rows of the stream and of the passes over late messages."""
    wide = spark.read.parquet(sink_path).select(*ORDER_WIDE_COLUMNS)
    if late_path is not None and newest_version(spark, late_path) is not None:
        wide = wide.unionByName(read_versions(spark, late_path).select(*ORDER_WIDE_COLUMNS))
    return wide
