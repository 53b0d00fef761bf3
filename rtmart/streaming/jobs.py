"""Streaming jobs (W1-W7): the seven jobs of the original, on Structured Streaming.

- log and change-data routing -> ``start_topic_stream`` (F1-F4, K1/K2)
- province dimension          -> ``start_dim_province`` (K3)
- daily active devices        -> ``start_dau`` (D1)
- order job                   -> ``first_order_batch_fn`` / ``start_first_order`` (D3-D5, J2)
- detail job                  -> ``start_topic_stream`` over typed details (K1, K7)
- wide order                  -> ``wide_batch_fn`` / ``start_wide`` (J1/J5, D2), behind the late
                                 split of ``rtmart.streaming.late``
- sliding window counts       -> ``start_sliding_counts`` (W2)

Every job takes a streaming DataFrame (Kafka in production, files in tests),
uses the batch operators, and writes through a sink whose commit follows the
checkpoint (offsets are committed after the output, as the original did by
hand; ``rtmart.streaming.progress`` keeps their record). Keyed outputs are
version ``batch_id=N`` folders overwritten as a whole, so a replayed batch is
idempotent; they are compacted on a schedule. A batch that reads a side table
pins the version it read, so its replay reads the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rtmart.functions import parse_typed, text_seconds
from rtmart.operators import dau as D
from rtmart.operators import orders as O
from rtmart.operators import wide as W
from rtmart.operators.asof import VersionedTable, last_pin, pinned
from rtmart.operators.joins import DEFAULT_BROADCAST_MAX_ROWS
from rtmart.operators.upsert import (compact, compaction_plan, drop_versions, latest_per_key, path_exists,
                                     read_first, read_latest, read_versions, version_numbers,
                                     write_files_once, write_version, write_version_once)
from rtmart.schemas import (DAU_INFO, DWD_ORDER_INFO_FIELDS, ORDER_DETAIL_FIELDS,
                            ORDER_WIDE_COLUMNS)
from rtmart.session import setting
from rtmart.sources.streams import kafka_sink_options, with_headers
from rtmart.streaming.base import MICRO_BATCH, spark_of, trigger as _trigger
from rtmart.streaming.reports import update_hour_counts

__all__ = ["MICRO_BATCH", "first_order_batch_fn", "path_exists", "province_table", "read_dau_table",
           "read_flagged_orders", "read_provinces", "read_sliding_counts", "read_topics", "spark_of",
           "start_dau", "start_dim_province", "start_first_order", "start_preview",
           "start_sliding_counts", "start_topic_stream", "start_wide", "wide_batch_fn"]


# ---------------------------------------------------------------- routing / pass-through

TOPIC_COLUMNS = ("topic", "key", "value", "op")


def start_topic_stream(routed: DataFrame, sink_path: str | None, checkpoint: str,
                       available_now: bool = False, kafka_bootstrap: str | None = None):
    """K1/K2 stream form: rows (topic[, key], value[, op]).

    Without ``kafka_bootstrap`` they are appended to a parquet table
    partitioned by topic (the file sink commits exactly once per batch); with
    it each row goes to the Kafka topic named in its ``topic`` column
    (at-least-once, like the original producer; needs the connector jar),
    its change type ``op`` as a header.
    """
    cols = [c for c in TOPIC_COLUMNS if c in routed.columns]
    rows = routed.select(*cols)
    w = (with_headers(rows) if kafka_bootstrap else rows).writeStream.outputMode("append") \
        .option("checkpointLocation", checkpoint)
    if kafka_bootstrap:
        w = w.format("kafka")
        for k, v in kafka_sink_options(kafka_bootstrap).items():
            w = w.option(k, v)
    else:
        w = w.format("parquet").option("compression", "zstd").partitionBy("topic").option("path", sink_path)
    return _trigger(w, available_now).start()


def read_topics(spark: SparkSession, sink_path: str) -> DataFrame:
    df = spark.read.parquet(sink_path)
    return df.select(*[c for c in TOPIC_COLUMNS if c in df.columns])


# Columns that tell which of two changes of a key came last.
CHANGE_ORDER = ("partition", "offset", "seq")


def _change_order(df: DataFrame) -> list[str]:
    order = [c for c in CHANGE_ORDER if c in df.columns]
    if not order:
        raise ValueError("a change stream needs its topic's partition and offset, or a seq "
                         "column: the last change of a key cannot be told otherwise")
    return order


def _quarantine(rows: DataFrame, path: str | None, version: int) -> None:
    """Unusable texts of a batch, as their own version."""
    if path is not None and not rows.isEmpty():
        write_version(rows, path, version)


DIM_COMPACT_EVERY = 100           # fold recent dimension versions every N batches
DIM_FULL_COMPACT_EVERY = 2000     # ... and everything every M batches


def start_dim_province(ods_province: DataFrame, table_path: str, checkpoint: str,
                       available_now: bool = False, quarantine_path: str | None = None,
                       compact_every: int = DIM_COMPACT_EVERY):
    """Province dimension job: each batch's last change per id is written as
    one version; readers take the last change over all versions (K3).

    The input carries the topic's ``partition`` and ``offset`` (changes of an
    id share a partition), or a ``seq``, and may carry the change's type
    ``op``. A delete is kept as a tombstone, in folds too: the id is gone until
    a later change brings it back. Folds let the table be read as of any
    version since the fold before the last.
    """
    order = _change_order(ods_province)

    def upsert(batch: DataFrame, batch_id: int):
        if batch.isEmpty():                 # nothing to upsert (K4: no-op when empty)
            return
        now, since = compaction_plan(batch_id, compact_every, DIM_FULL_COMPACT_EVERY)
        if now and path_exists(spark_of(batch), table_path):
            compact(spark_of(batch), table_path, ["id"], order, at=batch_id, since=since)
        op = F.col("op") if "op" in batch.columns else F.lit(None).cast("string")
        deleted = F.coalesce(F.lower(op) == O.DELETE, F.lit(False))
        rows = O.province_typed(batch.select("value", *order, deleted.alias("deleted")))
        write_version(latest_per_key(rows, ["id"], order), table_path, batch_id)
        _quarantine(O.province_quarantine(batch), quarantine_path, batch_id)

    w = ods_province.writeStream.option("checkpointLocation", checkpoint).foreachBatch(upsert)
    return _trigger(w, available_now).start()


def province_table(spark: SparkSession, table_path: str,
                   order: tuple[str, ...] = ("seq",)) -> VersionedTable:
    """The province table, to be read as of a version; deleted ids are left out."""
    return VersionedTable(spark, table_path, ["id"], list(order), deleted_col="deleted")


def read_provinces(spark: SparkSession, table_path: str) -> DataFrame:
    """The province table: the last change per id, unless it was a delete."""
    order = _change_order(read_versions(spark, table_path))
    last = read_latest(spark, table_path, ["id"], order)
    return last.where(~F.col("deleted")).select("id", "name", "area_code", "iso_code",
                                                "iso_3166_2")


# ---------------------------------------------------------------- D1: daily active devices

DAU_COMPACT_EVERY = 100         # fold recent device-day versions every N batches
DAU_FULL_COMPACT_EVERY = 2000   # ... and everything every M batches
DAU_KEYS, DAU_FIRST = ["dt", "mid"], ["ts", "event_id"]


def start_dau(raw: DataFrame, table_path: str, checkpoint: str,
              available_now: bool = False, compact_every: int = DAU_COMPACT_EVERY,
              quarantine_path: str | None = None, hours_path: str | None = None):
    """Raw log text stream -> versioned table of the first record of each
    (event day, device).

    A micro-batch writes the first record of each of its device-days as one
    version, partitioned by ``dt`` (the per-day index of the original: a
    one-day read prunes every other day); readers take the first over all
    versions. No state is kept and nothing is too late: a record of any age
    finds its day, and the result does not depend on arrival order. Days
    follow the session time zone, as in the batch form. Every
    ``compact_every`` batches the committed versions are folded, so reads do
    not grow with the number of micro-batches.

    ``quarantine_path`` gets the texts that are no usable log record;
    ``hours_path`` a table of counts per day and hour that is kept up to date
    (``rtmart.streaming.reports``).
    """
    def upsert(batch: DataFrame, batch_id: int):
        now, since = compaction_plan(batch_id, compact_every, DAU_FULL_COMPACT_EVERY)
        if now and path_exists(spark_of(batch), table_path):
            compact(spark_of(batch), table_path, DAU_KEYS, DAU_FIRST, at=batch_id,
                    partition_by=["dt"], since=since, first=True)
        parsed = D.parse_app_log(batch, keep=["value"]).persist()      # parsed once
        rows = D.first_records(D.valid_logs(parsed)).persist()
        try:
            _quarantine(O.quarantined(parsed.where(~F.col("is_valid"))), quarantine_path, batch_id)
            if not rows.isEmpty():          # no-op when a batch brings no record
                if hours_path is not None:
                    update_hour_counts(rows, table_path, hours_path, int(batch_id))
                write_version(rows, table_path, batch_id, partition_by=["dt"])
        finally:
            rows.unpersist()
            parsed.unpersist()

    w = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(upsert)
    return _trigger(w, available_now).start()


def read_dau_table(spark: SparkSession, table_path: str, date: str | None = None) -> DataFrame:
    """The active-device table: the first record per (dt, mid); with ``date``
    only that day's folders are read (S7: partition pruning)."""
    versions = read_versions(spark, table_path)
    if date is not None:
        versions = versions.where(F.col("dt") == F.lit(date))
    versions = versions.withColumn("dt", F.col("dt").cast("string")).drop("batch_id", "kind")
    return latest_per_key(versions, DAU_KEYS, DAU_FIRST, first=True).select(*DAU_INFO.names)


def start_preview(df: DataFrame, rows: int = 1000, available_now: bool = False):
    """K5/T4: print up to ``rows`` rows of every micro-batch (debugging aid)."""
    w = df.writeStream.format("console").option("numRows", rows).option("truncate", "false")
    return _trigger(w, available_now).start()


# ---------------------------------------------------------------- D3-D5: first order

STATE_COMPACT_EVERY = 50          # fold recent versions every N batches
STATE_FULL_COMPACT_EVERY = 1000   # ... and all user state every M batches


TOPIC_PARTITIONS = 4              # files of a version of the message topic


STATE_KEYS = 1000                 # users looked up as a pushed list of values


def _state_of(spark: SparkSession, state_path: str, version: int, users: DataFrame):
    """The consumed ones among a batch's users, from the versions before it.

    ``users`` has a row per user and is stored (persisted): it is counted first.

    Folded state is sorted by user and has Bloom filters. The users of a
    micro-batch, up to STATE_KEYS of them, go to the scan as a list of values,
    which skips every row group that holds none of them: the read grows with
    the batch, not with the history. (Parquet takes lists of values up to
    ``spark.sql.parquet.pushdown.inFilterThreshold``; see ``session``.) The
    users of a larger batch are broadcast, their count checked on the persisted
    batch, and the stored state is scanned and filtered, neither shuffled nor
    aggregated. Rows only ever say consumed, so no latest version has to be
    found.
    """
    users = users.select(F.col("user_id").cast("string").alias("user_id"))
    stored = read_versions(spark, state_path, before=version).select("user_id")
    n = users.count()
    if n <= STATE_KEYS:
        few = [r["user_id"] for r in users.collect()]
        found = stored.where(F.col("user_id").isin([u for u in few if u is not None]))
    else:
        few = n <= DEFAULT_BROADCAST_MAX_ROWS
        found = stored.join(F.broadcast(users) if few else users, "user_id", "left_semi")
    return found.distinct().select("user_id", F.lit(O.CONSUMED).alias("if_consumed"))


def _provinces_of(spark: SparkSession, provinces, out_path: str, version: int) -> DataFrame:
    if not isinstance(provinces, VersionedTable):
        return provinces()
    pin = pinned(spark, out_path, version, lambda: {"provinces": provinces.version()})
    found = provinces.as_of(pin["provinces"])
    return O.no_provinces(spark) if found is None else found


def first_order_batch_fn(spark: SparkSession, state_path: str, out_path: str,
                         provinces, version_offset: int = 1,
                         compact_every: int = STATE_COMPACT_EVERY,
                         topic_path: str | None = None, quarantine_path: str | None = None):
    """The per-batch function of the order job (``foreachBatch``).

    Batch N (version N + offset): read the state of the batch's users from
    versions < N, flag first orders, re-read and join the province dimension
    (W7: side data refreshed per batch), write the flagged orders and the new
    users' state as version N.

    ``provinces`` is a ``VersionedTable``: the batch reads its newest version
    and stores the number below ``out_path`` before it writes anything. A
    re-run of the batch reads that version again and the same earlier state,
    so it gives the same result even where the dimension has changed in
    between. (A function that returns a frame is called at each run; then that
    holds as long as its result stands still.) An order delivered again in a
    later batch does not change the one already written
    (``read_flagged_orders`` keeps the first).

    ``topic_path`` gets the flagged orders as messages keyed by user, the
    input of the wide job (K2), written once: a replay leaves a finished
    version under its file names. ``quarantine_path`` gets the unusable texts. Every
    ``compact_every`` batches the committed versions (< N) are folded.
    """
    def run(batch: DataFrame, batch_id: int):
        if batch.isEmpty():
            return
        version = int(batch_id) + version_offset
        now, since = compaction_plan(version, compact_every, STATE_FULL_COMPACT_EVERY)
        if now and path_exists(spark, state_path):
            compact(spark, state_path, ["user_id"], [], at=version, since=since,
                    cluster_by=["user_id"])
        now, since = compaction_plan(version, compact_every, None)
        if now and path_exists(spark, out_path):
            # append-only output: fold recent deltas into a segment, never all
            compact(spark, out_path, ["id"], [], at=version, since=since, first=True)
        orders = O.order_info_typed(batch).persist()   # parsed once, read often
        # a row per user, for the state read, the flags and the new state alike
        firsts = O.first_orders(orders).persist()
        state = None
        if path_exists(spark, state_path):
            state = _state_of(spark, state_path, version, firsts).persist()
        flagged = O.dwd_order_info(orders, state, _provinces_of(spark, provinces, out_path, version), firsts)
        if topic_path is not None:                     # written twice
            flagged = flagged.persist()
        try:
            write_version(flagged, out_path, version)
            if topic_path is not None:
                write_version_once(
                    O.order_info_messages(flagged).repartition(TOPIC_PARTITIONS, "key"),
                    topic_path, version)
            write_version(O.new_user_state(firsts, state), state_path, version)
            _quarantine(O.order_info_quarantine(batch), quarantine_path, version)
        finally:
            for df in (flagged, state, firsts, orders):
                if df is not None:
                    df.unpersist()
    return run


def start_first_order(ods_orders: DataFrame, spark: SparkSession, state_path: str,
                      out_path: str, checkpoint: str, provinces,
                      available_now: bool = False, version_offset: int = 1,
                      compact_every: int = STATE_COMPACT_EVERY,
                      topic_path: str | None = None, quarantine_path: str | None = None):
    fn = first_order_batch_fn(spark, state_path, out_path, provinces, version_offset,
                              compact_every, topic_path, quarantine_path)
    w = ods_orders.writeStream.option("checkpointLocation", checkpoint).foreachBatch(fn)
    return _trigger(w, available_now).start()


def read_flagged_orders(spark: SparkSession, out_path: str, columns: tuple = ()) -> DataFrame:
    """Each order as first written: a later redelivery finds its user consumed
    and would turn its flag to '0'. With ``columns`` (the id first) only these
    are read and shuffled."""
    return read_first(spark, out_path, ["id"], columns=columns).drop("batch_id")


# ---------------------------------------------------------------- J1/J5 + D2: wide order

def _once(new: DataFrame, before: DataFrame | None, keys: list[str]) -> DataFrame:
    """Each key's row: the open one of earlier batches, else one of this batch (``_new``).

    The first key is the order's id, by which the rows are shuffled, once.
    """
    both = new.withColumn("_new", F.lit(True))
    if before is not None:
        both = both.unionByName(before.withColumn("_new", F.lit(False)))
    rest = [c for c in new.columns if c not in keys]
    # by the order's id alone: the join that follows finds the rows as they lie
    first = both.repartition(keys[0]).groupBy(*keys).agg(F.min(F.struct("_new", *rest)).alias("_r"))
    return first.select(*keys, "_r.*")


def _open_rows(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """What the last batch before ``batch_id`` left open."""
    last = max((n for n in version_numbers(spark, path) if n < batch_id), default=None)
    if last is None:
        return None
    return read_versions(spark, path).where(F.col("batch_id") == F.lit(last)).drop("batch_id", "kind")


def wide_batch_fn(sink_path: str, open_path: str, bound_s: int = 10, delay_s: int = 3600):
    """The per-batch function of the wide job (``foreachBatch``).

    A batch holds order (``is_order``) and detail messages. Orders are
    deduplicated by id and details by (order id, detail id) (D2: replayed
    messages), then joined on order id with |detail time - order time| <=
    bound_s, this batch's rows with each other and with the rows left open by
    the batches before; each pair comes in the batch that brings its second
    message.

    The watermark is the smaller of the largest event times that both sides
    have had in earlier batches, less ``delay_s``. Rows earlier than it are
    left out: read the on-time topics of ``late.start_split`` whose delay is
    below ``delay_s``, then none is, and ``late_wide`` joins the late ones. A
    row stays open until the watermark has passed every partner and copy of it
    that may come. Open rows are a version of two tables below ``open_path``,
    the largest times a pin of the batch, so a replay gives the same pairs.

    The join is a batch join. Both sides are shuffled by order id once, for the
    deduplication and the join: an order's messages of a batch meet in one task,
    which sorts them and spills.
    """
    sides = (("orders", F.col("is_order"), DWD_ORDER_INFO_FIELDS, ["id"]),
             ("details", ~F.col("is_order"), ORDER_DETAIL_FIELDS, ["order_id", "id"]))
    reach = max(int(bound_s), int(delay_s))

    def watermark(seen: dict | None):
        times = [(seen or {}).get(name) for name, *_ in sides]
        return None if None in times else min(times) - delay_s

    def run(batch: DataFrame, batch_id: int) -> None:
        # the rows are kept for a few reads: packing them tighter costs more than it saves
        with setting(spark_of(batch), "spark.sql.inMemoryColumnarStorage.compressed", "false"):
            if not batch.isEmpty():
                join(batch, int(batch_id))

    def join(batch: DataFrame, number: int) -> None:
        spark = spark_of(batch)
        before = last_pin(spark, open_path, number)
        passed = watermark(before)
        rows = {}
        for name, mine, fields, keys in sides:
            new = parse_typed(batch.where(mine), "value", fields).withColumn("_t", text_seconds("create_time"))
            new = new.where(F.col("_t").isNotNull() if passed is None else F.col("_t") >= F.lit(passed))
            rows[name] = _once(new, _open_rows(spark, f"{open_path}/{name}", number), keys).persist()
        try:
            def seen() -> dict:
                here = {name: df.agg(F.max("_t")).first()[0] for name, df in rows.items()}
                return {name: max((t for t in ((before or {}).get(name), here[name]) if t is not None),
                                  default=None) for name in rows}

            until = watermark(pinned(spark, open_path, number, seen))
            owed = F.col("_new") | F.col("_detail_new")
            pairs = W.order_wide_interval(
                rows["orders"], rows["details"].withColumnRenamed("_new", "_detail_new"), bound_s,
                info_more=("_new",), detail_more=("_detail_new",)).where(owed)
            write_files_once(pairs.select(*ORDER_WIDE_COLUMNS), sink_path, number)
            for name, df in rows.items():
                still = df if until is None else df.where(F.col("_t") >= F.lit(until - reach))
                write_version(still.drop("_new"), f"{open_path}/{name}", number)
                # a replay of this batch needs the version before it
                older = [n for n in version_numbers(spark, f"{open_path}/{name}") if n < number]
                if older:
                    drop_versions(spark, f"{open_path}/{name}", before=older[-1])
        finally:
            for df in rows.values():
                df.unpersist()
    return run


def start_wide(info_msgs: DataFrame, detail_msgs: DataFrame, sink_path: str, checkpoint: str,
               available_now: bool = False, bound_s: int = 10, watermark: str = "1 hour",
               salts: int | None = None):
    """Append the wide rows to a parquet table, each batch's once.

    What is open between batches lies below the checkpoint. ``salts`` has no
    effect any more.
    """
    spark = spark_of(info_msgs)
    delay_s = spark.range(1).select(F.unix_seconds(
        F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {watermark}"))).first()[0]
    both = info_msgs.select("value", F.lit(True).alias("is_order")).unionByName(
        detail_msgs.select("value", F.lit(False).alias("is_order")))
    fn = wide_batch_fn(sink_path, f"{checkpoint.rstrip('/')}/open", bound_s, delay_s)
    w = both.writeStream.option("checkpointLocation", checkpoint).foreachBatch(fn)
    return _trigger(w, available_now).start()


# ---------------------------------------------------------------- W2: sliding window counts

COUNTS_COMPACT_EVERY = 100


def start_sliding_counts(rows: DataFrame, ts, table_path: str, checkpoint: str,
                         window_s: int = W.WINDOW_SECONDS, slide_s: int = W.SLIDE_SECONDS,
                         watermark: str = "1 hour", available_now: bool = False,
                         compact_every: int = COUNTS_COMPACT_EVERY):
    """W2 as a stream: rows per sliding window of event time.

    A stateful windowed aggregate in update mode: each micro-batch writes the
    windows it changed, with their count so far, as one version; readers take
    the last per window. The watermark ends the state of a window. Rows later
    than it would be left out: read the on-time topic of ``late.start_split``
    and add the late ones by ``late.late_counts``.
    """
    def upsert(batch: DataFrame, batch_id: int):
        now, since = compaction_plan(batch_id, compact_every, 20 * compact_every)
        if now and path_exists(spark_of(batch), table_path):
            compact(spark_of(batch), table_path, ["window_start"], [], at=batch_id, since=since)
        if not batch.isEmpty():
            write_version(batch, table_path, batch_id)

    timed = rows.select(ts.cast("timestamp").alias("_ts")).withWatermark("_ts", watermark)
    counts = W.sliding_window_counts(timed, "_ts", window_s, slide_s)
    w = (counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(upsert))
    return _trigger(w, available_now).start()


def read_sliding_counts(spark: SparkSession, table_path: str,
                        late_path: str | None = None) -> DataFrame:
    """The last count of each window, and what late rows add to it."""
    counts = read_latest(spark, table_path, ["window_start"], []).select(
        "window_start", "window_end", "cnt")
    if late_path is not None and path_exists(spark, late_path):
        counts = counts.unionByName(read_versions(spark, late_path).select(*counts.columns))
    return counts.groupBy("window_start", "window_end").agg(F.sum("cnt").alias("cnt"))
