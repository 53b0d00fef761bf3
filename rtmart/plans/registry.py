"""Named queries: each reads the given tables from ``sf_dir`` and returns a
DataFrame. Keys match ``rtmart.plans.oracle.oracle_sql``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from rtmart.functions import millis_to_day, millis_to_hour, millis_to_minute, text_seconds, to_json_row
from rtmart.operators import dau as D
from rtmart.operators import devices as DV
from rtmart.operators import dims as DM
from rtmart.operators import orders as O
from rtmart.operators import routing as R
from rtmart.operators import search as SE
from rtmart.operators import text_index as TI
from rtmart.operators import wide as W
from rtmart.operators.lineage import cut_lineage, cut_small
from rtmart.operators.upsert import latest_per_key, read_latest, read_versions, write_version
from rtmart.session import setting, shared_path
from rtmart.sinks.files import archive_log_lines
from rtmart.sources import fixtures as FX
from rtmart.sources.streams import file_stream
from rtmart.sources.tables import query_list, read_table
from rtmart.streaming import jobs as J
from rtmart.streaming import late as LT
from rtmart.streaming import progress as PG
from rtmart.streaming import reports as RP
from rtmart.streaming.staging import ROWS_PER_SLICE, slice_files, stage_files, stage_time_slices

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark, sf, name):
    return read_table(spark, sf, name)


# ---------------------------------------------------------------- app logs / DAU

def app_log_raw(spark, sf):
    return FX.app_log_text(_t(spark, sf, "events"))


def app_logs(spark, sf):
    return D.valid_logs(D.parse_app_log(app_log_raw(spark, sf)))


def dau_docs(spark, sf):
    return D.dau_first_touch(app_logs(spark, sf))


def q_parse_app_log(spark, sf):
    return D.parse_app_log(app_log_raw(spark, sf))


def q_route_app_log(spark, sf):
    return R.route_app_log(app_log_raw(spark, sf))


def q_dau_first_touch(spark, sf):
    return dau_docs(spark, sf)


def q_dau_hour_count(spark, sf):
    return D.dau_hour_count(dau_docs(spark, sf))


def q_dau_total(spark, sf):
    return D.dau_total(dau_docs(spark, sf))


def q_dau_hour_compare(spark, sf):
    return D.dau_hour_compare(dau_docs(spark, sf))


def q_realtime_total(spark, sf):
    return D.realtime_total(dau_docs(spark, sf))


def q_dau_distinct_check(spark, sf):
    return D.dau_distinct_check(app_logs(spark, sf))


def q_report_hour_json(spark, sf):
    return D.report_hour_json(dau_docs(spark, sf))


def q_report_total_json(spark, sf):
    return D.report_total_json(dau_docs(spark, sf))


def q_raw_log_archive(spark, sf):
    path = shared_path(spark, "raw_log_archive")
    archive_log_lines(app_log_raw(spark, sf), path, mode="overwrite")
    back = spark.read.text(path)   # partition column dt comes from the folders
    code = F.conv(F.substring(F.md5("value"), 1, 15), 16, 10).cast("bigint")
    return back.groupBy(F.col("dt").cast("string").alias("dt")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars"),
        F.bit_xor(code).alias("text_code"))


# ---------------------------------------------------------------- change data / orders

def oi_rows(spark, sf):
    return FX.order_info_rows(_t(spark, sf, "orders"), _t(spark, sf, "customer"))


def od_rows(spark, sf, with_order_status=False):
    return FX.order_detail_rows(_t(spark, sf, "lineitem"), _t(spark, sf, "orders"),
                                _t(spark, sf, "part"), with_order_status)


def orders_typed(spark, sf):
    return O.order_info_typed(FX.order_info_text(oi_rows(spark, sf)))


def details_typed(spark, sf):
    return O.order_detail_typed(FX.order_detail_text(od_rows(spark, sf)))


def provinces(spark, sf):
    return O.province_latest(FX.province_versions(_t(spark, sf, "nation")))


def state_and_batch(spark, sf):
    before, batch = FX.split_orders_by_state_cutoff(orders_typed(spark, sf))
    return O.user_state_from_orders(before), batch


def stored_orders(spark, sf):
    return cut_small(orders_typed(spark, sf), "dwd_orders")


def dwd_orders(spark, sf, orders=None):
    """All orders as one batch against an empty state: flagged and enriched;
    ``orders`` are the ``stored_orders`` where the caller holds them."""
    return O.dwd_order_info(stored_orders(spark, sf) if orders is None else orders, None, provinces(spark, sf))


def q_cdc_route_canal(spark, sf):
    env = FX.canal_envelopes(oi_rows(spark, sf), od_rows(spark, sf, True),
                             _t(spark, sf, "customer"))
    return R.route_canal(env)


def q_cdc_route_maxwell(spark, sf):
    env = FX.maxwell_envelopes(oi_rows(spark, sf), od_rows(spark, sf, True),
                               _t(spark, sf, "nation"), _t(spark, sf, "customer"),
                               _t(spark, sf, "part"), _t(spark, sf, "region"))
    return R.route_maxwell(env)


def q_order_info_typed(spark, sf):
    return orders_typed(spark, sf)


def q_order_detail_typed(spark, sf):
    return details_typed(spark, sf)


def q_dim_province_latest(spark, sf):
    return provinces(spark, sf)


def q_user_state_lookup(spark, sf):
    state, batch = state_and_batch(spark, sf)
    return O.user_state_lookup(batch, state)


def q_first_order_flag(spark, sf):
    state, batch = state_and_batch(spark, sf)
    batch = cut_lineage(batch, "first_order")
    return O.first_order_flag(batch, state).select("id", "user_id", "create_time",
                                                   "if_first_order")


def q_first_order_flag_empty_state(spark, sf):
    return O.first_order_flag(cut_lineage(orders_typed(spark, sf), "first_order")).select(
        "id", "user_id", "create_time", "if_first_order")


def q_province_enrich(spark, sf):
    return O.province_enrich(orders_typed(spark, sf), provinces(spark, sf)).select(
        "id", "province_id", "province_name", "province_area_code", "province_3166_2_code")


def q_user_state_upsert(spark, sf):
    """K3 for real: version 0 = prior state, version 1 = the batch's new users,
    both written to the shared folder; the read takes the latest per user."""
    state, batch = state_and_batch(spark, sf)
    path = shared_path(spark, "user_state")
    write_version(state, path, 0)
    prior = read_latest(spark, path, ["user_id"], []).drop("batch_id")
    write_version(O.new_user_state(batch, prior), path, 1)
    return read_latest(spark, path, ["user_id"], []).select("user_id", "if_consumed", "batch_id")


def q_dwd_order_info_messages(spark, sf):
    return O.order_info_messages(dwd_orders(spark, sf))


# ---------------------------------------------------------------- wide order

def q_order_wide(spark, sf):
    return W.order_wide(dwd_orders(spark, sf), details_typed(spark, sf))


def q_order_wide_dedup(spark, sf):
    return W.order_wide_windowed(dwd_orders(spark, sf), details_typed(spark, sf))


def q_order_wide_interval(spark, sf):
    return W.order_wide_interval(dwd_orders(spark, sf), details_typed(spark, sf), bound_s=10)


def q_sliding_window_counts(spark, sf):
    return W.sliding_window_counts(_t(spark, sf, "events"), "ts")


def q_detail_amount_split(spark, sf):
    return W.detail_amount_split(orders_typed(spark, sf), details_typed(spark, sf))


def _dim_msgs(rows, names=()):
    """Dimension change messages, every row changed twice; ``names`` are the
    fields in which the earlier change differs."""
    changes = FX.resent(rows, list(names))
    return changes.select(to_json_row(*[F.col(c) for c in rows.columns]).alias("value"), "seq")


def sku_dims(spark, sf):
    """(SKU, trademark, category, SPU) dimensions from their change messages."""
    part = _t(spark, sf, "part")
    return (DM.dim_latest(_dim_msgs(FX.sku_rows(part), ["sku_name"]), DM.SKU_FIELDS, ["seq"]),
            DM.dim_latest(_dim_msgs(FX.trademark_rows(part), ["tm_name"]), DM.TRADEMARK_FIELDS,
                          ["seq"]),
            DM.dim_latest(_dim_msgs(FX.category3_rows(part), ["name"]), DM.CATEGORY3_FIELDS,
                          ["seq"]),
            DM.dim_latest(_dim_msgs(FX.spu_rows(part), ["spu_name"]), DM.SPU_FIELDS, ["seq"]))


def user_dim(spark, sf):
    return DM.dim_latest(_dim_msgs(FX.user_rows(_t(spark, sf, "customer")), ["gender"]),
                         DM.USER_FIELDS, ["seq"])


def q_detail_dims(spark, sf):
    """Details with SKU, SPU, trademark and category dimensions (ODS JSON
    -> last change per id -> lookups)."""
    out = DM.detail_dims(details_typed(spark, sf), *sku_dims(spark, sf))
    return out.select(F.col("id").alias("order_detail_id"), "sku_id", "spu_id", "tm_id",
                      "category3_id", "spu_name", "tm_name", "category3_name")


def q_order_user_dim(spark, sf):
    """Orders with the user's age group and gender."""
    out = DM.order_user_dim(orders_typed(spark, sf), user_dim(spark, sf))
    return out.select("id", "user_id", "create_date", "user_age_group", "user_gender")


def q_order_wide_full(spark, sf):
    """The wide row with its amount share and every dimension."""
    orders = stored_orders(spark, sf)
    # users first, the flag by order id last: the orders then lie as the lines that they are joined with
    info = O.dwd_order_info(DM.order_user_dim(orders, user_dim(spark, sf)), None, provinces(spark, sf),
                            O.first_orders(orders))
    # the wide row has the order's time; a detail's own is only checked
    details = DM.detail_dims(details_typed(spark, sf).drop("create_time"), *sku_dims(spark, sf))
    return W.order_wide_full(info, W.detail_amount_split(orders, details, W.FULL_DETAIL_COLUMNS))


def q_order_info_quarantine(spark, sf):
    """Usable orders by id, the other texts as they came."""
    dirty = FX.order_info_text_dirty(oi_rows(spark, sf))
    good = O.order_info_typed(dirty).select(F.lit(O.DWD_ORDER_INFO_TOPIC).alias("topic"),
                                            F.col("id").cast("string").alias("value"))
    return good.unionByName(O.order_info_quarantine(dirty))


# ---------------------------------------------------------------- lookup / upsert

def q_match_top20(spark, sf):
    part = _t(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    return SE.match_sorted(part, "p_name", "red", "p_retailprice", "p_partkey")


def q_bulk_upsert_latest(spark, sf):
    """K4: every log record indexed as a document with id (dt, mid), in
    arrival order; the last write of each id wins."""
    logs = app_logs(spark, sf)
    docs = logs.select("mid", "uid", "ar", "ch", "vc", millis_to_day("ts").alias("dt"),
                       millis_to_hour("ts").alias("hr"), millis_to_minute("ts").alias("mi"),
                       "ts", "event_id")
    latest = latest_per_key(docs, ["dt", "mid"], ["ts", "event_id"])
    return latest.select("mid", "uid", "ar", "ch", "vc", "dt", "hr", "mi", "ts")


def q_rows_as_json(spark, sf):
    """P16 + S6: a table read by SQL, rows as JSON objects by column name,
    then read back."""
    cust = _t(spark, sf, "customer")
    cust.createOrReplaceTempView("rtmart_customer")
    js = query_list(spark, "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment "
                           "FROM rtmart_customer")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cust.schema.fields)
    back = js.select(F.from_json("value", schema).alias("r"), "value")
    return back.select("r.*", "value")


# ---------------------------------------------------------------- streaming

N_SLICES = 4            # time slices of the staged stream input
FILES_PER_SLICE = 4     # files per slice = files read per micro-batch


def _stage_app_logs(spark, sf, path, only=None):
    cols = FX.app_log_columns(_t(spark, sf, "events"))
    msgs = cols.select(to_json_row("common", "start", "ts", "event_id").alias("value"),
                       F.col("ts").alias("_ts"))
    return stage_time_slices(msgs, "_ts", path, N_SLICES, FILES_PER_SLICE,
                             keep=["value"], only=only)


def _sliced_stream(spark, path, schema="value string"):
    """Staged time slices as a stream, a slice each micro-batch."""
    return file_stream(spark, path, schema, slice_files(spark, path))


def _stream_of(spark, msgs, base, time_col=None, n_slices=N_SLICES, more=()):
    """Stage ``value`` messages into time slices (as they come when no time
    column: the job is stateless) and open them as a file stream; ``more``
    are long columns that come along."""
    schema = ", ".join(["value string", *[f"{c} long" for c in more]])
    if time_col is None:
        files = stage_files(msgs.select("value", *more), f"{base}/in", n_slices)
        return file_stream(spark, f"{base}/in", schema, files)
    msgs = msgs.withColumn("_t", F.col(time_col))
    stage_time_slices(msgs, "_t", f"{base}/in", n_slices, FILES_PER_SLICE, keep=["value", *more],
                      rows_per_slice=ROWS_PER_SLICE)
    return _sliced_stream(spark, f"{base}/in", schema)


# Files that a task of a topic stream holds open at once: one a topic, so that no text is sorted.
OPEN_TOPICS = 12


def _run_topics(spark, routed, base):
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_TOPICS)):
        J.start_topic_stream(routed, f"{base}/topics", f"{base}/ckpt",
                             available_now=True).awaitTermination()
    return J.read_topics(spark, f"{base}/topics")


def q_stream_route_app_log(spark, sf):
    """F1 as a stream: raw log lines -> GMALL_START / GMALL_EVENT folders."""
    base = shared_path(spark, "stream_route_app_log")
    _stage_app_logs(spark, sf, f"{base}/in")
    raw = _sliced_stream(spark, f"{base}/in")
    return _run_topics(spark, R.route_app_log(raw), base)


def q_stream_cdc_route_canal(spark, sf):
    base = shared_path(spark, "stream_cdc_route_canal")
    env = FX.canal_envelopes(oi_rows(spark, sf), od_rows(spark, sf, True),
                             _t(spark, sf, "customer"))
    return _run_topics(spark, R.route_canal(_stream_of(spark, env, base)), base)


def q_stream_cdc_route_maxwell(spark, sf):
    base = shared_path(spark, "stream_cdc_route_maxwell")
    env = FX.maxwell_envelopes(oi_rows(spark, sf), od_rows(spark, sf, True),
                               _t(spark, sf, "nation"), _t(spark, sf, "customer"),
                               _t(spark, sf, "part"), _t(spark, sf, "region"))
    return _run_topics(spark, R.route_maxwell(_stream_of(spark, env, base)), base)


def _province_changes(spark, sf):
    """Province change rows numbered in the order they were made."""
    v = FX.province_versions(_t(spark, sf, "nation"))
    return v.withColumn("seq", F.col("batch_id") * 1_000_000 + F.col("seq"))


def _province_table(spark, sf, base, n_slices):
    stream = _stream_of(spark, _province_changes(spark, sf), base, time_col="batch_id",
                        n_slices=n_slices, more=["seq"])
    J.start_dim_province(stream, f"{base}/table", f"{base}/ckpt",
                         available_now=True).awaitTermination()
    return J.read_provinces(spark, f"{base}/table")


def q_stream_dim_province(spark, sf):
    """K3 as a stream: province change rows, version by version, upserted."""
    return _province_table(spark, sf, shared_path(spark, "stream_dim_province"), 2)


def q_dim_province_same_batch(spark, sf):
    """K3: both changes of a province in one micro-batch; the last one wins."""
    return _province_table(spark, sf, shared_path(spark, "dim_province_same_batch"), 1)


def q_dwd_order_detail_messages(spark, sf):
    return O.order_detail_messages(details_typed(spark, sf))


def q_stream_dwd_order_detail(spark, sf):
    """The detail job as a stream: ODS detail JSON -> typed -> DWD messages."""
    base = shared_path(spark, "stream_dwd_order_detail")
    stream = _stream_of(spark, FX.order_detail_text(od_rows(spark, sf)), base)
    return _run_topics(spark, O.order_detail_messages(O.order_detail_typed(stream)), base)


def q_stream_dau(spark, sf):
    """D1 as a stream: staged log files -> windowed min per device-day ->
    versioned table; the final table equals ``dau_first_touch``."""
    base = shared_path(spark, "stream_dau")
    _stage_app_logs(spark, sf, f"{base}/in")
    raw = _sliced_stream(spark, f"{base}/in")
    J.start_dau(raw, f"{base}/table", f"{base}/ckpt", available_now=True).awaitTermination()
    return J.read_dau_table(spark, f"{base}/table")


def q_stream_restart(spark, sf):
    """Run on the first half of the input, stop, add the rest, restart
    from the checkpoint; nothing is lost or counted twice."""
    base = shared_path(spark, "stream_restart")
    half = range(0, N_SLICES // 2)
    rest = range(N_SLICES // 2, N_SLICES)
    _stage_app_logs(spark, sf, f"{base}/in", only=half)
    raw = _sliced_stream(spark, f"{base}/in")
    J.start_dau(raw, f"{base}/table", f"{base}/ckpt", available_now=True).awaitTermination()
    _stage_app_logs(spark, sf, f"{base}/in", only=rest)
    raw = _sliced_stream(spark, f"{base}/in")
    J.start_dau(raw, f"{base}/table", f"{base}/ckpt", available_now=True).awaitTermination()
    return J.read_dau_table(spark, f"{base}/table")


FLAG_COLUMNS = ("id", "user_id", "create_time", "if_first_order")


def _seconds(create_time):
    return text_seconds(create_time)


def _order_time():
    return _seconds(F.get_json_object("value", "$.create_time"))


def _stage_order_batch(spark, sf, base, again=False):
    """Seed user state (version 0) from orders before the cutoff; stage the
    later orders as ODS messages in create-time slices, and with ``again`` all
    of them once more after that."""
    before, batch = FX.split_orders_by_state_cutoff(cut_lineage(oi_rows(spark, sf), "order_rows"))
    write_version(O.user_state_from_orders(before), f"{base}/state", 0)
    rows = batch.withColumn("_t", _seconds("create_time"))
    if again:
        a_century = 100 * 366 * 86400
        rows = rows.unionByName(rows.withColumn("_t", F.col("_t") + a_century))
    stage_time_slices(rows, "_t", f"{base}/in", N_SLICES * (1 + again), FILES_PER_SLICE, keep=batch.columns,
                      rows_per_slice=ROWS_PER_SLICE, stored=True, made=(FX.order_info_value(batch),))
    return _sliced_stream(spark, f"{base}/in")


def q_stream_first_order(spark, sf):
    """D3-D5 as a stream: foreachBatch with versioned user state; equals the
    batch ``first_order_flag`` because each user's orders arrive in time order."""
    base = shared_path(spark, "stream_first_order")
    stream = _stage_order_batch(spark, sf, base)
    J.start_first_order(stream, spark, f"{base}/state", f"{base}/out", f"{base}/ckpt",
                        lambda: provinces(spark, sf), available_now=True).awaitTermination()
    return J.read_flagged_orders(spark, f"{base}/out", FLAG_COLUMNS)


def q_stream_replay(spark, sf):
    """Every micro-batch is applied twice (an at-least-once redelivery);
    the versioned writes make the second run a no-op."""
    base = shared_path(spark, "stream_replay")
    stream = _stage_order_batch(spark, sf, base)
    fn = J.first_order_batch_fn(spark, f"{base}/state", f"{base}/out",
                                lambda: provinces(spark, sf))

    def twice(df, batch_id):
        fn(df, batch_id)
        fn(df, batch_id)

    (stream.writeStream.option("checkpointLocation", f"{base}/ckpt").foreachBatch(twice)
        .trigger(availableNow=True).start().awaitTermination())
    return J.read_flagged_orders(spark, f"{base}/out", FLAG_COLUMNS)


def q_stream_redelivery(spark, sf):
    """Every order is delivered again in a later micro-batch; the flags
    first written stay."""
    base = shared_path(spark, "stream_redelivery")
    stream = _stage_order_batch(spark, sf, base, again=True)
    J.start_first_order(stream, spark, f"{base}/state", f"{base}/out", f"{base}/ckpt",
                        lambda: provinces(spark, sf), available_now=True).awaitTermination()
    return J.read_flagged_orders(spark, f"{base}/out", FLAG_COLUMNS)


def _late_logs(spark, sf, base):
    """The log stream with every seventh line after all others."""
    cols = FX.app_log_columns(_t(spark, sf, "events"))
    ten_years = 10 * 366 * 86_400_000
    msgs = cols.select(
        to_json_row("common", "start", "ts", "event_id").alias("value"),
        (F.col("ts") + F.when(F.col("event_id") % 7 == 0, ten_years).otherwise(0)).alias("_t"))
    return _stream_of(spark, msgs, base, time_col="_t")


def q_stream_dau_late(spark, sf):
    """Every seventh log line arrives after all others, up to the whole
    period late; none is lost."""
    base = shared_path(spark, "stream_dau_late")
    raw = _late_logs(spark, sf, base)
    J.start_dau(raw, f"{base}/table", f"{base}/ckpt", available_now=True).awaitTermination()
    return J.read_dau_table(spark, f"{base}/table")


def _wide_inputs(spark, sf, orders=None):
    """(order messages, detail messages) with their event times ``_t``."""
    info = O.order_info_messages(dwd_orders(spark, sf, orders), ("create_time",))
    det = O.order_detail_messages(details_typed(spark, sf), ("create_time",))
    return tuple(msgs.select("value", _seconds("create_time").alias("_t")) for msgs in (info, det))


def _wide_slices(spark, sf, orders):
    """(time bounds, number of slices) of the wide job's two inputs, from the stored orders.

    Both inputs have the same slices, so that the two sides of a batch are of
    one time and few rows stay open. The larger input says how many there are.
    """
    t = _seconds("create_time")
    row = orders.agg(F.min(t).alias("lo"), F.max(t).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    most = max(row["n"], _t(spark, sf, "lineitem").count())
    return (float(row["lo"] or 0.0), float(row["hi"] or 0.0)), max(N_SLICES, -(-most // ROWS_PER_SLICE))


def _run_wide(spark, info, det, base, bounds, n_slices):
    for name, rows in (("info", info), ("detail", det)):
        stage_time_slices(rows, "_t", f"{base}/{name}", n_slices, FILES_PER_SLICE, bounds=bounds,
                          keep=["value"], lying=True)
    i = _sliced_stream(spark, f"{base}/info")
    d = _sliced_stream(spark, f"{base}/detail")
    J.start_wide(i, d, f"{base}/wide", f"{base}/ckpt", available_now=True,
                 bound_s=10, watermark="1 hour").awaitTermination()
    return spark.read.parquet(f"{base}/wide").select(*W.ORDER_WIDE_COLUMNS)


def q_stream_order_wide(spark, sf):
    """J1/J5 + D2 as a stream-stream join of the detail-layer messages, with
    every detail message delivered twice; equals ``order_wide_interval``."""
    orders = stored_orders(spark, sf)
    info, det = _wide_inputs(spark, sf, orders)
    twice = det.select("*", F.explode(F.array(F.lit(0), F.lit(1)))).drop("col")
    return _run_wide(spark, info, twice, shared_path(spark, "stream_order_wide"),
                     *_wide_slices(spark, sf, orders))


DELAY_S = 3600                    # how late a message is joined by the stream itself
WATERMARK = f"{DELAY_S + 1} seconds"
SPAN_S = 90 * 86400               # the test data covers years: folders of a quarter


def _split(spark, path, base, seconds):
    """Run the late split over the slices that have come so far, each a micro-batch."""
    LT.start_split(_sliced_stream(spark, path), seconds, base, f"{base}_ckpt", DELAY_S,
                   available_now=True, span_s=SPAN_S).awaitTermination()


def q_stream_order_wide_late(spark, sf):
    """J1 + D2 with every fifth detail arriving after all others, later than
    the watermark: split off before the join, and joined by scheduled passes
    that read the late topics and the spans of time that these touch."""
    base = shared_path(spark, "stream_order_wide_late")
    orders = stored_orders(spark, sf)
    bounds, n_slices = _wide_slices(spark, sf, orders)
    info, det = [rows.withColumn("_t", _seconds("create_time"))
                 for rows in (dwd_orders(spark, sf, orders), details_typed(spark, sf))]
    late = F.xxhash64(O.order_detail_value(det)) % 5 == 0
    det = det.withColumn("_t", F.when(late, int(bounds[1]) + 1).otherwise(F.col("_t")))      # the last slice
    with setting(spark, "spark.sql.parquet.compression.codec", "zstd"):
        info, det = [cut_lineage(rows, "wide_late_input") for rows in (info, det)]
    info, det = O.order_info_messages(info, ("_t",)), O.order_detail_messages(det, ("_t",))
    half = n_slices // 2
    for part in (range(0, half), range(half, n_slices)):
        for name, rows in (("info", info), ("detail", det)):
            with setting(spark, "spark.sql.parquet.compression.codec", "zstd"):
                stage_time_slices(rows, "_t", f"{base}/in_{name}", n_slices, FILES_PER_SLICE, bounds=bounds,
                                  keep=["value"], only=part, stored=True, lying=True)
            _split(spark, f"{base}/in_{name}", f"{base}/{name}", _order_time())
        J.start_wide(file_stream(spark, f"{base}/info/on_time", "value string"),
                     file_stream(spark, f"{base}/detail/on_time", "value string"),
                     f"{base}/wide", f"{base}/ckpt", available_now=True, bound_s=10,
                     watermark=WATERMARK).awaitTermination()
        LT.late_wide(spark, f"{base}/info", f"{base}/detail", f"{base}/late", 10, SPAN_S,
                     final=part.stop == n_slices)
    return LT.read_wide(spark, f"{base}/wide", f"{base}/late")


def q_stream_sliding_window_counts(spark, sf):
    """W2 as a stream, every seventh event arriving after all others: windows
    counted with state, late events added by a pass over the late topic."""
    base = shared_path(spark, "stream_sliding_window_counts")
    ten_years = 10 * 366 * 86400
    events = _t(spark, sf, "events").select(
        "event_id", F.unix_micros(F.col("ts").cast("timestamp")).cast("string").alias("value"))
    seconds = F.col("value").cast("double") / 1_000_000
    came = events.withColumn("_t", seconds + F.when(F.col("event_id") % 7 == 0, ten_years).otherwise(0))
    for part in (range(0, N_SLICES // 2), range(N_SLICES // 2, N_SLICES)):
        stage_time_slices(came, "_t", f"{base}/in", N_SLICES, FILES_PER_SLICE, keep=["value"], only=part)
        _split(spark, f"{base}/in", f"{base}/events", seconds)
        on_time = file_stream(spark, f"{base}/events/on_time", "value string")
        J.start_sliding_counts(on_time, F.timestamp_micros(F.col("value").cast("long")), f"{base}/counts",
                               f"{base}/ckpt", watermark=WATERMARK,
                               available_now=True).awaitTermination()
        LT.late_counts(spark, f"{base}/events", "value string", f"{base}/late_counts")
    return J.read_sliding_counts(spark, f"{base}/counts", f"{base}/late_counts")


def q_stream_progress(spark, sf):
    """The record of a query of over a hundred micro-batches; every range
    once and without a gap."""
    base = shared_path(spark, "stream_progress")
    msgs = FX.app_log_columns(_t(spark, sf, "events")).select(
        to_json_row("common", "start", "ts", "event_id").alias("value"), F.col("event_id").alias("_t"))
    stage_time_slices(msgs, "_t", f"{base}/in", PROGRESS_BATCHES, 1, keep=["value"], rows_per_file=None)
    log = PG.ProgressLog(spark, f"{base}/progress", fold_every=25).attach()
    query = J.start_topic_stream(R.route_app_log(file_stream(spark, f"{base}/in", "value string", 1)),
                                 f"{base}/topics", f"{base}/ckpt", available_now=True)
    query.awaitTermination()
    log.detach(query)
    offsets = PG.batch_offsets(spark, f"{base}/progress").where(F.col("rows") > 0).persist()
    gaps, late = PG.uncovered(offsets).count(), PG.late_rows(offsets)
    return offsets.agg(F.count(F.lit(1)).alias("batches"), F.count_distinct("end_offset").alias("ranges"),
                       F.sum("rows").alias("n_rows")).select(
        "*", F.lit(gaps).cast("long").alias("gaps"), F.lit(late).cast("long").alias("late"))


PROGRESS_BATCHES = 120


def q_stream_replay_dimension(spark, sf):
    """Every micro-batch fails after its write and before its
    commit, the province dimension changes, and the batch is run again: it
    still reads the provinces that it read first."""
    base = shared_path(spark, "stream_replay_dimension")
    before, batch = FX.split_orders_by_state_cutoff(oi_rows(spark, sf))
    write_version(O.user_state_from_orders(before), f"{base}/state", 0)
    msgs = FX.order_info_text(batch, ("create_time",)).withColumn("_t", _seconds("create_time"))
    stage_time_slices(msgs, "_t", f"{base}/in", N_SLICES, 1, keep=["value"])
    nation = _t(spark, sf, "nation")

    def change_provinces(version):
        rows = O.province_typed(FX.province_renamed(nation, f"V{version}_"))
        write_version(rows.withColumns({"seq": F.lit(version).cast("long"), "deleted": F.lit(False)}),
                      f"{base}/provinces", version)

    change_provinces(0)
    fn = J.first_order_batch_fn(spark, f"{base}/state", f"{base}/out",
                                J.province_table(spark, f"{base}/provinces"))
    failed = set()

    def fails_once(df, batch_id):
        fn(df, batch_id)
        if batch_id not in failed:
            failed.add(batch_id)
            change_provinces(batch_id + 1)
            raise RuntimeError(f"batch {batch_id} is lost after its write")

    stream = _sliced_stream(spark, f"{base}/in")
    while True:
        query = (stream.writeStream.option("checkpointLocation", f"{base}/ckpt").foreachBatch(fails_once)
                 .trigger(availableNow=True).start())
        try:
            query.awaitTermination()
            break
        except StreamingQueryException as lost:
            if "is lost after its write" not in str(lost):
                raise
    return J.read_flagged_orders(spark, f"{base}/out").select(
        "id", "user_id", "create_time", "if_first_order", "province_name")


def q_stream_dau_hours(spark, sf):
    """A1-A3 kept up to date: every seventh record arrives after all others and
    moves its device-day to an earlier hour; the counts follow."""
    base = shared_path(spark, "stream_dau_hours")
    raw = _late_logs(spark, sf, base)
    J.start_dau(raw, f"{base}/table", f"{base}/ckpt", available_now=True,
                hours_path=f"{base}/hours").awaitTermination()
    return RP.read_hour_counts(spark, f"{base}/hours")


def q_stream_quarantine(spark, sf):
    """Unusable texts in the log, device and detail jobs: as many come out, used
    or quarantined, as go in."""
    base = shared_path(spark, "stream_quarantine")
    logs = FX.app_log_text_dirty(_t(spark, sf, "events"))
    raw = _stream_of(spark, logs, f"{base}/logs")
    routed = _run_topics(spark, R.route_app_log(raw), f"{base}/route")
    J.start_dau(raw, f"{base}/dau", f"{base}/dau_ckpt", available_now=True,
                quarantine_path=f"{base}/dau_bad").awaitTermination()
    details = _stream_of(spark, FX.order_detail_text_dirty(od_rows(spark, sf)), f"{base}/details")
    typed = _run_topics(spark, O.order_detail_topics(details), f"{base}/typed")
    out = [routed.select(F.lit("route").alias("job"), F.col("topic").cast("string").alias("topic")),
           read_versions(spark, f"{base}/dau_bad").select(F.lit("dau").alias("job"), "topic"),
           J.read_dau_table(spark, f"{base}/dau").select(F.lit("dau").alias("job"),
                                                        F.lit("device_days").alias("topic")),
           typed.select(F.lit("detail").alias("job"), F.col("topic").cast("string").alias("topic"))]
    return (out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])
            .groupBy("job", "topic").agg(F.count(F.lit(1)).alias("n")))


def q_cdc_quarantine(spark, sf):
    """Whitelisted envelopes whose data is no array, and texts that are no
    envelope, are quarantined; the others are routed."""
    return R.route_canal(FX.canal_envelopes_dirty(oi_rows(spark, sf)))


def q_dim_province_deleted(spark, sf):
    """K3/Q14: provinces inserted, renamed, deleted and one brought back, by
    change records; folded in between. Orders of a deleted province have none."""
    base = shared_path(spark, "dim_province_deleted")
    changes = R.route_maxwell(FX.province_change_envelopes(_t(spark, sf, "nation")), with_op=True,
                              keep=("seq",))
    stage_time_slices(changes, "seq", f"{base}/in", 4, 1, keep=["value", "op", "seq"], rows_per_file=None)
    stream = file_stream(spark, f"{base}/in", "value string, op string, seq long", 1)
    J.start_dim_province(stream, f"{base}/table", f"{base}/ckpt", available_now=True,
                         compact_every=2).awaitTermination()
    return O.province_enrich(orders_typed(spark, sf), J.read_provinces(spark, f"{base}/table")).select(
        "id", "province_id", "province_name", "province_area_code", "province_3166_2_code")


def q_device_report(spark, sf):
    """A5/D1/R1 from bitmaps: each day's devices, those of the seven days up to
    it, and its new ones; the days come in two versions, some in both."""
    base = shared_path(spark, "device_report")
    dau = cut_lineage(dau_docs(spark, sf).select("dt", "mid"), "device_days")
    day = F.dayofmonth(F.to_date("dt"))
    for version, days in ((0, dau.where(day % 2 == 0)), (1, dau.where((day % 2 == 1) | (day == 10)))):
        known = DV.extend_dictionary(spark, f"{base}/dictionary", days, version)
        write_version(DV.day_bitmaps(days, known), f"{base}/bitmaps", version)
    return DV.device_report(read_versions(spark, f"{base}/bitmaps"))


def q_match_top20_index(spark, sf):
    """F6/T1 by the inverted index: parts indexed with stale names first, then
    changed; the first page of two matches, one of several terms."""
    base = shared_path(spark, "match_top20_index")
    part = _t(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    stale = part.withColumns({"p_name": F.concat(F.lit("red old "), "p_name"),
                              "p_retailprice": -F.col("p_retailprice")})
    for version, docs in ((0, stale), (1, part.where("p_partkey % 3 <> 0")), (2, part.where("p_partkey % 3 = 0")),
                          (3, part.where("p_partkey % 7 = 0"))):
        TI.write_postings(spark, f"{base}/index", docs, "p_partkey", "p_name", "p_retailprice", version)
    pages = [TI.first_page(spark, f"{base}/index", text, part, "p_partkey", "p_retailprice").select(
        F.lit(text).alias("query"), "*") for text in ("red", "Blue, RING")]
    return pages[0].unionByName(pages[1])


def q_parse_app_log_variant(spark, sf):
    """P1/P3 by schema on read: the fields of ``parse_app_log``, array elements
    and deeper ones; texts that are no JSON are marked."""
    logs = FX.app_log_text_nested(_t(spark, sf, "events"))
    return D.parse_app_log_variant(logs, {
        "first_item": "$.displays[0].item", "second_tag": "$.displays[0].tags[1]",
        "absent": "$.displays[7].item"})


def q_stream_order_pipeline(spark, sf):
    """The order job feeding the wide job: ODS orders -> flagged and enriched
    DWD_ORDER_INFO messages keyed by user -> joined with the detail messages."""
    base = shared_path(spark, "stream_order_pipeline")
    orders = cut_small(oi_rows(spark, sf), "order_rows")
    bounds, n_slices = _wide_slices(spark, sf, orders)
    orders = FX.order_info_text(orders, ("create_time",)).withColumn("_t", _seconds("create_time"))
    stage_time_slices(orders, "_t", f"{base}/in", n_slices, FILES_PER_SLICE, bounds=bounds,
                      keep=["value"], lying=True)
    J.start_first_order(_sliced_stream(spark, f"{base}/in"), spark,
                        f"{base}/state", f"{base}/out", f"{base}/ckpt_orders",
                        lambda: provinces(spark, sf), available_now=True,
                        topic_path=f"{base}/dwd").awaitTermination()
    det = O.order_detail_messages(details_typed(spark, sf), ("create_time",)).withColumn(
        "_t", _seconds("create_time"))
    stage_time_slices(det, "_t", f"{base}/detail", n_slices, FILES_PER_SLICE, bounds=bounds,
                      keep=["value"], lying=True)
    info = file_stream(spark, f"{base}/dwd", "topic string, key string, value string",
                       J.TOPIC_PARTITIONS)
    J.start_wide(info.select("value"), _sliced_stream(spark, f"{base}/detail"),
                 f"{base}/wide", f"{base}/ckpt_wide", available_now=True).awaitTermination()
    return spark.read.parquet(f"{base}/wide").select(*W.ORDER_WIDE_COLUMNS)


_REGISTRY: dict[str, Query] = {
    "parse_app_log": q_parse_app_log,
    "route_app_log": q_route_app_log,
    "dau_first_touch": q_dau_first_touch,
    "dau_hour_count": q_dau_hour_count,
    "dau_total": q_dau_total,
    "dau_hour_compare": q_dau_hour_compare,
    "realtime_total": q_realtime_total,
    "dau_distinct_check": q_dau_distinct_check,
    "report_hour_json": q_report_hour_json,
    "report_total_json": q_report_total_json,
    "raw_log_archive": q_raw_log_archive,
    "cdc_route_canal": q_cdc_route_canal,
    "cdc_route_maxwell": q_cdc_route_maxwell,
    "order_info_typed": q_order_info_typed,
    "order_detail_typed": q_order_detail_typed,
    "dim_province_latest": q_dim_province_latest,
    "user_state_lookup": q_user_state_lookup,
    "first_order_flag": q_first_order_flag,
    "first_order_flag_empty_state": q_first_order_flag_empty_state,
    "province_enrich": q_province_enrich,
    "user_state_upsert": q_user_state_upsert,
    "dwd_order_info_messages": q_dwd_order_info_messages,
    "order_wide": q_order_wide,
    "order_wide_dedup": q_order_wide_dedup,
    "order_wide_interval": q_order_wide_interval,
    "sliding_window_counts": q_sliding_window_counts,
    "detail_amount_split": q_detail_amount_split,
    "detail_dims": q_detail_dims,
    "order_user_dim": q_order_user_dim,
    "match_top20": q_match_top20,
    "bulk_upsert_latest": q_bulk_upsert_latest,
    "rows_as_json": q_rows_as_json,
    "dwd_order_detail_messages": q_dwd_order_detail_messages,
    "stream_route_app_log": q_stream_route_app_log,
    "stream_cdc_route_canal": q_stream_cdc_route_canal,
    "stream_cdc_route_maxwell": q_stream_cdc_route_maxwell,
    "stream_dim_province": q_stream_dim_province,
    "stream_dwd_order_detail": q_stream_dwd_order_detail,
    "stream_dau": q_stream_dau,
    "stream_restart": q_stream_restart,
    "stream_first_order": q_stream_first_order,
    "stream_replay": q_stream_replay,
    "stream_order_wide": q_stream_order_wide,
    "stream_dau_late": q_stream_dau_late,
    "dim_province_same_batch": q_dim_province_same_batch,
    "order_info_quarantine": q_order_info_quarantine,
    "stream_redelivery": q_stream_redelivery,
    "stream_order_wide_late": q_stream_order_wide_late,
    "stream_order_pipeline": q_stream_order_pipeline,
    "order_wide_full": q_order_wide_full,
    "stream_sliding_window_counts": q_stream_sliding_window_counts,
    "stream_progress": q_stream_progress,
    "stream_replay_dimension": q_stream_replay_dimension,
    "stream_dau_hours": q_stream_dau_hours,
    "stream_quarantine": q_stream_quarantine,
    "cdc_quarantine": q_cdc_quarantine,
    "dim_province_deleted": q_dim_province_deleted,
    "device_report": q_device_report,
    "match_top20_index": q_match_top20_index,
    "parse_app_log_variant": q_parse_app_log_variant,
}


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimum slice: logs -> parse -> daily dedup -> hour counts."""
    return q_dau_hour_count(spark, sf_dir)
