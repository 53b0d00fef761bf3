"""(b)-(e) streaming: equal to batch, compaction inside a running stream,
shuffled arrival for the device dedup."""

import pytest
from pyspark.sql import functions as F

from rtmart.operators import orders as O
from rtmart.plans import registry as G
from rtmart.session import shared_path
from rtmart.sources.streams import file_stream
from rtmart.streaming import jobs as J
from rtmart.streaming.staging import stage_time_slices


def test_first_order_stream_with_compaction_equals_batch(spark, sf_small):
    base = shared_path(spark, "t_stream_compact")
    stream = G._stage_order_batch(spark, sf_small, base)
    J.start_first_order(stream, spark, f"{base}/state", f"{base}/out", f"{base}/ckpt",
                        lambda: G.provinces(spark, sf_small), available_now=True,
                        compact_every=2).awaitTermination()
    got = J.read_flagged_orders(spark, f"{base}/out").select("id", "if_first_order")
    state, batch = G.state_and_batch(spark, sf_small)
    want = O.first_order_flag(batch, state).select("id", "if_first_order")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0
    versions = {r.batch_id for r in spark.read.parquet(f"{base}/state")
                .select("batch_id").distinct().collect()}
    assert 0 not in versions            # folded at version 2, dropped at version 4
    kinds = {(r.batch_id, r.kind) for r in spark.read.parquet(f"{base}/out")
             .select("batch_id", "kind").distinct().collect()}
    assert (2, "base") in kinds and (1, "delta") not in kinds   # output deltas folded


def test_dau_stream_does_not_depend_on_arrival_order(spark, sf_small):
    base = shared_path(spark, "t_stream_shuffled")
    cols = G.FX.app_log_columns(G._t(spark, sf_small, "events"))
    msgs = cols.select(G.to_json_row("common", "start", "ts", "event_id").alias("value"),
                       # arrival order unrelated to event time
                       (F.xxhash64("event_id") % 1000).alias("_arrival"))
    stage_time_slices(msgs, "_arrival", f"{base}/in", 4, 2, keep=["value"])
    raw = file_stream(spark, f"{base}/in", "value string", 2)
    J.start_dau(raw, f"{base}/table", f"{base}/ckpt", available_now=True).awaitTermination()
    got = J.read_dau_table(spark, f"{base}/table")
    want = G.dau_docs(spark, sf_small)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_first_order_follows_arrival_across_batches(spark):
    """D3 keeps the reference's meaning: the first order to *arrive* wins; a
    later batch holding an earlier create_time gets '0' (SURVEY 7.5 point 2)."""
    base = shared_path(spark, "t_arrival")
    prov = spark.createDataFrame([("1", "P", "a", "x", "y")],
                                 "id string, name string, area_code string, iso_code string, "
                                 "iso_3166_2 string")
    fn = J.first_order_batch_fn(spark, f"{base}/state", f"{base}/out", lambda: prov)
    late = spark.createDataFrame(
        [('{"id":"2","user_id":"7","province_id":"1","create_time":"2020-01-02 00:00:00"}',)],
        "value string")
    early = spark.createDataFrame(
        [('{"id":"1","user_id":"7","province_id":"1","create_time":"2020-01-01 00:00:00"}',)],
        "value string")
    fn(late, 0)
    fn(early, 1)
    fn(early, 1)                       # replay of batch 1: same result
    got = {r.id: r.if_first_order for r in J.read_flagged_orders(spark, f"{base}/out").collect()}
    assert got == {2: "1", 1: "0"}


def test_one_day_read_of_the_dau_table_prunes_other_days(spark, sf_small):
    from rtmart.operators import dau as D
    base = shared_path(spark, "t_dau_prune")
    G._stage_app_logs(spark, sf_small, f"{base}/in")
    raw = file_stream(spark, f"{base}/in", "value string", G.FILES_PER_SLICE)
    J.start_dau(raw, f"{base}/table", f"{base}/ckpt", available_now=True).awaitTermination()
    day = J.read_dau_table(spark, f"{base}/table", date="2024-01-10")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-10" in plan
    want = G.dau_docs(spark, sf_small).where("dt = '2024-01-10'")
    assert day.exceptAll(want).count() == 0 and day.count() == want.count()
    total = D.dau_total(J.read_dau_table(spark, f"{base}/table"), "2024-01-10").first()
    assert total.dau_total == want.count() and total.day_key == "20240110"


def test_salted_stream_join_equals_unsalted_for_a_hot_order(spark):
    from rtmart.functions import to_json_row
    from rtmart.operators import wide as W
    base = shared_path(spark, "t_salt")
    info = spark.createDataFrame(
        [(1, "S", "2020-01-01 00:00:00", 5, 1.0, 2.0, 3.0, 4.0, "1", "p", "a", "2020-01-01"),
         (2, "S", "2020-01-01 00:00:30", 6, 1.0, 2.0, 3.0, 4.0, "1", "p", "a", "2020-01-01")],
        "id long, order_status string, create_time string, user_id long, "
        "benefit_reduce_amount double, feight_fee double, original_total_amount double, "
        "final_total_amount double, if_first_order string, province_name string, "
        "province_area_code string, create_date string")
    # order 1 is hot: 300 lines; order 2 has one
    rows = [(1000 + k, 1, k, 1.5, 1, "s", f"2020-01-01 00:00:{k % 12:02d}") for k in range(300)]
    rows.append((5000, 2, 9, 2.5, 1, "t", "2020-01-01 00:00:35"))
    det = spark.createDataFrame(rows, "id long, order_id long, sku_id long, order_price double, "
                                      "sku_num long, sku_name string, create_time string")
    want = W.order_wide_interval(info, det, bound_s=10)
    results = []
    for salts in (1, 4):
        b = f"{base}/s{salts}"
        info.select(to_json_row(*info.columns).alias("value")).write.parquet(f"{b}/info")
        det.select(to_json_row(*det.columns).alias("value")).write.parquet(f"{b}/det")
        i = file_stream(spark, f"{b}/info", "value string")
        d = file_stream(spark, f"{b}/det", "value string")
        J.start_wide(i, d, f"{b}/wide", f"{b}/ckpt", available_now=True,
                     salts=salts).awaitTermination()
        results.append(spark.read.parquet(f"{b}/wide"))
    for got in results:
        assert got.count() == want.count() == 276     # 300 * 11/12 + 1
        assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_dau_table_compaction_keeps_the_result(spark, sf_small):
    base = shared_path(spark, "t_dau_compact")
    G._stage_app_logs(spark, sf_small, f"{base}/in")
    raw = file_stream(spark, f"{base}/in", "value string", G.FILES_PER_SLICE)  # slice/batch
    J.start_dau(raw, f"{base}/table", f"{base}/ckpt", available_now=True,
                compact_every=2).awaitTermination()
    got = J.read_dau_table(spark, f"{base}/table")
    want = G.dau_docs(spark, sf_small)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0
    kinds = {(r.batch_id, r.kind) for r in spark.read.parquet(f"{base}/table")
             .select("batch_id", "kind").distinct().collect()}
    assert (2, "base") in kinds


def test_order_stream_reads_the_province_table_of_the_dimension_stream(spark, sf_small):
    base = shared_path(spark, "t_compose")
    dim_in = G._stream_of(spark, G._province_changes(spark, sf_small), f"{base}/dim",
                          time_col="batch_id", n_slices=2, more=["seq"])
    J.start_dim_province(dim_in, f"{base}/province", f"{base}/ckpt_dim",
                         available_now=True).awaitTermination()
    orders = G._stage_order_batch(spark, sf_small, f"{base}/orders")
    J.start_first_order(orders, spark, f"{base}/orders/state", f"{base}/orders/out",
                        f"{base}/ckpt_orders",
                        lambda: J.read_provinces(spark, f"{base}/province"),
                        available_now=True).awaitTermination()
    got = J.read_flagged_orders(spark, f"{base}/orders/out").select(
        "id", "if_first_order", "province_name")
    state, batch = G.state_and_batch(spark, sf_small)
    want = O.province_enrich(O.first_order_flag(batch, state), G.provinces(spark, sf_small)) \
        .select("id", "if_first_order", "province_name")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0
    assert got.where("province_name IS NULL").count() == 0


def test_raw_text_log_files_stream_and_preview(spark, sf_small):
    """Raw log lines as text files -> stream -> routed topics; K5 preview."""
    from rtmart.operators import routing as R
    from rtmart.sources.streams import text_log_stream
    base = shared_path(spark, "t_textlogs")
    G.app_log_raw(spark, sf_small).write.text(f"{base}/logs")
    raw = text_log_stream(spark, f"{base}/logs", files_per_trigger=2)
    got = G._run_topics(spark, R.route_app_log(raw), base)
    want = G.q_route_app_log(spark, sf_small)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0
    q = J.start_preview(text_log_stream(spark, f"{base}/logs"), rows=3, available_now=True)
    q.awaitTermination()            # the console output is the JVM's own stdout
    assert sum(p["numInputRows"] for p in q.recentProgress) == want.count()


def test_new_devices_matches_realtime_total(spark, sf_small):
    from rtmart.operators import dau as D, devices as DV
    dau = G.dau_docs(spark, sf_small)
    known = DV.numbered(dau, None)
    bitmaps = DV.day_bitmaps(dau, known)
    nd = {r.dt: r.new_mid for r in DV.new_devices(bitmaps).collect() if r.new_mid}
    rt = {r.dt: r.value for r in D.realtime_total(dau).where("id = 'new_mid'").collect()}
    assert {d: v for d, v in rt.items() if v} == nd


def _log(ts, mid="d1", event=1):
    return (f'{{"common":{{"mid":"{mid}","uid":"u","ar":"a","ch":"c","vc":"1"}},'
            f'"ts":{ts},"event_id":{event}}}',)


def test_dau_stream_follows_the_session_zone_and_keeps_late_records(spark):
    """Half past midnight in Shanghai is a day of its own, and a record that
    arrives 16 days late still counts (D1)."""
    from rtmart.operators import dau as D
    base = shared_path(spark, "t_dau_zone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        late_evening, after_midnight = 1704123000000, 1704126600000    # 23:30, 00:30
        old = late_evening - 16 * 86_400_000
        batches = [[_log(late_evening)], [_log(after_midnight, event=2)], [_log(old, event=3)]]
        for k, rows in enumerate(batches):
            spark.createDataFrame(rows, "value string").write.parquet(f"{base}/in/{k}")
        raw = file_stream(spark, f"{base}/in", "value string", 1)
        J.start_dau(raw, f"{base}/table", f"{base}/ckpt", available_now=True).awaitTermination()
        got = sorted((r.dt, r.hr, r.mi) for r in J.read_dau_table(spark, f"{base}/table").collect())
        logs = spark.createDataFrame([x for b in batches for x in b], "value string")
        want = sorted((r.dt, r.hr, r.mi) for r in
                      D.dau_first_touch(D.valid_logs(D.parse_app_log(logs))).collect())
        assert got == want == [("2023-12-16", "23", "30"), ("2024-01-01", "23", "30"),
                               ("2024-01-02", "00", "30")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _province(name):
    return ('{"id":"1","name":"%s","area_code":"a","iso_code":"x","iso_3166_2":"y"}' % name)


def test_last_province_change_of_a_batch_wins(spark):
    base = shared_path(spark, "t_prov_last")
    rows = [(_province("Zeta-old"), 0, 7), (_province("Alpha-new"), 0, 8),
            ("no json", 0, 9)]
    spark.createDataFrame(rows, "value string, partition int, offset long") \
        .write.parquet(f"{base}/in")
    stream = file_stream(spark, f"{base}/in", "value string, partition int, offset long")
    J.start_dim_province(stream, f"{base}/table", f"{base}/ckpt", available_now=True,
                         quarantine_path=f"{base}/bad").awaitTermination()
    assert [r.name for r in J.read_provinces(spark, f"{base}/table").collect()] == ["Alpha-new"]
    assert [r.value for r in spark.read.parquet(f"{base}/bad").collect()] == ["no json"]
    plain = file_stream(spark, f"{base}/in", "value string")
    with pytest.raises(ValueError):
        J.start_dim_province(plain, f"{base}/t2", f"{base}/c2")


def test_redelivered_order_keeps_its_flag_and_garbage_is_set_aside(spark):
    base = shared_path(spark, "t_again")
    prov = spark.createDataFrame([("1", "P", "a", "x", "y")],
                                 "id string, name string, area_code string, iso_code string, "
                                 "iso_3166_2 string")
    fn = J.first_order_batch_fn(spark, f"{base}/state", f"{base}/out", lambda: prov,
                                topic_path=f"{base}/topic", quarantine_path=f"{base}/bad",
                                compact_every=2)
    order = '{"id":"2","user_id":"7","province_id":"1","create_time":"2020-01-02 00:00:00"}'
    fn(spark.createDataFrame([(order,), ("garbage",)], "value string"), 0)
    for batch in range(1, 5):                    # over two folds of the output
        fn(spark.createDataFrame([(order,)], "value string"), batch)
    assert [(r.id, r.if_first_order) for r in
            J.read_flagged_orders(spark, f"{base}/out").collect()] == [(2, "1")]
    assert [r.value for r in spark.read.parquet(f"{base}/bad").collect()] == ["garbage"]
    assert {r.user_id for r in spark.read.parquet(f"{base}/state").collect()} == {"7"}
    first = spark.read.parquet(f"{base}/topic/batch_id=1").collect()
    assert [r.key for r in first] == ["7"] and '"if_first_order":"1"' in first[0].value


def test_folded_versions_outlive_their_fold_by_one_period(spark):
    from rtmart.operators.upsert import compact, read_latest, write_version
    path = shared_path(spark, "t_grace")
    schema = "k string, x string"
    for b in range(4):
        write_version(spark.createDataFrame([("a", str(b))], schema), path, b)
    reader = read_latest(spark, path, ["k"], [])         # lists files now
    compact(spark, path, ["k"], [], at=2)
    assert [r.x for r in reader.collect()] == ["3"]       # its files are still there
    compact(spark, path, ["k"], [], at=4)
    left = {r.batch_id for r in spark.read.parquet(path).select("batch_id").distinct().collect()}
    assert 0 not in left and 1 not in left and 4 in left
    assert [r.x for r in read_latest(spark, path, ["k"], []).collect()] == ["3"]


def test_micro_batches_run_on_the_five_second_trigger(spark):
    """A continuous run picks up files that arrive after the start."""
    import time
    base = shared_path(spark, "t_trigger")
    spark.createDataFrame([_log(1704123000000)], "value string").write.parquet(f"{base}/in/0")
    raw = file_stream(spark, f"{base}/in", "value string", 1)
    q = J.start_dau(raw, f"{base}/table", f"{base}/ckpt")
    try:
        def wait_for(n):
            end = time.time() + 60
            while sum(p["numInputRows"] for p in q.recentProgress) < n and time.time() < end:
                time.sleep(0.5)
            return sum(p["numInputRows"] for p in q.recentProgress)
        assert wait_for(1) == 1
        spark.createDataFrame([_log(1704123000000, "d2")], "value string") \
            .write.parquet(f"{base}/in/1")
        assert wait_for(2) == 2
        starts = [p["timestamp"] for p in q.recentProgress]
        assert len(starts) >= 2 and all(s[17:19].isdigit() and int(s[17:19]) % 5 == 0
                                        for s in starts[1:])
    finally:
        q.stop()
    assert J.read_dau_table(spark, f"{base}/table").count() == 2


def test_stream_join_keeps_details_that_share_an_id_across_orders(spark):
    """The key of a detail is (order, detail), and an order may have
    hundreds of lines."""
    from rtmart.functions import to_json_row
    from rtmart.operators import wide as W
    base = shared_path(spark, "t_pair_key")
    info = spark.createDataFrame(
        [(k, "S", "2020-01-01 00:00:00", 5, 1.0, 2.0, 3.0, 4.0, "1", "p", "a", "2020-01-01")
         for k in (5, 6)],
        "id long, order_status string, create_time string, user_id long, "
        "benefit_reduce_amount double, feight_fee double, original_total_amount double, "
        "final_total_amount double, if_first_order string, province_name string, "
        "province_area_code string, create_date string")
    rows = [(n, o, n, 1.5, 1, "s", "2020-01-01 00:00:01") for o in (5, 6) for n in range(150)]
    det = spark.createDataFrame(rows, "id long, order_id long, sku_id long, order_price double, "
                                      "sku_num long, sku_name string, create_time string")
    info.select(to_json_row(*info.columns).alias("value")).write.parquet(f"{base}/info")
    det.select(to_json_row(*det.columns).alias("value")).write.parquet(f"{base}/det")
    q = J.start_wide(file_stream(spark, f"{base}/info", "value string"),
                     file_stream(spark, f"{base}/det", "value string"),
                     f"{base}/wide", f"{base}/ckpt", available_now=True)
    q.awaitTermination()
    got = spark.read.parquet(f"{base}/wide")
    assert got.count() == 300 == W.order_wide_windowed(info, det).count()
    assert sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"]) == 0
