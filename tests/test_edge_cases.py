"""(d)-(f): hand-made frames for parsing, routing, flags, upsert and reports."""

import pytest
from pyspark.sql import functions as F

from rtmart.operators import dau as D
from rtmart.operators import orders as O
from rtmart.operators import routing as R
from rtmart.operators import search as SE
from rtmart.operators import wide as W
from rtmart.operators.joins import bounded_row_count, broadcast_if_small
from rtmart.operators.upsert import latest_per_key, read_latest, write_version
from rtmart.session import shared_path


def _text(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


# ---------------------------------------------------------------- app log parsing / routing

def test_parse_quarantines_bad_rows(spark):
    raw = _text(spark,
                '{"common":{"mid":"m1","uid":"1"},"ts":1704067200000}',
                '{not json',
                '{"ts":1704067200000}',                       # no common
                '{"common":{"mid":"m2"},"ts":"abc"}',          # ts not numeric
                '{"common":{"mid":"m3"},"ts":"1704067200001"}')  # quoted number is fine
    p = D.parse_app_log(raw)
    good = sorted(r.mid for r in D.valid_logs(p).collect())
    assert good == ["m1", "m3"]
    assert p.where("NOT is_valid").count() == 3


def test_route_start_presence(spark):
    raw = _text(spark,
                '{"common":{"mid":"a"},"start":{"entry":"icon"},"ts":1}',
                '{"common":{"mid":"b"},"start":null,"ts":1}',
                '{"common":{"mid":"c"},"ts":1}')
    odd = ["not json", "", None, "[1]", '"start"', '{"start":{"a":1}', "7"]
    out = R.route_app_log(_text(spark, *odd)).collect()
    assert [r.value for r in out] == odd and {r.topic for r in out} == {"QUARANTINE"}
    routed = R.route_app_log(raw).select(
        "topic", F.get_json_object("value", "$.common.mid").alias("mid"))
    got = {r.mid: r.topic for r in routed.collect()}
    assert got == {"a": "GMALL_START", "b": "GMALL_EVENT", "c": "GMALL_EVENT"}


def test_dau_earliest_record_wins_regardless_of_order(spark):
    rows = [("m1", "u", "0", "ch_late", "1", 1704067300000, 2),
            ("m1", "u", "0", "ch_first", "1", 1704067200000, 9),
            ("m1", "u", "0", "ch_tie", "1", 1704067200000, 10),
            ("m1", "u", "0", "next_day", "1", 1704067200000 + 86400000, 1)]
    logs = spark.createDataFrame(
        rows, "mid string, uid string, ar string, ch string, vc string, ts long, event_id long")
    out = {r.dt: r.ch for r in D.dau_first_touch(logs).collect()}
    assert out == {"2024-01-01": "ch_first", "2024-01-02": "next_day"}
    shuffled = D.dau_first_touch(logs.orderBy(F.rand(7)).repartition(3))
    assert {r.dt: r.ch for r in shuffled.collect()} == out


def test_late_device_counts_for_its_event_day(spark):
    # a device seen today and, arriving later, yesterday: both days count it
    logs = spark.createDataFrame(
        [("m1", "u", "0", "c", "1", 1704153600000 + 5, 1),
         ("m1", "u", "0", "c", "1", 1704067200000 + 5, 2)],
        "mid string, uid string, ar string, ch string, vc string, ts long, event_id long")
    dau = D.dau_first_touch(logs)
    assert sorted(r.dt for r in dau.collect()) == ["2024-01-01", "2024-01-02"]
    rt = {(r.dt, r.id): r.value for r in D.realtime_total(dau).collect()}
    assert rt[("2024-01-01", "new_mid")] == 1 and rt[("2024-01-02", "new_mid")] == 0


def test_hour_compare_and_report_guard(spark):
    dau = spark.createDataFrame(
        [("m1", "2024-01-09", "10"), ("m2", "2024-01-09", "10"), ("m1", "2024-01-10", "11")],
        "mid string, dt string, hr string")
    got = {(r.hr, r.today, r.yesterday)
           for r in D.dau_hour_compare(dau, date="2024-01-10").collect()}
    assert got == {("10", None, 2), ("11", 1, None)}
    assert D.dau_hour_compare(dau, date="2024-01-10", report_id="other").count() == 0
    rep = {r.dt: r.report for r in D.report_hour_json(dau).collect()}
    assert rep["2024-01-10"] == '{"yesterday":{"10":2},"today":{"11":1}}'


def test_day_keys(spark):
    import datetime
    from rtmart.functions import day_key, wall_clock_day_key
    df = spark.createDataFrame([("2024-03-01",)], "d string")
    r = df.select(day_key("d").alias("k"), wall_clock_day_key().alias("w")).first()
    assert r.k == "20240301"
    assert len(r.w) == 8 and r.w[:2] == str(datetime.date.today().year)[:2]


def test_previous_day_rejects_bad_format(spark):
    from rtmart.functions import previous_day
    df = spark.createDataFrame([("2024-03-01",)], "d string")
    assert df.select(previous_day("d").alias("p")).first().p == "2024-02-29"
    bad = spark.createDataFrame([("01/03/2024",)], "d string")
    with pytest.raises(Exception):
        bad.select(previous_day("d")).collect()


# ---------------------------------------------------------------- change data

def test_canal_whitelist_and_explode(spark):
    env = _text(spark,
                '{"data":[{"id":"1"},{"id":"2"}],"table":"order_info","type":"INSERT"}',
                '{"data":[{"id":"3"}],"table":"order_info","type":"UPDATE"}',
                '{"data":[{"id":"4"}],"table":"z_user_info","type":"INSERT"}',
                '{"data":[{"id":"5"}],"table":"order_detail","type":"INSERT"}',
                'garbage')
    out = sorted((r.topic, r.value) for r in R.route_canal(env, with_quarantine=True).collect())
    assert out == [("ODS_ORDER_DETAIL", '{"id":"5"}'), ("ODS_ORDER_INFO", '{"id":"1"}'),
                   ("ODS_ORDER_INFO", '{"id":"2"}'), ("QUARANTINE", "garbage")]


def test_topic_sink_writes_one_folder_per_topic(spark):
    from rtmart.sinks.files import write_topics
    path = shared_path(spark, "t_topics")
    df = spark.createDataFrame([("A", "k1", "v1"), ("B", "k2", "v2"), ("A", "k3", "v3")],
                               "topic string, key string, value string")
    write_topics(df, path)
    back = spark.read.parquet(path)
    assert sorted((r.topic, r.value) for r in back.collect()) == [
        ("A", "v1"), ("A", "v3"), ("B", "v2")]
    assert back.where("topic = 'B'").count() == 1      # partition filter


def test_maxwell_whitelist_types_and_payload_guard(spark):
    env = _text(spark,
                '{"table":"order_info","type":"insert","data":{"id":1}}',
                '{"table":"order_info","type":"update","data":{"id":2}}',
                '{"table":"base_province","type":"delete","data":{"id":"3"}}',
                '{"table":"user_info","type":"update","data":{}}',
                '{"table":"user_info","type":"update","data":null}',
                '{"table":"base_region","type":"insert","data":{"id":"9"}}')
    out = sorted(r.topic for r in R.route_maxwell(env).collect())
    assert out == ["ODS_BASE_PROVINCE", "ODS_ORDER_INFO"]


def test_typed_parse_quoted_bare_and_missing_numbers(spark):
    ods = _text(spark,
                '{"id":"7","user_id":3,"final_total_amount":"12.5","create_time":"2020-07-01 10:11:12"}',
                '{"id":8,"user_id":4,"create_time":"2020-07-01 23:00:00"}',
                '{"id":9,"user_id":"x1","create_time":"2020-07-01 23:00:00"}',
                '{"id":10,"create_time":"2020-07-01 23:00:00"}',
                '{"id":11,"user_id":4,"create_time":"2020-07-01"}', "garbage", "")
    rows = {r.id: r for r in O.order_info_typed(ods).collect()}
    assert rows[7].user_id == 3 and rows[7].final_total_amount == 12.5
    assert rows[7].create_date == "2020-07-01" and rows[7].create_hour == "10"
    assert rows[8].province_id == 0 and rows[8].final_total_amount == 0.0  # primitives default to 0
    assert rows[8].order_status is None
    assert sorted(rows) == [7, 8]          # no user, a bad number, a bad time, no object
    bad = sorted(r.value for r in O.order_info_quarantine(ods).collect())
    assert len(bad) == 5 and bad[0] == "" and bad[1] == "garbage"
    assert {r.topic for r in O.order_info_quarantine(ods).collect()} == {"QUARANTINE"}


# ---------------------------------------------------------------- first order

ORDER_SCHEMA = "id long, user_id long, create_time string, province_id long"


def test_first_order_one_two_three_orders_and_ties(spark):
    batch = spark.createDataFrame([
        (1, 10, "2020-01-01 00:00:05", 1),                                  # alone
        (2, 20, "2020-01-01 00:00:09", 1), (3, 20, "2020-01-01 00:00:01", 1),  # two
        (4, 30, "2020-01-01 00:00:03", 1), (5, 30, "2020-01-01 00:00:03", 1),  # tie -> id
        (6, 30, "2020-01-01 00:00:07", 1),
    ], ORDER_SCHEMA)
    got = {r.id: r.if_first_order for r in O.first_order_flag(batch).collect()}
    assert got == {1: "1", 2: "0", 3: "1", 4: "1", 5: "0", 6: "0"}


def test_first_order_against_state(spark):
    batch = spark.createDataFrame([(1, 10, "2020-01-01 00:00:05", 1),
                                   (2, 11, "2020-01-01 00:00:06", 1)], ORDER_SCHEMA)
    state = spark.createDataFrame([("10", "1")], "user_id string, if_consumed string")
    got = {r.id: r.if_first_order for r in O.first_order_flag(batch, state).collect()}
    assert got == {1: "0", 2: "1"}
    look = {r.user_id: r.if_consumed for r in O.user_state_lookup(batch, state).collect()}
    assert look == {10: "1", 11: "0"}
    assert [r.user_id for r in O.new_user_state(batch, state).collect()] == ["11"]


def test_province_missing_and_updated_between_batches(spark):
    orders = spark.createDataFrame([(1, 10, "t", 1), (2, 11, "t", 99)], ORDER_SCHEMA)
    v = spark.createDataFrame([
        (1, 1, '{"id":"1","name":"OLD","area_code":"a","iso_code":"x","iso_3166_2":"y"}'),
        (2, 1, '{"id":"1","name":"NEW","area_code":"a","iso_code":"x","iso_3166_2":"y"}')],
        "batch_id long, seq long, value string")
    prov = O.province_latest(v)
    got = {r.id: r.province_name for r in O.province_enrich(orders, prov).collect()}
    assert got == {1: "NEW", 2: None}


# ---------------------------------------------------------------- upsert / versions

def test_latest_per_key_with_deletes(spark):
    df = spark.createDataFrame([("k1", 1, "a", False), ("k1", 2, "b", False),
                                ("k2", 1, "c", False), ("k2", 3, "d", True)],
                               "k string, v long, x string, deleted boolean")
    got = {r.k: r.x for r in latest_per_key(df, ["k"], ["v"], deleted_col="deleted").collect()}
    assert got == {"k1": "b"}


def test_same_batch_id_twice_is_idempotent(spark):
    path = shared_path(spark, "t_versions")
    rows = spark.createDataFrame([("u1", "1")], "user_id string, if_consumed string")
    write_version(rows, path, 3)
    write_version(rows, path, 3)
    assert read_latest(spark, path, ["user_id"], []).count() == 1
    assert spark.read.parquet(path).count() == 1


def test_compaction_keeps_latest_and_drops_old_versions(spark):
    from rtmart.operators.upsert import compact
    path = shared_path(spark, "t_compact")
    schema = "user_id string, if_consumed string"
    write_version(spark.createDataFrame([("u1", "0"), ("u2", "1")], schema), path, 0)
    write_version(spark.createDataFrame([("u1", "1")], schema), path, 1)
    write_version(spark.createDataFrame([("u3", "1")], schema), path, 2)
    compact(spark, path, ["user_id"], [], at=2)        # folds versions 0 and 1
    got = {r.user_id: (r.if_consumed, r.batch_id)
           for r in read_latest(spark, path, ["user_id"], []).collect()}
    assert got == {"u1": ("1", 2), "u2": ("1", 2), "u3": ("1", 2)}
    # what batch 2 builds on (a replay of it) is exactly the folded base
    prior = {r.user_id: r.if_consumed
             for r in read_latest(spark, path, ["user_id"], [], before=2).collect()}
    assert prior == {"u1": "1", "u2": "1"}
    compact(spark, path, ["user_id"], [], at=2)        # re-run after a crash: same
    assert read_latest(spark, path, ["user_id"], []).count() == 3


def test_incremental_fold_keeps_older_segments(spark):
    from rtmart.operators.upsert import compact, compaction_plan, drop_folded
    path = shared_path(spark, "t_segments")
    schema = "k string, x string"
    for b, rows in enumerate([[("a", "0")], [("b", "1")], [("a", "2")], [("c", "3")],
                              [("b", "4")]]):
        write_version(spark.createDataFrame(rows, schema), path, b)
    compact(spark, path, ["k"], [], at=2)                 # full base at 2: a=0, b=1
    compact(spark, path, ["k"], [], at=4, since=2)        # segment at 4: a=2, c=3
    drop_folded(spark, path, before=5)                    # as a next fold would
    dirs = sorted((r.batch_id, r.kind) for r in
                  spark.read.parquet(path).select("batch_id", "kind").distinct().collect())
    assert dirs == [(2, "base"), (4, "base"), (4, "delta")]
    got = {r.k: r.x for r in read_latest(spark, path, ["k"], []).collect()}
    assert got == {"a": "2", "b": "4", "c": "3"}
    before4 = {r.k: r.x for r in read_latest(spark, path, ["k"], [], before=4).collect()}
    assert before4 == {"a": "2", "b": "1", "c": "3"}
    assert compaction_plan(100, 50, 1000) == (True, 50)
    assert compaction_plan(1000, 50, 1000) == (True, None)
    assert compaction_plan(101, 50, 1000) == (False, None)


def test_broadcast_only_with_proven_bound(spark):
    small = spark.range(10)
    assert bounded_row_count(small, 5) == 6
    plan_small = small.join(broadcast_if_small(spark.range(5), 100), "id")._jdf \
        .queryExecution().executedPlan().toString()
    assert "Broadcast" in plan_small
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()
    assert not hinted(broadcast_if_small(spark.range(500), 100))      # over the row bound
    assert not hinted(broadcast_if_small(spark.range(5), 100, max_bytes=1))  # estimate too big
    assert hinted(broadcast_if_small(spark.range(5), 100))


# ---------------------------------------------------------------- wide / lookup

def test_wide_dedups_window_repeats_and_detail_duplicates(spark):
    info = spark.createDataFrame(
        [(1, "S", "2020-01-01 00:00:00", 5, 1.0, 2.0, 3.0, 4.0, "1", "p", "a", "2020-01-01")],
        "id long, order_status string, create_time string, user_id long, "
        "benefit_reduce_amount double, feight_fee double, original_total_amount double, "
        "final_total_amount double, if_first_order string, province_name string, "
        "province_area_code string, create_date string")
    det = spark.createDataFrame(
        [(101, 1, 7, 9.5, 2, "s", "2020-01-01 00:00:04"),
         (101, 1, 7, 9.5, 2, "s", "2020-01-01 00:00:04"),      # duplicate delivery
         (102, 1, 8, 1.5, 1, "t", "2020-01-01 00:00:14"),      # two batches later: joined
         (103, 1, 9, 1.5, 1, "u", "2020-01-01 00:00:15")],     # three batches later: not
        "id long, order_id long, sku_id long, order_price double, sku_num long, "
        "sku_name string, create_time string")
    got = sorted(r.order_detail_id for r in W.order_wide_windowed(info, det).collect())
    assert got == [101, 102]


def test_amount_split_conserves_cents(spark):
    info = spark.createDataFrame([(1, 10.0), (2, 0.01)], "id long, final_total_amount double")
    det = spark.createDataFrame([(11, 1, 3.0, 1), (12, 1, 3.0, 1), (13, 1, 3.0, 1),
                                 (21, 2, 5.0, 1), (22, 2, 5.0, 1)],
                                "id long, order_id long, order_price double, sku_num long")
    got = {r.order_detail_id: r.cents for r in W.detail_amount_split(info, det).collect()}
    assert got == {11: 333, 12: 333, 13: 334, 21: 0, 22: 1}


def test_amount_split_of_very_large_amounts(spark):
    info = spark.createDataFrame([(1, 5e7)], "id long, final_total_amount double")
    det = spark.createDataFrame([(11, 1, 1e6, 100_000), (12, 1, 1e6, 100_000)],
                                "id long, order_id long, order_price double, sku_num long")
    got = {r.order_detail_id: r.cents for r in W.detail_amount_split(info, det).collect()}
    assert got == {11: 2_500_000_000, 12: 2_500_000_000}


def test_full_wide_row_is_shuffled_by_order_once(spark):
    """The lines are not shuffled again, wide, to meet their shares."""
    info = spark.createDataFrame(
        [(k, 10.0) for k in range(40)], "id long, final_total_amount double")
    for c in ("order_status create_time user_id benefit_reduce_amount feight_fee original_total_amount "
              "if_first_order province_name province_area_code create_date user_age_group user_gender").split():
        info = info.withColumn(c, F.lit("x"))
    det = spark.createDataFrame([(10 * k + j, k, float(j + 1), 1) for k in range(40) for j in range(3)],
                                "id long, order_id long, order_price double, sku_num long")
    for c in W.FULL_DETAIL_COLUMNS:
        if c not in det.columns:
            det = det.withColumn(c, F.concat(F.lit(c), F.col("id").cast("string")))
    out = W.order_wide_full(info, W.detail_amount_split(info, det, W.FULL_DETAIL_COLUMNS, stored=True))
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = out.select("*")._jdf.queryExecution().executedPlan().toString()
        shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
        rows = out.collect()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert shuffles and not any("order_detail_id" in x.split("hashpartitioning(")[1].split("),")[0]
                                for x in shuffles), shuffles
    assert len(rows) == 120
    assert {r.order_detail_id: r.final_detail_amount for r in rows if r.order_id == 7} == \
        {70: 1.66, 71: 3.33, 72: 5.01}


def test_last_change_of_a_dimension_row_wins(spark):
    from rtmart.operators import dims as DM
    ods = spark.createDataFrame([('{"id":"1","tm_name":"Zed"}', 1), ('{"id":"1","tm_name":"Acme"}', 2),
                                 ("bad", 3)], "value string, seq long")
    got = DM.dim_latest(ods, DM.TRADEMARK_FIELDS, ["seq"]).collect()
    assert [(r.id, r.tm_name) for r in got] == [(1, "Acme")]
    with pytest.raises(ValueError):
        DM.dim_latest(ods, DM.TRADEMARK_FIELDS, [])


def test_match_analyses_text(spark):
    df = spark.createDataFrame([(1, "Red Widget", 3.0), (2, "dark-red bolt", 1.0),
                                (3, "reddish", 0.5), (4, None, 0.1)],
                               "k long, name string, price double")
    got = [r.k for r in SE.match_sorted(df, "name", "RED!", "price", "k").collect()]
    assert got == [2, 1]
    assert SE.match_terms("  ") == []


def test_kafka_options_and_missing_connector(spark):
    from rtmart.sources.streams import kafka_sink_options, kafka_stream
    assert kafka_sink_options("b:9092") == {"kafka.bootstrap.servers": "b:9092"}
    with pytest.raises(Exception, match="(?i)kafka"):      # no connector jar in this image
        kafka_stream(spark, "GMALL_START", "b:9092")


def test_cluster_without_checkpoint_dir_is_refused():
    from types import SimpleNamespace
    from rtmart.session import ensure_checkpoint_dir
    unset = SimpleNamespace(isDefined=lambda: False)
    jsc = SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: unset))
    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None),
                            sparkContext=SimpleNamespace(master="yarn", _jsc=jsc))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(spark)


def test_configured_checkpoint_dir_is_used(spark):
    from rtmart.session import ensure_checkpoint_dir
    configured = spark.conf.get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark) == configured
    assert shared_path(spark, "x").startswith(configured.rstrip("/") + "/x-")
