"""Replays with a pinned dimension, durable progress, late rows, tombstones,
counts that follow moved device-days, bitmaps and the inverted index."""

import json

import pytest
from pyspark.sql import functions as F

from rtmart.functions import to_json_row
from rtmart.operators import asof as A, dau as D, devices as DV, orders as O, routing as R
from rtmart.operators import search as SE, text_index as TI, upsert as U, wide as W
from rtmart.session import shared_path
from rtmart.sources import fixtures as FX
from rtmart.sources.streams import file_stream, with_headers
from rtmart.streaming import jobs as J, late as LT, progress as PG, reports as RP

PROVINCE = "id string, name string, area_code string, iso_code string, iso_3166_2 string"


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


# ---------------------------------------------------------------- as-of reads and pins

def provinces(spark, path, version, name, deleted=False):
    rows = spark.createDataFrame([("1", name, "a", "x", "y", version, deleted)],
                                 PROVINCE + ", seq long, deleted boolean")
    U.write_version(rows, path, version)


def test_a_replayed_batch_reads_the_dimension_it_read_first(spark):
    base = shared_path(spark, "t_pin")
    provinces(spark, f"{base}/dim", 0, "OLD")
    fn = J.first_order_batch_fn(spark, f"{base}/state", f"{base}/out", J.province_table(spark, f"{base}/dim"),
                                topic_path=f"{base}/topic")
    order = '{"id":"%d","user_id":"7","province_id":"1","create_time":"2020-01-0%d 00:00:00"}'
    fn(texts(spark, order % (1, 1)), 0)

    def files():
        return sorted(f.rsplit("/", 1)[1] for f in spark.read.parquet(f"{base}/topic").inputFiles())

    first = files()
    provinces(spark, f"{base}/dim", 1, "NEW")
    fn(texts(spark, order % (1, 1)), 0)                       # the replay
    assert files() == first                                  # a file stream finds nothing new
    fn(texts(spark, order % (2, 2)), 1)                       # the next batch
    got = {r.id: r.province_name for r in J.read_flagged_orders(spark, f"{base}/out").collect()}
    assert got == {1: "OLD", 2: "NEW"}
    values = sorted(json.loads(r.value)["province_name"] for r in spark.read.parquet(f"{base}/topic").collect())
    assert values == ["NEW", "OLD"]


def test_a_batch_before_the_first_dimension_version_stays_without(spark):
    base = shared_path(spark, "t_pin_none")
    fn = J.first_order_batch_fn(spark, f"{base}/state", f"{base}/out", J.province_table(spark, f"{base}/dim"))
    order = '{"id":"1","user_id":"7","province_id":"1","create_time":"2020-01-01 00:00:00"}'
    for _ in range(2):
        fn(texts(spark, order), 0)
        assert [r.province_name for r in J.read_flagged_orders(spark, f"{base}/out").collect()] == [None]
        provinces(spark, f"{base}/dim", 0, "LATER")


def test_as_of_reads_through_folds_and_refuse_what_is_gone(spark):
    path = shared_path(spark, "t_asof")
    for v in range(6):
        provinces(spark, path, v, f"v{v}", deleted=v == 3)
    table = J.province_table(spark, path)
    name = lambda v: [r.name for r in table.as_of(v).collect()]
    assert table.version() == 5 and table.as_of(None) is None
    assert [name(v) for v in range(6)] == [["v0"], ["v1"], ["v2"], [], ["v4"], ["v5"]]
    U.compact(spark, path, ["id"], ["seq"], at=4)
    assert [name(v) for v in (1, 3, 4, 5)] == [["v1"], [], ["v4"], ["v5"]]     # still there for a period
    for v in (6, 7, 8):
        provinces(spark, path, v, f"v{v}")
    U.compact(spark, path, ["id"], ["seq"], at=8)
    with pytest.raises(ValueError, match="as of version 4"):
        name(2)
    assert name(5) == ["v5"] and name(8) == ["v8"]


def test_pins_are_kept_once_and_only_the_last_ones(spark, monkeypatch):
    path = shared_path(spark, "t_pins")
    monkeypatch.setattr(A, "KEPT_PINS", 3)
    for b in range(6):
        assert A.pinned(spark, path, b, lambda: {"v": b}) == {"v": b}
        assert A.pinned(spark, path, b, lambda: pytest.fail("asked again")) == {"v": b}
    assert A.read_pin(spark, path, 2) is None and A.read_pin(spark, path, 3) == {"v": 3}
    assert A.last_pin(spark, path, 5) == {"v": 4} and A.last_pin(spark, path, 3) is None


def test_an_unfinished_version_is_not_the_newest_and_is_written_again(spark):
    path = shared_path(spark, "t_once")
    rows = texts(spark, "a")
    U.write_version_once(rows, path, 0)
    _, root, fs = U.file_system(spark, path)
    jvm = spark.sparkContext._jvm
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=1/kind=delta"))
    assert A.newest_version(spark, path) == 0
    U.write_version_once(rows, path, 1)
    U.write_version_once(texts(spark, "other"), path, 1)       # complete: stays
    assert U.version_numbers(spark, path) == [0, 1]
    assert [r.value for r in U.read_versions(spark, path).collect()] == ["a", "a"]


# ---------------------------------------------------------------- durable progress

def _small_files(spark, base, first, n):
    for k in range(first, first + n):
        texts(spark, f"{k}", f"{k}b").coalesce(1).write.parquet(f"{base}/in/{k:03d}")


def _run_topics(spark, base):
    stream = file_stream(spark, f"{base}/in", "value string", 1)
    return J.start_topic_stream(stream.select(F.lit("T").alias("topic"), "value"), f"{base}/topics",
                                f"{base}/ckpt", available_now=True)


def test_every_range_is_recorded_once_over_restarts_and_folds(spark):
    base = shared_path(spark, "t_progress")
    for part in (0, 7):
        _small_files(spark, base, part, 7)
        log = PG.ProgressLog(spark, f"{base}/log", fold_every=5).attach(f"{base}/ckpt")
        query = _run_topics(spark, base)
        query.awaitTermination()
        log.detach(query)
    offsets = PG.batch_offsets(spark, f"{base}/log")
    full = offsets.where("rows > 0")
    assert full.count() == 14 and full.agg(F.sum("rows")).first()[0] == 28
    assert PG.uncovered(full).count() == 0 and PG.late_rows(offsets) == 0
    assert offsets.select("query").distinct().count() == 1
    names = log._names(str(query.id))
    assert any(n.startswith("batches-") for n in names) and len(names) < 14
    # a gap is found
    assert PG.uncovered(full.where("batch_id <> 4")).count() == 1


def test_batches_without_a_report_are_taken_from_the_checkpoint(spark):
    base = shared_path(spark, "t_progress_lost")
    _small_files(spark, base, 0, 4)
    _run_topics(spark, base).awaitTermination()               # nobody listens
    log = PG.ProgressLog(spark, f"{base}/log").attach(f"{base}/ckpt")
    log.detach()
    offsets = PG.batch_offsets(spark, f"{base}/log")
    assert sorted(r.batch_id for r in offsets.collect()) == [0, 1, 2, 3]
    assert PG.uncovered(offsets).count() == 0
    assert all(r.end_offset and r.rows is None for r in offsets.collect())


# ---------------------------------------------------------------- late rows

def _at(second):
    return f"2020-01-01 {second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}"


INFO = "id long, create_time string, user_id long, create_date string"
DETAIL = "id long, order_id long, sku_id long, order_price double, sku_num long, sku_name string, create_time string"


def infos(spark, *rows):
    return spark.createDataFrame([(i, _at(t), 5, "2020-01-01") for i, t in rows], INFO).select(
        to_json_row("id", "create_time", "user_id", "create_date").alias("value"))


def details(spark, *rows):
    frame = spark.createDataFrame([(i, o, 1, 1.5, 1, "s", _at(t)) for i, o, t in rows], DETAIL)
    return frame.select(to_json_row(*frame.columns).alias("value"))


def seconds():
    return F.unix_timestamp(F.to_timestamp(F.get_json_object("value", "$.create_time"), "yyyy-MM-dd HH:mm:ss"))


def test_batches_are_cut_at_the_bound_of_those_before_them(spark):
    base = shared_path(spark, "t_split")
    batches = [infos(spark, (1, 5000), (2, 10)), infos(spark, (3, 4990), (4, 4899), (5, 4900)),
               texts(spark, "no time"), infos(spark, (6, 9000)), infos(spark, (7, 8000), (8, 8950))]
    for k, rows in enumerate(batches):
        for _ in range(2):                                    # each batch is replayed
            LT.split_batch(rows, k, seconds(), base, 100)
    ids = lambda topic: sorted(
        (r.batch_id, r.i or "") for r in LT.topic_rows(spark, base, topic, "value string").select(
            "batch_id", F.get_json_object("value", "$.id").alias("i")).collect())
    assert ids(LT.ON_TIME) == [(0, "1"), (0, "2"), (1, "3"), (1, "5"), (3, "6"), (4, "8")]
    assert ids(LT.LATE) == [(1, "4"), (2, ""), (4, "7")]
    folders = {r.span for r in LT.topic_rows(spark, base, LT.LATE, "value string").collect()}
    day = 1577836800 // 3600
    assert folders == {day + 1, day + 2, LT.NO_TIME}


def test_late_passes_join_what_the_stream_could_not_once_each(spark):
    """Orders and details, late and on time and again, over several passes."""
    base = shared_path(spark, "t_late_wide")
    info, det = f"{base}/info", f"{base}/detail"
    span = {"span_s": 600}

    def step(k, orders, lines):
        if orders:
            LT.split_batch(infos(spark, *orders), k, seconds(), info, 100, 600)
        if lines:
            LT.split_batch(details(spark, *lines), k, seconds(), det, 100, 600)

    def run(final=False):
        return LT.late_wide(spark, info, det, f"{base}/late", 10, final=final, **span)

    all_orders = [(1, 100), (2, 5000), (3, 200), (4, 9000), (5, 4995)]
    all_lines = [(10, 1, 105), (20, 2, 5003), (30, 3, 205), (31, 3, 300), (40, 4, 9001), (50, 5, 5000)]
    assert run() is None                                      # nothing has come
    step(0, [(1, 100), (2, 5000)], [(20, 2, 5003), (50, 5, 5000)])
    step(1, [(3, 200)], [(10, 1, 105)])                       # late order, late detail
    assert run() is None or LT.topic_rows(spark, info, LT.LATE, "value string").count() == 1
    step(2, [(4, 9000), (1, 100)], [(40, 4, 9001), (30, 3, 205), (31, 3, 300), (20, 2, 5003)])
    step(3, [(5, 4995)], [(40, 4, 9001)])                     # a late order of an on-time detail
    run()
    run()
    run(final=True)
    assert run(final=True) is None                            # all is worked off
    owed = U.read_versions(spark, f"{base}/late").select(*W.ORDER_WIDE_COLUMNS)
    assert owed.count() == owed.dropDuplicates(["order_id", "order_detail_id"]).count()

    def on_time(path, some, key):
        found = {int(json.loads(r.value)[key]) for r in LT.topic_rows(spark, path, LT.ON_TIME, "value string").collect()}
        return [r for r in some if r[0] in found]

    o, d = on_time(info, all_orders, "id"), on_time(det, all_lines, "id")
    streamed = {(a[0], b[0]) for a in o for b in d if b[1] == a[0] and abs(b[2] - a[1]) <= 10}
    want = {(a[0], b[0]) for a in all_orders for b in all_lines if b[1] == a[0] and abs(b[2] - a[1]) <= 10}
    got = {(r.order_id, r.order_detail_id) for r in owed.collect()}
    assert got == want - streamed and {(1, 10), (3, 30), (5, 50)} <= got and (2, 20) in streamed


def test_a_pass_reads_the_touched_spans_only(spark):
    base = shared_path(spark, "t_late_spans")
    for k, t in enumerate((0, 4000, 8000)):
        LT.split_batch(infos(spark, (k, t)), k, seconds(), f"{base}/info", 100, 600)
        LT.split_batch(details(spark, (k + 10, k, t + 1)), k, seconds(), f"{base}/detail", 100, 600)
    LT.split_batch(details(spark, (99, 1, 4005)), 3, seconds(), f"{base}/detail", 100, 600)
    on_time = LT.topic_rows(spark, f"{base}/info", LT.ON_TIME, "value string").where("span IN (2629734)")
    plan = on_time._jdf.queryExecution().executedPlan().toString()
    assert "(span#" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert LT.late_wide(spark, f"{base}/info", f"{base}/detail", f"{base}/late", 10, 600, final=True) == 0
    assert [(r.order_id, r.order_detail_id) for r in U.read_versions(spark, f"{base}/late").collect()] == [(1, 99)]


def test_late_counts_are_added_once(spark):
    base = shared_path(spark, "t_late_counts")
    rows = lambda *t: spark.createDataFrame([(str(x),) for x in t], "value string")
    number = F.col("value").cast("double")
    for k, part in enumerate((rows(1000), rows(100, 1001), rows(5000), rows(100, 103))):
        LT.split_batch(part, k, number, f"{base}/in", 60)
        LT.late_counts(spark, f"{base}/in", "value string", f"{base}/counts")
        assert LT.late_counts(spark, f"{base}/in", "value string", f"{base}/counts") is None
    counts = U.read_versions(spark, f"{base}/counts").groupBy("window_start").agg(F.sum("cnt").alias("n"))
    got = {r.window_start[-8:]: r.n for r in counts.collect()}
    assert got == {"00:01:30": 3, "00:01:35": 3, "00:01:40": 3}


# ---------------------------------------------------------------- tombstones

def test_deletes_outlive_folds_and_ids_come_back(spark):
    base = shared_path(spark, "t_tombstones")
    change = '{"id":"%s","name":"%s","area_code":"a","iso_code":"x","iso_3166_2":"y"}'
    batches = [[("1", "a", "insert"), ("2", "b", "bootstrap-insert")], [("1", "a", "DELETE")], [("3", "c", None)],
               [("2", "b2", "update")], [("2", "b2", "delete"), ("3", "c", "delete"), ("3", "c3", "insert")]]
    seq = 0
    for k, rows in enumerate(batches):
        data = []
        for i, name, op in rows:
            data.append((change % (i, name), op, seq))
            seq += 1
        spark.createDataFrame(data, "value string, op string, seq long").coalesce(1).write.parquet(f"{base}/in/{k}")
    stream = file_stream(spark, f"{base}/in", "value string, op string, seq long", 1)
    J.start_dim_province(stream, f"{base}/table", f"{base}/ckpt", available_now=True,
                         compact_every=2).awaitTermination()
    assert {r.id: r.name for r in J.read_provinces(spark, f"{base}/table").collect()} == {"3": "c3"}
    table = J.province_table(spark, f"{base}/table")
    assert {r.id for r in table.as_of(table.version()).collect()} == {"3"}
    U.compact(spark, f"{base}/table", ["id"], ["seq"], at=10)
    assert {r.id: r.name for r in J.read_provinces(spark, f"{base}/table").collect()} == {"3": "c3"}


def test_the_change_type_travels_as_a_header(spark):
    env = texts(spark, '{"table":"base_province","type":"DELETE","data":{"id":"1"}}', "garbage")
    rows = R.route_maxwell(env, with_op=True)
    assert {(r.topic, r.op) for r in rows.collect()} == {("ODS_BASE_PROVINCE", "delete"), ("QUARANTINE", None)}
    sent = {r.topic: r.headers for r in with_headers(rows).collect()}
    assert sent["ODS_BASE_PROVINCE"][0].key == "op" and bytes(sent["ODS_BASE_PROVINCE"][0].value) == b"delete"
    assert sent["QUARANTINE"] is None


# ---------------------------------------------------------------- quarantine

def test_whitelisted_data_that_is_no_array_is_quarantined(spark):
    bad = ['{"table":"order_info","type":"INSERT","data":"oops"}', '{"table":"order_info","type":"INSERT"}',
           '{"table":"order_info","type":"INSERT","data":{"id":"1"}}', "garbage", '{"type":"INSERT"}']
    good = ['{"table":"order_info","type":"INSERT","data":[{"id":"1"},{"id":"2"}]}',
            '{"table":"order_info","type":"INSERT","data":[]}', '{"table":"other","type":"INSERT","data":"oops"}']
    out = [(r.topic, r.value) for r in R.route_canal(texts(spark, *bad, *good)).collect()]
    assert sorted(v for t, v in out if t == "QUARANTINE") == sorted(bad)
    assert sorted(v for t, v in out if t != "QUARANTINE") == ['{"id":"1"}', '{"id":"2"}']
    assert R.route_canal(texts(spark, *bad, *good), with_quarantine=False).count() == 2


def test_orders_and_details_without_a_time_are_no_records(spark):
    dated = '{"id":"1","user_id":"7","order_id":"3","create_time":"2020-01-02 00:00:00"}'
    bare = '{"id":"2","user_id":"7","order_id":"3"}'
    rows = texts(spark, dated, bare)
    assert [r.id for r in O.order_info_typed(rows).collect()] == [1]
    assert [r.value for r in O.order_info_quarantine(rows).collect()] == [bare]
    assert [r.id for r in O.order_detail_typed(rows).collect()] == [1]
    topics = O.order_detail_topics(rows).collect()
    assert {r.topic for r in topics} == {"QUARANTINE", "DWD_ORDER_DETAIL"}
    assert [r.value for r in topics if r.topic == "QUARANTINE"] == [bare]
    same = O.order_detail_messages(O.order_detail_typed(rows)).first().value
    assert [r.value for r in topics if r.topic != "QUARANTINE"] == [same]


# ---------------------------------------------------------------- counts that follow

def firsts(spark, *rows):
    return spark.createDataFrame([("2024-01-01", m, ts, e, f"{ts // 100:02d}") for m, ts, e in rows],
                                 "dt string, mid string, ts long, event_id long, hr string")


def test_a_moved_device_day_is_taken_back_from_its_old_hour(spark):
    before = firsts(spark, ("a", 500, 1), ("b", 500, 2), ("c", 500, 3), ("d", 510, 9))
    batch = firsts(spark, ("a", 200, 9), ("b", 700, 9), ("c", 500, 1), ("d", 500, 9), ("e", 300, 9))
    out = {r.hr: r.change for r in RP.hour_changes(batch, before).collect()}
    assert out == {"02": 1, "03": 1, "05": -1}
    assert {r.hr: r.change for r in RP.hour_changes(before, None).collect()} == {"05": 4}


def test_hour_counts_equal_the_recount_after_late_and_replayed_batches(spark, sf_small):
    from rtmart.plans import registry as G
    base = shared_path(spark, "t_hours")
    logs = G.app_logs(spark, sf_small).persist()
    for b in range(5):                                        # arrival has nothing to do with time
        rows = D.first_records(logs.where(F.pmod(F.xxhash64("event_id"), F.lit(5)) == b)).persist()
        for _ in range(2 if b % 2 else 1):
            RP.update_hour_counts(rows, f"{base}/dau", f"{base}/hours", b)
            U.write_version(rows, f"{base}/dau", b, partition_by=["dt"])
    got = RP.read_hour_counts(spark, f"{base}/hours")
    want = D.dau_hour_count(D.dau_first_touch(logs))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    stored = spark.read.parquet(f"{base}/hours").groupBy("dt").count()
    assert stored.agg(F.max("count")).first()[0] <= 48
    day = RP.read_hour_counts(spark, f"{base}/hours", ["2024-01-10"])
    assert "2024-01-10" in day._jdf.queryExecution().executedPlan().toString()
    assert day.exceptAll(want.where("dt = '2024-01-10'")).count() == 0


# ---------------------------------------------------------------- bitmaps

def test_numbers_are_dense_and_stay(spark):
    path = shared_path(spark, "t_dictionary")
    mids = lambda *r: spark.createDataFrame([(f"m{k}",) for x in r for k in x] + [(None,)], "mid string")
    first = {r.mid: r.number for r in DV.extend_dictionary(spark, path, mids(range(50), range(9)), 0, 4).collect()}
    assert sorted(first.values()) == list(range(50))
    for _ in range(2):                                        # version 1 is replayed
        second = {r.mid: r.number for r in DV.extend_dictionary(spark, path, mids(range(40, 120)), 1, 4).collect()}
    assert sorted(second.values()) == list(range(120)) and first.items() <= second.items()
    assert DV.extend_dictionary(spark, path, mids(), 2, 4).count() == 120


def test_ranges_of_days_from_bitmaps_equal_distinct_counts(spark):
    """Devices beyond one piece of 32,768 numbers, days with gaps."""
    rows = spark.range(70_000).select(
        F.concat(F.lit("m"), (F.col("id") % 40_000).cast("string")).alias("mid"),
        F.concat(F.lit("2024-01-"), F.lpad((1 + F.pmod(F.xxhash64("id"), F.lit(4)) * 3).cast("string"), 2, "0"))
        .alias("dt")).persist()
    known = DV.numbered(rows, None)
    bitmaps = DV.merged(DV.day_bitmaps(rows, known).unionByName(
        DV.day_bitmaps(rows.where("dt = '2024-01-04'"), known)), ["dt"]).persist()
    count = lambda a, b: rows.where(F.col("dt").between(a, b)).select("mid").distinct().count()
    for a, b in (("2024-01-01", "2024-01-31"), ("2024-01-02", "2024-01-07"), ("2024-01-05", "2024-01-06")):
        assert DV.devices_between(bitmaps, a, b).first().devices == count(a, b)
    out = {r.dt: r for r in DV.device_report(bitmaps, days=4).collect()}
    assert sorted(out) == ["2024-01-01", "2024-01-04", "2024-01-07", "2024-01-10"]
    for dt, r in out.items():
        start = f"2024-01-{max(1, int(dt[-2:]) - 3):02d}"
        assert r.devices == count(dt, dt) and r.trailing == count(start, dt)
    assert sum(r.new_mid for r in out.values()) == 40_000
    assert out["2024-01-01"].new_mid == out["2024-01-01"].devices


# ---------------------------------------------------------------- inverted index

DOCS = "k long, name string, price double"


def test_index_pages_equal_the_scan_over_changing_documents(spark):
    path = shared_path(spark, "t_index")
    state = {}
    batches = [[(1, "Red plate", 5.0), (2, "blue-ring, red", 3.0), (3, None, 1.0), (4, "", 2.0), (5, "RED", None)],
               [(1, "green plate", 5.0), (2, "blue-ring, red", 9.0)], [(6, "red red", 3.0), (5, "ring", 4.0)],
               [(1, "red plate", 0.5)]]
    for v, docs in enumerate(batches):
        for _ in range(2):                                    # every version is replayed
            TI.write_postings(spark, path, spark.createDataFrame(docs, DOCS), "k", "name", "price", v, buckets=8)
        state |= {d[0]: d for d in docs}
        now = spark.createDataFrame(list(state.values()), DOCS)
        for text in ("red", "Plate ring", "blue", "absent", ""):
            for size, offset in ((20, 0), (1, 1)):
                want = SE.match_sorted(now, "name", text, "price", "k", size, offset).collect()
                got = TI.first_page(spark, path, text, now, "k", "price", size, offset, buckets=8).collect()
                assert got == want, (v, text)


def test_a_match_reads_its_terms_folders_only(spark):
    path = shared_path(spark, "t_index_prune")
    docs = spark.range(200).select(F.col("id").alias("k"), F.concat(F.lit("w"), F.col("id") % 50).alias("name"),
                                   F.lit(1.0).alias("price"))
    TI.write_postings(spark, path, docs, "k", "name", "price", 0, buckets=16)
    found = TI.matching(spark, path, "w7", buckets=16)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan or "PartitionFilters: [isnotnull(bucket" in plan
    assert sorted(r.id for r in found.collect()) == [7, 57, 107, 157]


# ---------------------------------------------------------------- schema on read

def test_variant_fields_equal_the_json_tuple_ones(spark, sf_small):
    from rtmart.plans import registry as G
    raw = G.app_log_raw(spark, sf_small).unionByName(texts(
        spark, "garbage", None, '{"common":null,"ts":"1704067200000"}', '{"common":{"mid":"x"},"start":null,"ts":"12"}',
        '{"common":{"mid":"x","uid":5},"start":{},"ts":1.5,"event_id":"7"}'))
    old, new = D.parse_app_log(raw), D.parse_app_log_variant(raw)
    assert new.columns == old.columns
    assert new.exceptAll(old).count() == 0 and old.exceptAll(new).count() == 0
    plan = new.where("mid = 'x' AND ts > 0")._jdf.queryExecution().executedPlan().toString()
    assert plan.lower().count("parse") == 1, plan


def test_paths_reach_into_arrays(spark):
    raw = texts(spark, '{"common":{"mid":"m"},"ts":1,"a":[{"b":[1,{"c":"deep"}]},2]}', '{"a":{}}')
    out = D.parse_app_log_variant(raw, {"deep": "$.a[0].b[1].c", "second": "$.a[1]"}).collect()
    assert [(r.deep, r.second, r.is_valid) for r in out] == [("deep", "2", True), (None, None, False)]


def test_fixture_adapters_keep_every_record(spark, sf_small):
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    for make in (FX.app_log_text_dirty, FX.app_log_text_nested):
        assert make(events).count() == events.count()
