"""The wide job's batches: whole slices, open rows, replays; staged inputs."""

import glob

from pyspark.sql import functions as F

from rtmart.operators import wide as W
from rtmart.plans import registry as G
from rtmart.session import shared_path
from rtmart.sources.streams import file_stream
from rtmart.streaming import jobs as J
from rtmart.streaming import staging as S

INFO = ('{"id":"%d","order_status":"S","create_time":"2020-01-01 %s","user_id":"5","province_name":"p",'
        '"create_date":"2020-01-01","if_first_order":"1"}')
DETAIL = '{"id":"%d","order_id":"%d","sku_id":"1","order_price":"1.5","sku_num":"1","create_time":"2020-01-01 %s"}'


def test_slices_of_many_files_are_read_whole(spark, sf_small):
    """More files a slice than a batch read before: rows of the later batches came too late."""
    base = shared_path(spark, "t_many_files")
    info, det = G._wide_inputs(spark, sf_small)
    bounds = None
    for name, rows in (("info", info), ("detail", det)):
        bounds = S.stage_time_slices(rows, "_t", f"{base}/{name}", 3, 2, bounds=bounds, keep=["value"],
                                     rows_per_file=60, rows_per_slice=400)
        slices = sorted(glob.glob(f"{base}/{name}/_slice=*"))
        files = {len(glob.glob(f"{s}/*.parquet")) for s in slices}
        assert len(slices) > 3 and files == {S.slice_files(spark, f"{base}/{name}")} and max(files) > 2
    J.start_wide(G._sliced_stream(spark, f"{base}/info"), G._sliced_stream(spark, f"{base}/detail"),
                 f"{base}/wide", f"{base}/ckpt", available_now=True).awaitTermination()
    got = spark.read.parquet(f"{base}/wide")
    want = W.order_wide_interval(G.dwd_orders(spark, sf_small), G.details_typed(spark, sf_small))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_few_rows_still_fill_every_slice(spark):
    base = shared_path(spark, "t_few_rows")
    rows = spark.createDataFrame([(str(k), float(k)) for k in (0, 1, 99)], "value string, _t double")
    S.stage_time_slices(rows, "_t", f"{base}/in", 4, 3, keep=["value"])
    assert [len(glob.glob(f"{base}/in/_slice={k}/*.parquet")) for k in range(4)] == [3, 3, 3, 3]
    stream = file_stream(spark, f"{base}/in", "value string", S.slice_files(spark, f"{base}/in"))
    seen = []
    (stream.writeStream.option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True)
     .foreachBatch(lambda df, k: seen.append(sorted(r.value for r in df.collect()))).start().awaitTermination())
    assert [s for s in seen if s] == [["0", "1"], ["99"]]


def test_stateless_input_is_written_once_as_it_is(spark):
    base = shared_path(spark, "t_stage_files")
    rows = spark.range(1000, numPartitions=8).select(F.col("id").cast("string").alias("value"))
    assert S.stage_files(rows, f"{base}/in", 4) == 2
    assert spark.read.parquet(f"{base}/in").count() == 1000 and not glob.glob(f"{base}/in_staged")
    assert S.stage_files(rows, f"{base}/more", 4, rows_per_file=25) == 10


def _batch(spark, infos, details):
    rows = [(INFO % i, True) for i in infos] + [(DETAIL % d, False) for d in details]
    return spark.createDataFrame(rows, "value string, is_order boolean")


def test_open_rows_meet_later_partners_once(spark):
    base = shared_path(spark, "t_open_rows")
    fn = J.wide_batch_fn(f"{base}/wide", f"{base}/open", 10, 3600)
    batches = [
        _batch(spark, [(1, "00:00:00"), (2, "00:00:05")], [(10, 1, "00:00:03"), (10, 1, "00:00:03")]),
        # a copy of a joined detail, a partner of an open order, one outside the bound
        _batch(spark, [(3, "05:00:00")], [(10, 1, "00:00:03"), (20, 2, "00:00:06"), (21, 2, "00:00:16"),
                                          (30, 3, "05:00:10")]),
        _batch(spark, [(1, "00:00:00"), (4, "09:00:00")], [(11, 1, "00:00:04"), (31, 3, "04:59:50"),
                                                           (40, 4, "09:00:00")]),
    ]
    for k, batch in enumerate(batches):
        for _ in range(2):                       # each delivered again
            fn(batch, k)
    got = sorted((r.order_id, r.order_detail_id) for r in spark.read.parquet(f"{base}/wide").collect())
    # 11 is hours later than the watermark (04:00:00), 21 is 11 seconds off
    assert got == [(1, 10), (2, 20), (3, 30), (3, 31), (4, 40)]
    left = {r.id for r in spark.read.parquet(f"{base}/open/orders").where("batch_id = 2").collect()}
    assert left == {4}


def test_a_batch_moved_half_way_is_moved_whole_once(spark):
    from rtmart.operators.upsert import file_system, write_files_once
    base = shared_path(spark, "t_half_moved")
    write_files_once(spark.range(10, numPartitions=4), f"{base}/t", 7)
    jvm, root, fs = file_system(spark, f"{base}/t")
    Path = jvm.org.apache.hadoop.fs.Path
    name = sorted(glob.glob(f"{base}/t/batch-7-*.parquet"))[0].rsplit("/", 1)[1]
    # as if the driver had died before this file was moved
    assert fs.rename(Path(root, name), Path(root, f"_aside/batch_id=7/kind=delta/{name[8:]}"))
    write_files_once(spark.range(10, numPartitions=4), f"{base}/t", 7)
    assert sorted(r.id for r in spark.read.parquet(f"{base}/t").collect()) == list(range(10))


def test_on_time_topics_are_written_as_they_lie_and_small(spark, monkeypatch):
    """the texts of both topics were shuffled by span once more and lightly compressed."""
    import pyarrow.parquet as pq
    from rtmart.streaming import late as L
    base, hints = shared_path(spark, "t_split_lies"), []
    frame = type(spark.range(0))
    monkeypatch.setattr(frame, "hint", lambda self, *a, f=frame.hint: hints.append(a) or f(self, *a))
    rows = spark.createDataFrame([(f"m{t}", float(t)) for t in range(0, 40_000, 100)], "value string, t double")
    L.split_batch(rows, 0, F.col("t"), base, 3600)
    assert not hints
    L.split_batch(rows, 1, F.col("t"), base, 3600)
    assert hints == [("rebalance", "span")]                  # late rows may be of any span
    files = glob.glob(f"{base}/*/batch_id=*/**/*.parquet", recursive=True)
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
    assert spark.read.parquet(f"{base}/on_time").count() + spark.read.parquet(f"{base}/late").count() == 800


def test_lying_slices_are_written_by_one_job_and_filled(spark, monkeypatch):
    """the texts of the wide job were copied, and shuffled into slices after that."""
    base, copies = shared_path(spark, "t_lying"), []
    monkeypatch.setattr(S, "write_and_read", lambda *a, f=S.write_and_read: copies.append(a) or f(*a))
    rows = spark.range(0, 1000, numPartitions=8).select(F.col("id").cast("string").alias("value"), F.col("id").alias("_t"))
    for only in (range(0, 1), range(1, 3)):                  # most rows after all others
        S.stage_time_slices(rows, "_t", f"{base}/in", 3, 2, bounds=(0.0, 30.0), keep=["value"], only=only,
                            rows_per_file=50, lying=True)
    assert not copies
    files = [len(glob.glob(f"{base}/in/_slice={k}/*.parquet")) for k in range(3)]
    assert files[1] == files[2] == S.slice_files(spark, f"{base}/in") >= files[0] >= 2
    assert spark.read.parquet(f"{base}/in").groupBy("_slice").count().orderBy("_slice").collect() == \
        [(0, 10), (1, 10), (2, 980)]


def test_an_orders_messages_are_shuffled_once_for_dedup_and_join(spark):
    """details were shuffled by (order, detail) and again by order."""
    rows = spark.range(100).select(F.col("id").alias("order_id"), F.col("id"), F.lit("x").alias("name"),
                                   F.lit(1).alias("_t"))
    once = J._once(rows, None, ["order_id", "id"])
    other = rows.select("order_id").repartition("order_id")
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for c, v in zip(old, ("-1", "false")):
            spark.conf.set(c, v)
        plan = once.join(other, "order_id").select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert sum("Exchange hashpartitioning(" in x for x in plan.splitlines()) == 2, plan
    assert once.count() == 100
