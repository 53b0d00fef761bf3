"""Queries on inputs of more files than a small table gives."""

import glob
from functools import partial

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from rtmart.operators import wide as W
from rtmart.plans import registry as G
from rtmart.session import ensure_checkpoint_dir, shared_path
from rtmart.streaming import reports as RP, staging as S


def test_order_pipeline_of_many_files_loses_no_row(spark, sf_small, monkeypatch):
    """a batch held parts of slices, so most rows came later than the watermark."""
    monkeypatch.setattr(G, "stage_time_slices", partial(S.stage_time_slices, rows_per_file=60))
    got = G.q_stream_order_pipeline(spark, sf_small)
    want = W.order_wide_interval(G.dwd_orders(spark, sf_small), G.details_typed(spark, sf_small))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_late_inputs_are_computed_and_copied_once(spark, sf_small, monkeypatch):
    """each half of the input computed and copied all rows again."""
    cuts, stored = [], []
    real = S.stage_time_slices
    monkeypatch.setattr(G, "cut_lineage", lambda df, name, f=G.cut_lineage: cuts.append(name) or f(df, name))
    monkeypatch.setattr(G, "stage_time_slices", lambda *a, **k: stored.append(k.get("stored")) or real(*a, **k))
    rows = G.q_stream_order_wide_late(spark, sf_small)
    assert cuts.count("wide_late_input") == 2 and stored == [True] * 4
    assert rows.count() == W.order_wide_interval(G.dwd_orders(spark, sf_small),
                                                 G.details_typed(spark, sf_small)).count()


def test_replayed_batches_are_whole_slices_of_many_files(spark, sf_small, monkeypatch):
    """a micro-batch was one file, read by one task."""
    want = G.q_stream_replay_dimension(spark, sf_small)
    monkeypatch.setattr(S, "ROWS_PER_FILE", 50)
    monkeypatch.setattr(S.stage_time_slices, "__defaults__", tuple(
        50 if d == 200_000 else d for d in S.stage_time_slices.__defaults__))
    before = set(glob.glob(f"{ensure_checkpoint_dir(spark)}/stream_replay_dimension-*"))
    got = G.q_stream_replay_dimension(spark, sf_small)
    base, = set(glob.glob(f"{ensure_checkpoint_dir(spark)}/stream_replay_dimension-*")) - before
    assert all(len(glob.glob(f"{base}/in/_slice={k}/*.parquet")) > 1 for k in range(G.N_SLICES))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < want.count()


def test_hour_counts_are_written_without_one_task_for_all(spark, monkeypatch):
    """a coalesce ran every partition's aggregates in one task, which held the memory of all."""
    base = shared_path(spark, "t_hours_tasks")
    firsts = spark.range(3000).select(
        F.format_string("2024-01-%02d", (F.col("id") % 9 + 1).cast("int")).alias("dt"),
        F.concat(F.lit("m"), "id").alias("mid"), F.col("id").alias("ts"), F.col("id").alias("event_id"),
        F.format_string("%02d", (F.col("id") % 24).cast("int")).alias("hr"))

    def no(self, n):
        raise AssertionError("coalesced")

    monkeypatch.setattr(type(firsts), "coalesce", no)
    RP.update_hour_counts(firsts, f"{base}/dau", f"{base}/hours", 0)
    assert sum(r.cnt for r in RP.read_hour_counts(spark, f"{base}/hours").collect()) == 3000
    assert {len(glob.glob(f"{d}/batch_id=0/*.parquet")) for d in glob.glob(f"{base}/hours/dt=*")} == {1}


def test_replayed_orders_are_joined_once_and_read_narrow(spark, sf_small, monkeypatch):
    """the orders were joined for the state and for the batch, their texts copied and
    shuffled, and whole rows shuffled again to read four columns."""
    cuts, copies = [], []
    monkeypatch.setattr(G, "cut_lineage", lambda df, name, f=G.cut_lineage: cuts.append(name) or f(df, name))
    monkeypatch.setattr(S, "write_and_read", lambda *a, f=S.write_and_read: copies.append(a[1]) or f(*a))
    got = G.q_stream_replay(spark, sf_small)
    assert cuts.count("order_rows") == 1 and not [c for c in copies if "stream_replay" in c]
    assert "final_total_amount" not in got._jdf.queryExecution().executedPlan().toString()
    want = G.q_first_order_flag(spark, sf_small)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < want.count()


def test_texts_of_topic_streams_are_written_small(spark, sf_small):
    """the staged texts and the topics took most of the megabytes, lightly compressed."""
    before = set(glob.glob(f"{ensure_checkpoint_dir(spark)}/stream_dwd_order_detail-*"))
    got = G.q_stream_dwd_order_detail(spark, sf_small)
    base, = set(glob.glob(f"{ensure_checkpoint_dir(spark)}/stream_dwd_order_detail-*")) - before
    files = glob.glob(f"{base}/in/*.parquet") + glob.glob(f"{base}/topics/*/*.parquet")
    kinds = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}
    assert kinds == {"ZSTD"}
    assert got.count() == G.q_dwd_order_detail_messages(spark, sf_small).count() > 0


def test_inputs_of_the_wide_job_have_the_same_slices(spark, sf_small, monkeypatch):
    """the details had more slices than the orders, which all came first and stayed open, written
    again by every batch."""
    calls, open_orders = [], []
    monkeypatch.setattr(G, "ROWS_PER_SLICE", 1000)
    monkeypatch.setattr(G, "stage_time_slices",
                        lambda *a, f=S.stage_time_slices, **k: calls.append((a[3], k.get("lying"))) or f(*a, **k))
    monkeypatch.setattr(G.J, "write_version", lambda df, path, *a, f=G.J.write_version, **k: (
        path.endswith("/open/orders") and open_orders.append(df.count())) or f(df, path, *a, **k))
    got = G.q_stream_order_wide(spark, sf_small)
    lines = spark.read.parquet(f"{sf_small}/lineitem.parquet").count()
    assert calls == [(-(-lines // 1000), True)] * 2 and calls[0][0] > G.N_SLICES
    assert len(open_orders) > G.N_SLICES and max(open_orders) < 500        # of 1,500
    want = W.order_wide_interval(G.dwd_orders(spark, sf_small), G.details_typed(spark, sf_small))
    assert got.count() == want.count() > 0 and got.exceptAll(want.select(*got.columns)).count() == 0


def test_order_pipeline_stages_both_inputs_once_in_the_same_slices(spark, sf_small, monkeypatch):
    """orders and details had slices of their own, and were copied and shuffled into them."""
    calls = []

    class Enough(Exception):
        pass

    class Done:
        def awaitTermination(self):
            pass

    def stage(df, time_col, path, n, files, **k):
        calls.append((path.rsplit("/", 1)[1], n, k["lying"], k["bounds"]))
        if len(calls) == 2:
            raise Enough

    monkeypatch.setattr(G, "ROWS_PER_SLICE", 1000)
    monkeypatch.setattr(G, "stage_time_slices", stage)
    monkeypatch.setattr(G, "_sliced_stream", lambda *a: None)
    monkeypatch.setattr(G.J, "start_first_order", lambda *a, **k: Done())
    try:
        G.q_stream_order_pipeline(spark, sf_small)
    except Enough:
        pass
    assert [c[0] for c in calls] == ["in", "detail"] and calls[0][1:] == calls[1][1:]
    assert calls[0][1] > G.N_SLICES and calls[0][2] is True


def test_times_of_texts_without_a_pattern(spark):
    from rtmart.functions import text_seconds, timestamp_to_text
    rows = spark.createDataFrame([("2020-01-02 03:04:05",), ("2020-02-30 00:00:00",), ("2020-01-02T03:04:05",),
                                  ("2020-01-02",), (None,), ("2020-01-02 25:00:00",)], "t string")
    assert [r[0] for r in rows.select(text_seconds("t")).collect()] == [1577934245, None, None, None, None, None]
    day = spark.sql("SELECT TIMESTAMP_NTZ '1999-12-31 00:00:00' AS d")
    assert day.select(timestamp_to_text("d", F.lit(86_467))).first()[0] == "2000-01-01 00:01:07"
