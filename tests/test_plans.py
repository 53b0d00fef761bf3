"""Plan shape: pruning, pushdown, map-side combine, broadcast, top-k, skew."""

from pyspark.sql import functions as F

from rtmart.operators.upsert import read_versions, write_version
from rtmart.plans import queries
from rtmart.session import shared_path
from rtmart.streaming import jobs as J

Q = queries()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dau_dedup_is_a_map_side_combined_aggregate(spark, sf_small):
    plan = _plan(Q["dau_first_touch"](spark, sf_small))
    assert "Window" not in plan                       # no whole group in one task
    assert "partial_min" in plan                      # combined before the shuffle
    assert plan.count("Exchange") == 1
    # column pruning: events.value is never read
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "value:" not in scan.split("ReadSchema")[1]


def test_json_is_parsed_once_per_input(spark, sf_small):
    plan = _plan(Q["order_info_typed"](spark, sf_small))
    assert plan.count("json_tuple") == 1
    assert "from_json" not in plan


def test_province_dimension_is_broadcast(spark, sf_small):
    df = Q["province_enrich"](spark, sf_small)
    df.collect()                                      # adaptive: decided by measured size
    plan = _plan(df)
    final = plan.split("Initial Plan")[0]
    assert "BroadcastHashJoin" in final and "LeftOuter" in final


def test_first_order_has_no_per_user_window(spark, sf_small):
    plan = _plan(Q["first_order_flag"](spark, sf_small))
    assert "Window" not in plan
    assert "partial_min" in plan


def test_top20_is_take_ordered(spark, sf_small):
    plan = _plan(Q["match_top20"](spark, sf_small))
    assert "TakeOrderedAndProject" in plan
    assert "PushedFilters" in plan


def test_version_reads_prune_partitions(spark):
    path = shared_path(spark, "t_prune")
    for b in range(3):
        write_version(spark.createDataFrame([(f"u{b}", "1")], "user_id string, if_consumed string"),
                      path, b)
    df = read_versions(spark, path, before=2)
    plan = _plan(df)
    part_filters = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "batch_id" in part_filters
    assert sorted(r.user_id for r in df.collect()) == ["u0", "u1"]


def test_detail_ids_need_no_shuffle_of_the_lines(spark, sf_small):
    """Building the plan only reads the three tables' schemas, and lines meet
    only in the joins."""
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    df = Q["order_detail_typed"](spark, sf_small)
    assert len(tracker.getJobIdsForGroup(None)) - before <= 3
    plan = _plan(df)
    assert "Window" not in plan
    assert df.select("id").distinct().count() == df.count()


def _scanned(df):
    """(rows, files' scan metrics) that the scan of a plan without exchanges gave out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_state_lookup_skips_the_row_groups_of_other_users(spark, monkeypatch):
    """The rows read for a few users stay the same while the state grows."""
    from rtmart.operators.upsert import compact, read_versions
    monkeypatch.setattr("rtmart.operators.upsert.BLOOM_VALUES", 5000)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", "65536")              # many row groups in a small test
    hadoop.set("parquet.page.size", "8192")
    try:
        read = []
        for users in (40_000, 800_000):
            path = shared_path(spark, "t_state_skip")
            for b in range(2):
                write_version(spark.range(b * users // 2, (b + 1) * users // 2).selectExpr(
                    "cast(id * 7 as string) AS user_id", "'1' AS if_consumed"), path, b)
            compact(spark, path, ["user_id"], [], at=2, cluster_by=["user_id"])
            known = read_versions(spark, path).where("kind = 'base'").select("user_id")
            wanted = known.where(F.col("user_id").isin(["7", "70007", "3", "x"] + ["-1"] * 9))
            assert sorted(r.user_id for r in wanted.collect()) == ["7", "70007"]
            read.append(_scanned(wanted))
            orders = spark.createDataFrame([(7,), (70007,), (3,)], "user_id long")
            assert sorted(r.user_id for r in J._state_of(spark, path, 2, orders).collect()) == ["7", "70007"]
        assert known.count() == 800_000 and read[1] < 80_000 and read[1] <= 4 * read[0], read
    finally:
        hadoop.unset("parquet.block.size")
        hadoop.unset("parquet.page.size")


def test_state_is_filtered_before_any_exchange(spark, monkeypatch):
    """The order job's state read for many users: scan, semi-join with the
    batch's users, and only then a shuffle (of the few that are left)."""
    monkeypatch.setattr(J, "STATE_KEYS", 2)
    path = shared_path(spark, "t_state_plan")
    for b in range(3):
        write_version(spark.range(100 * b, 100 * b + 100).selectExpr(
            "cast(id as string) AS user_id", "'1' AS if_consumed"), path, b)
    orders = spark.createDataFrame([(5,), (205,), (999,)], "user_id long")
    state = J._state_of(spark, path, 2, orders)
    lines = _plan(state).splitlines()
    joined = next(i for i, x in enumerate(lines) if "BroadcastHashJoin" in x and "LeftSemi" in x)
    scanned = next(i for i, x in enumerate(lines) if "FileScan parquet" in x)
    assert joined < scanned
    assert not any("Exchange hashpartitioning" in x for x in lines[joined:scanned])
    assert [r.user_id for r in state.collect()] == ["5"]      # 205 is of a later version


def test_orders_are_scanned_once_for_the_first_order_flag(spark, sf_small):
    plan = _plan(Q["first_order_flag_empty_state"](spark, sf_small))
    assert "json_tuple" not in plan            # parsed once, before


def test_windowed_join_repeats_no_row(spark, sf_small):
    plan = _plan(Q["order_wide_dedup"](spark, sf_small))
    assert "explode" not in plan


def test_sql_text_reads_push_filters_and_prune_columns(spark, sf_small):
    from rtmart.sources.tables import query_list, read_table
    read_table(spark, sf_small, "customer").createOrReplaceTempView("t_customer_sql")
    df = query_list(spark, "SELECT c_custkey, c_name FROM t_customer_sql WHERE c_custkey < 10")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(c_custkey), LessThan(c_custkey,10)]" in plan
    read_schema = plan.split("ReadSchema: ", 1)[1].split("\n", 1)[0]
    assert "c_acctbal" not in read_schema and "c_name" in read_schema
    assert df.count() == 10
