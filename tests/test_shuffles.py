"""Shuffles and sorts that the work at size has no need of."""

from pyspark.sql import functions as F

from rtmart.plans import registry as Q
from rtmart.sources import fixtures as FX


def test_lines_of_an_order_are_not_shuffled_again_for_its_envelope(spark, sf_mid):
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for c, v in zip(old, ("-1", "false")):
            spark.conf.set(c, v)
        env = FX.canal_envelopes(Q.oi_rows(spark, sf_mid), Q.od_rows(spark, sf_mid, True),
                                 Q._t(spark, sf_mid, "customer"))
        plan = env.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x]
    assert shuffles and not any("chunk" in x for x in shuffles), shuffles


def test_topic_streams_write_without_sorting_texts(spark, monkeypatch):
    seen = []

    class Query:
        def awaitTermination(self):
            seen.append(int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")))

    monkeypatch.setattr(Q.J, "start_topic_stream", lambda *a, **k: Query())
    monkeypatch.setattr(Q.J, "read_topics", lambda *a: None)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    Q._run_topics(spark, spark.range(1).select(F.lit("a").alias("topic")), "x")
    assert seen == [Q.OPEN_TOPICS] and Q.OPEN_TOPICS > 9          # topics of a job, quarantine too
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_lines_are_shuffled_once_for_their_amounts(spark):
    """the lines were shuffled three times for the sums of an order and its shares."""
    from rtmart.operators import wide as W
    info = spark.createDataFrame([(k, 10.0) for k in range(40)], "id long, final_total_amount double")
    det = spark.createDataFrame([(10 * k + j, k, float(j + 1), 1) for k in range(40) for j in range(3)],
                                "id long, order_id long, order_price double, sku_num long")
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for c, v in zip(old, ("-1", "false")):
            spark.conf.set(c, v)
        out = W.detail_amount_split(info, det, stored=True)
        plan = out.select("*")._jdf.queryExecution().executedPlan().toString()
        rows = out.collect()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert sum("Exchange hashpartitioning(" in x for x in plan.splitlines()) == 2, plan     # lines, orders
    assert sum(r.cents for r in rows) == 40 * 1000 and len(rows) == 120
