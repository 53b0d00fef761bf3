"""The expected values of FIXTURES.md section 4 (sf0.01), probed independently
before the build, as regression anchors."""

from pyspark.sql import functions as F

from rtmart.operators import dau as D
from rtmart.operators import search as SE
from rtmart.plans import queries, registry as G

Q = queries()


def _counts(df, col):
    return {r[col]: r["count"] for r in df.groupBy(col).count().collect()}


def test_routing_and_dau_values(spark, sf_mid):
    assert _counts(Q["route_app_log"](spark, sf_mid), "topic") == \
        {"GMALL_START": 2017, "GMALL_EVENT": 7983}
    hc = Q["dau_hour_count"](spark, sf_mid)
    assert hc.count() == 686 and hc.agg(F.sum("cnt")).first()[0] == 4006
    cmp = D.dau_hour_compare(G.dau_docs(spark, sf_mid), date="2024-01-10")
    sums = cmp.agg(F.sum("today").alias("t"), F.sum("yesterday").alias("y")).first()
    assert (sums.t, sums.y) == (133, 136)
    assert cmp.count() == 23            # hours present on either day
    rt = {(r.dt, r.id): r.value for r in Q["realtime_total"](spark, sf_mid).collect()}
    assert rt[("2024-01-01", "new_mid")] == 134 and rt[("2024-01-02", "new_mid")] == 16
    assert Q["bulk_upsert_latest"](spark, sf_mid).count() == 4006


def test_change_data_values(spark, sf_mid):
    assert _counts(Q["cdc_route_canal"](spark, sf_mid), "topic") == \
        {"ODS_ORDER_INFO": 9912, "ODS_ORDER_DETAIL": 39512}
    mx = _counts(Q["cdc_route_maxwell"](spark, sf_mid), "topic")
    assert {k: mx[k] for k in ("ODS_BASE_PROVINCE", "ODS_USER_INFO", "ODS_SKU_INFO",
                               "ODS_BASE_TRADEMARK", "ODS_BASE_CATEGORY3", "ODS_SPU_INFO")} == {
        "ODS_BASE_PROVINCE": 25, "ODS_USER_INFO": 1485, "ODS_SKU_INFO": 2000,
        "ODS_BASE_TRADEMARK": 25, "ODS_BASE_CATEGORY3": 6, "ODS_SPU_INFO": 50}


def test_order_values(spark, sf_mid):
    oi = Q["order_info_typed"](spark, sf_mid)
    assert oi.count() == 15000 and oi.select("id").distinct().count() == 15000
    od = Q["order_detail_typed"](spark, sf_mid)
    assert od.count() == 60000 and od.select("id").distinct().count() == 60000
    assert od.agg(F.bit_xor("id")).first()[0] == 773943633335681908
    assert _counts(Q["first_order_flag_empty_state"](spark, sf_mid), "if_first_order") == \
        {"1": 1500, "0": 13500}
    assert _counts(Q["first_order_flag"](spark, sf_mid), "if_first_order") == \
        {"1": 326, "0": 12388}
    assert _counts(Q["user_state_lookup"](spark, sf_mid), "if_consumed") == \
        {"1": 1174, "0": 326}
    pe = Q["province_enrich"](spark, sf_mid)
    assert pe.where("province_name IS NOT NULL").count() == 15000


def test_lookup_values(spark, sf_mid):
    part = G._t(spark, sf_mid, "part")
    assert SE.match_count(part, "p_name", "red").first().hits == 257
    assert Q["match_top20"](spark, sf_mid).count() == 20
