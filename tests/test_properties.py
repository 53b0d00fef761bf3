"""Property tests against plain-Python models on random small frames."""

from hypothesis import HealthCheck, given, settings, strategies as st

from rtmart.operators import orders as O
from rtmart.operators import wide as W
from rtmart.operators.upsert import latest_per_key

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_kv = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 9)),
                   min_size=1, max_size=40)


@SETTINGS
@given(rows_kv)
def test_latest_per_key_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int, x int")
    got = {(r.k, r.v, r.x) for r in latest_per_key(df, ["k"], ["v"]).collect()}
    model = {}
    for k, v, x in rows:
        if k not in model or (v, x) > model[k]:
            model[k] = (v, x)
    assert got == {(k, v, x) for k, (v, x) in model.items()}


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 4), st.floats(0.01, 999.99).map(lambda x: round(x, 2)),
                          st.integers(0, 5)), min_size=1, max_size=20),
       st.floats(0.0, 5000.0).map(lambda x: round(x, 2)))
def test_amount_split_conserves_order_total(spark, lines, paid):
    det = spark.createDataFrame([(i, 1, p, n) for i, (_, p, n) in enumerate(lines)],
                                "id long, order_id long, order_price double, sku_num long")
    info = spark.createDataFrame([(1, paid)], "id long, final_total_amount double")
    out = W.detail_amount_split(info, det).collect()
    assert len(out) == len(lines)
    assert sum(r.cents for r in out) == round(paid * 100)
    assert all(r.cents >= 0 for r in out)


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 5)), min_size=1, max_size=30))
def test_exactly_one_first_order_per_user(spark, orders):
    rows = [(i, u, f"2020-01-01 00:00:0{t}", 1) for i, (u, t) in enumerate(orders)]
    batch = spark.createDataFrame(rows, "id long, user_id long, create_time string, "
                                        "province_id long")
    flags = {r.id: r.if_first_order for r in O.first_order_flag(batch).collect()}
    for u in {u for _, u, _, _ in rows}:
        mine = [(ct, i) for i, uu, ct, _ in rows if uu == u]
        first = min(mine)[1]
        assert flags[first] == "1"
        assert all(flags[i] == "0" for _, i in mine if i != first)
