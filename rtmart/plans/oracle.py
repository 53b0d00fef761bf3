"""Independent DuckDB SQL for each named query (tables are pre-registered views).

Each statement repeats the table adapter it needs as a CTE, then computes the
expected result in plain SQL. Orderings spell out NULLS FIRST to match Spark.
"""

from __future__ import annotations

# ---------------------------------------------------------------- adapters

# App log fields from events. epoch_us // 1000 truncates like Spark's unix_millis.
AL = """al AS (
  SELECT event_id,
         'mid_' || CAST(user_id AS VARCHAR) AS mid,
         CAST(user_id AS VARCHAR) AS uid,
         CAST(user_id % 25 AS VARCHAR) AS ar,
         event_type AS ch,
         json_extract_string(props, '$.k') AS vc,
         epoch_us(ts) // 1000 AS ts_ms,
         ts AS ts_raw,
         event_type = 'signup' AS has_start
  FROM events)"""

AL_TEXT = AL + """,
al_text AS (
  SELECT *,
    CASE WHEN has_start THEN
      json_object('common', json_object('mid', mid, 'uid', uid, 'ar', ar, 'ch', ch, 'vc', vc),
                  'start', json_object('entry', 'icon'), 'ts', ts_ms, 'event_id', event_id)
    ELSE
      json_object('common', json_object('mid', mid, 'uid', uid, 'ar', ar, 'ch', ch, 'vc', vc),
                  'ts', ts_ms, 'event_id', event_id)
    END::VARCHAR AS value
  FROM al)"""

DAU = AL + """,
dau AS (
  SELECT mid, uid, ar, ch, vc, dt, hr, mi, ts_ms AS ts FROM (
    SELECT *, strftime(ts_raw, '%Y-%m-%d') AS dt, strftime(ts_raw, '%H') AS hr,
           strftime(ts_raw, '%M') AS mi,
           row_number() OVER (PARTITION BY mid, strftime(ts_raw, '%Y-%m-%d')
                              ORDER BY ts_ms, event_id) AS rn
    FROM al) WHERE rn = 1)"""

HOURS = DAU + """,
hc AS (SELECT dt, hr, count(*) AS cnt FROM dau GROUP BY dt, hr)"""


# Orders (oi) from orders + customer.
OI = """oi AS (
  SELECT o.o_orderkey AS id, CAST(c.c_nationkey AS BIGINT) AS province_id,
         o.o_custkey AS user_id, o.o_orderstatus AS order_status,
         o.o_totalprice AS final_total_amount,
         CAST(o.o_orderkey % 50 AS DOUBLE) AS benefit_reduce_amount,
         round(o.o_totalprice + CAST(o.o_orderkey % 50 AS DOUBLE)
               - CAST(o.o_orderkey % 20 AS DOUBLE), 2) AS original_total_amount,
         CAST(o.o_orderkey % 20 AS DOUBLE) AS feight_fee,
         CAST(NULL AS VARCHAR) AS expire_time,
         strftime(o.o_orderdate + to_seconds(o.o_orderkey % 86400), '%Y-%m-%d %H:%M:%S')
           AS create_time,
         CAST(NULL AS VARCHAR) AS operate_time
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
oit AS (
  SELECT *, split_part(create_time, ' ', 1) AS create_date,
         split_part(split_part(create_time, ' ', 2), ':', 1) AS create_hour
  FROM oi)"""

# Order details (od) from lineitem + orders + part.
OD = """li AS (
  SELECT *, ('0x' || substr(md5(concat_ws('|', l_orderkey::VARCHAR, l_linenumber::VARCHAR,
           l_partkey::VARCHAR, l_suppkey::VARCHAR,
           CAST(round(l_extendedprice * 100) AS BIGINT)::VARCHAR,
           CAST(trunc(l_quantity) AS BIGINT)::VARCHAR)), 1, 15))::BIGINT AS line_id
  FROM lineitem),
od AS (
  SELECT li.line_id AS id, li.l_orderkey AS order_id, li.l_partkey AS sku_id,
         li.l_extendedprice AS order_price,
         CAST(trunc(li.l_quantity) AS BIGINT) AS sku_num, p.p_name AS sku_name,
         strftime(o.o_orderdate + to_seconds(li.l_orderkey % 86400 + 4 * li.l_linenumber),
                  '%Y-%m-%d %H:%M:%S') AS create_time
  FROM li JOIN orders o ON li.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON li.l_partkey = p.p_partkey)"""

PROV = """prov AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS id,
         CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'OLD_' || n_name END AS name,
         CAST(n_regionkey AS VARCHAR) AS area_code,
         'CN-' || CAST(n_nationkey AS VARCHAR) AS iso_code,
         'ISO-' || CAST(n_nationkey AS VARCHAR) AS iso_3166_2
  FROM nation)"""

DIMS = """c3 AS (
  SELECT CAST(('0x' || substr(md5(p_type), 1, 12))::BIGINT AS VARCHAR) AS id, p_type AS name
  FROM (SELECT DISTINCT p_type FROM part)),
tm AS (
  SELECT regexp_extract(p_brand, '#(\\d+)', 1) AS id, p_brand AS tm_name
  FROM (SELECT DISTINCT p_brand FROM part)),
sku AS (
  SELECT CAST(p.p_partkey AS VARCHAR) AS id, CAST(p.p_size AS VARCHAR) AS spu_id,
         p.p_name AS sku_name,
         regexp_extract(p.p_brand, '#(\\d+)', 1) AS tm_id, c3.id AS category3_id
  FROM part p LEFT JOIN c3 ON p.p_type = c3.name),
spu AS (
  SELECT CAST(p_size AS VARCHAR) AS id, 'SPU_' || CAST(p_size AS VARCHAR) AS spu_name
  FROM (SELECT DISTINCT p_size FROM part WHERE p_size IS NOT NULL)),
usr AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
         printf('%d-%02d-15', CAST(c_custkey % 60 + 1940 AS INTEGER),
                CAST(c_custkey % 12 + 1 AS INTEGER)) AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender
  FROM customer)"""

STATE = OI + """,
st AS (SELECT DISTINCT user_id FROM oi WHERE create_time < '1996-01-01'),
b AS (SELECT * FROM oit WHERE create_time >= '1996-01-01')"""

# First-order flag of all orders against an empty state.
FLAG_ALL = OI + """,
fl AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) = 1
                 THEN '1' ELSE '0' END AS if_first_order
  FROM oit)"""

DWD = FLAG_ALL + ",\n" + PROV + """,
dwd AS (
  SELECT fl.*, prov.name AS province_name, prov.area_code AS province_area_code,
         prov.iso_3166_2 AS province_3166_2_code
  FROM fl LEFT JOIN prov ON fl.province_id = CAST(prov.id AS BIGINT))"""


def _quoted_json(alias: str, cols: list[str]) -> str:
    parts = ", ".join(f"'{c}', CAST({alias}.{c} AS VARCHAR)" for c in cols)
    return f"json_object({parts})::VARCHAR"


def _typed_json(alias: str, cols: list[str]) -> str:
    parts = ", ".join(f"'{c}', {alias}.{c}" for c in cols)
    return f"json_object({parts})::VARCHAR"


_OI_COLS = ["id", "province_id", "order_status", "user_id", "final_total_amount",
            "benefit_reduce_amount", "original_total_amount", "feight_fee", "create_time"]
_OD_COLS = ["id", "order_id", "sku_id", "order_price", "sku_num", "sku_name", "create_time"]
_DWD_COLS = _OI_COLS + ["create_date", "create_hour", "if_first_order", "province_name",
                        "province_area_code", "province_3166_2_code"]


WIDE_SELECT = """
SELECT od.id AS order_detail_id, dwd.id AS order_id, dwd.order_status, dwd.create_time,
       dwd.user_id, od.sku_id, od.order_price AS sku_price, od.sku_num, od.sku_name,
       dwd.benefit_reduce_amount, dwd.feight_fee, dwd.original_total_amount,
       dwd.final_total_amount, dwd.if_first_order, dwd.province_name,
       dwd.province_area_code, dwd.create_date AS dt
FROM dwd JOIN od ON od.order_id = dwd.id"""


def _w(ctes: str, body: str) -> str:
    return "WITH " + ctes + "\n" + body


_SQL = {
    "parse_app_log": _w(AL, """
SELECT mid, uid, ar, ch, vc, ts_ms AS ts, event_id, has_start, TRUE AS is_valid FROM al"""),

    "route_app_log": _w(AL_TEXT, """
SELECT CASE WHEN has_start THEN 'GMALL_START' ELSE 'GMALL_EVENT' END AS topic, value
FROM al_text"""),

    "dau_first_touch": _w(DAU, "SELECT * FROM dau"),

    "dau_hour_count": _w(HOURS, "SELECT dt, hr, cnt FROM hc"),

    "dau_total": _w(DAU, """
SELECT dt, replace(dt, '-', '') AS day_key, count(*) AS dau_total FROM dau GROUP BY dt"""),

    "dau_hour_compare": _w(HOURS, """
SELECT coalesce(t.dt, y.dt) AS dt, coalesce(t.hr, y.hr) AS hr,
       t.cnt AS today, y.cnt AS yesterday
FROM hc t
FULL OUTER JOIN (SELECT strftime(CAST(dt AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d') AS dt, hr, cnt
                 FROM hc) y
  ON t.dt = y.dt AND t.hr = y.hr"""),

    "realtime_total": _w(DAU + """,
tot AS (SELECT dt, count(*) AS n FROM dau GROUP BY dt),
fd AS (SELECT mid, min(dt) AS dt FROM dau GROUP BY mid),
nm AS (SELECT dt, count(*) AS n FROM fd GROUP BY dt)""", """
SELECT tot.dt, 'dau' AS id, '新增日活' AS name, tot.n AS value FROM tot
UNION ALL
SELECT tot.dt, 'new_mid' AS id, '新增设备' AS name, coalesce(nm.n, 0) AS value
FROM tot LEFT JOIN nm ON tot.dt = nm.dt"""),

    "dau_distinct_check": _w(DAU, """
SELECT r.dt, r.distinct_mids, d.dau_rows FROM
  (SELECT strftime(ts_raw, '%Y-%m-%d') AS dt, count(DISTINCT mid) AS distinct_mids
   FROM al GROUP BY 1) r
FULL OUTER JOIN (SELECT dt, count(*) AS dau_rows FROM dau GROUP BY dt) d ON r.dt = d.dt"""),

    "report_hour_json": _w(HOURS + """,
cmp AS (
  SELECT coalesce(t.dt, y.dt) AS dt, coalesce(t.hr, y.hr) AS hr, t.cnt AS today, y.cnt AS yesterday
  FROM hc t
  FULL OUTER JOIN (SELECT strftime(CAST(dt AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d') AS dt, hr, cnt
                   FROM hc) y
    ON t.dt = y.dt AND t.hr = y.hr)""", """
SELECT dt,
  '{"yesterday":{' || coalesce(string_agg(CASE WHEN yesterday IS NOT NULL
        THEN '"' || hr || '":' || yesterday END, ',' ORDER BY hr), '')
  || '},"today":{' || coalesce(string_agg(CASE WHEN today IS NOT NULL
        THEN '"' || hr || '":' || today END, ',' ORDER BY hr), '') || '}}' AS report
FROM cmp GROUP BY dt"""),

    "report_total_json": _w(DAU + """,
tot AS (SELECT dt, count(*) AS n FROM dau GROUP BY dt),
fd AS (SELECT mid, min(dt) AS dt FROM dau GROUP BY mid),
nm AS (SELECT dt, count(*) AS n FROM fd GROUP BY dt)""", """
SELECT tot.dt,
       '[' || json_object('id', 'dau', 'name', '新增日活', 'value', tot.n)::VARCHAR || ','
       || json_object('id', 'new_mid', 'name', '新增设备', 'value', coalesce(nm.n, 0))::VARCHAR
       || ']' AS report
FROM tot LEFT JOIN nm ON tot.dt = nm.dt"""),

    "raw_log_archive": _w(AL_TEXT, """
SELECT strftime(ts_raw, '%Y-%m-%d') AS dt, count(*) AS n_lines,
       CAST(sum(length(value)) AS BIGINT) AS n_chars,
       bit_xor(('0x' || substr(md5(value), 1, 15))::BIGINT) AS text_code
FROM al_text GROUP BY 1"""),

    "cdc_route_canal": _w(OI + ",\n" + OD, f"""
SELECT 'ODS_ORDER_INFO' AS topic, {_quoted_json('oi', _OI_COLS)} AS value
FROM oi WHERE oi.order_status <> 'P'
UNION ALL
SELECT 'ODS_ORDER_DETAIL' AS topic, {_quoted_json('od', _OD_COLS)} AS value
FROM od JOIN oi ON od.order_id = oi.id WHERE oi.order_status <> 'P'"""),

    "cdc_route_maxwell": _w(OI + ",\n" + OD + ",\n" + DIMS, f"""
SELECT 'ODS_ORDER_INFO' AS topic, {_typed_json('oi', _OI_COLS)} AS value
FROM oi WHERE oi.order_status <> 'P'
UNION ALL
SELECT 'ODS_ORDER_DETAIL', {_typed_json('od', _OD_COLS)}
FROM od JOIN oi ON od.order_id = oi.id WHERE oi.order_status <> 'P'
UNION ALL
SELECT 'ODS_BASE_PROVINCE', json_object('id', CAST(n_nationkey AS VARCHAR), 'name', n_name,
       'area_code', CAST(n_regionkey AS VARCHAR))::VARCHAR FROM nation
UNION ALL
SELECT 'ODS_USER_INFO', json_object('id', id, 'name', name, 'birthday', birthday,
       'gender', gender)::VARCHAR
FROM usr WHERE CAST(id AS BIGINT) % 100 <> 0
UNION ALL
SELECT 'ODS_SPU_INFO', json_object('id', id, 'spu_name', spu_name)::VARCHAR FROM spu
UNION ALL
SELECT 'ODS_SKU_INFO', json_object('id', id, 'spu_id', spu_id, 'sku_name', sku_name, 'tm_id', tm_id,
       'category3_id', category3_id)::VARCHAR FROM sku
UNION ALL
SELECT 'ODS_BASE_TRADEMARK', json_object('id', id, 'tm_name', tm_name)::VARCHAR FROM tm
UNION ALL
SELECT 'ODS_BASE_CATEGORY3', json_object('id', id, 'name', name)::VARCHAR FROM c3"""),

    "order_info_typed": _w(OI, "SELECT * FROM oit"),

    "order_detail_typed": _w(OD, "SELECT * FROM od"),

    "dim_province_latest": _w(PROV, "SELECT * FROM prov"),

    "user_state_lookup": _w(STATE, """
SELECT u.user_id, CASE WHEN st.user_id IS NULL THEN '0' ELSE '1' END AS if_consumed
FROM (SELECT DISTINCT user_id FROM b) u LEFT JOIN st ON u.user_id = st.user_id"""),

    "first_order_flag": _w(STATE, """
SELECT r.id, r.user_id, r.create_time,
       CASE WHEN r.rn = 1 AND st.user_id IS NULL THEN '1' ELSE '0' END AS if_first_order
FROM (SELECT id, user_id, create_time,
             row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) AS rn
      FROM b) r
LEFT JOIN st ON r.user_id = st.user_id"""),

    "first_order_flag_empty_state": _w(FLAG_ALL, """
SELECT id, user_id, create_time, if_first_order FROM fl"""),

    "province_enrich": _w(OI + ",\n" + PROV, """
SELECT oi.id, oi.province_id, prov.name AS province_name, prov.area_code AS province_area_code,
       prov.iso_3166_2 AS province_3166_2_code
FROM oi LEFT JOIN prov ON oi.province_id = CAST(prov.id AS BIGINT)"""),

    "user_state_upsert": _w(OI, """
SELECT CAST(user_id AS VARCHAR) AS user_id, '1' AS if_consumed,
       CASE WHEN min(create_time) < '1996-01-01' THEN 0 ELSE 1 END AS batch_id
FROM oi GROUP BY user_id"""),

    "dwd_order_info_messages": _w(DWD, f"""
SELECT 'DWD_ORDER_INFO' AS topic, CAST(user_id AS VARCHAR) AS key,
       {_typed_json('dwd', _DWD_COLS)} AS value
FROM dwd"""),

    "order_wide": _w(DWD + ",\n" + OD, WIDE_SELECT),

    # Net effect of the 15 s / 5 s sliding-window join plus pair dedup: the
    # two rows' 5-second arrival batches are at most two apart.
    "order_wide_dedup": _w(DWD + ",\n" + OD, WIDE_SELECT + """
WHERE abs(floor(epoch(CAST(od.create_time AS TIMESTAMP)) / 5)
          - floor(epoch(CAST(dwd.create_time AS TIMESTAMP)) / 5)) <= 2"""),

    "order_wide_interval": _w(DWD + ",\n" + OD, WIDE_SELECT + """
WHERE abs(epoch(CAST(od.create_time AS TIMESTAMP))
          - epoch(CAST(dwd.create_time AS TIMESTAMP))) <= 10"""),

    "sliding_window_counts": """
SELECT strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(make_timestamp((s + 15) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end,
       count(*) AS cnt
FROM (SELECT (epoch_us(ts) // 5000000) * 5 - k AS s
      FROM events, (SELECT unnest([0, 5, 10]) AS k))
GROUP BY s""",

    "detail_amount_split": _w(OI + ",\n" + OD, """
SELECT order_detail_id, order_id, CAST(cents AS BIGINT) AS cents,
       CAST(cents AS DOUBLE) / 100.0 AS final_detail_amount FROM (
  SELECT od.id AS order_detail_id, od.order_id,
         (fc * w) // tw
         + CASE WHEN od.id = max(od.id) OVER (PARTITION BY od.order_id)
                THEN fc - sum((fc * w) // tw) OVER (PARTITION BY od.order_id) ELSE 0 END
           AS cents
  FROM (SELECT od.*, CAST(round(order_price * 100) AS BIGINT) * sku_num AS w,
               sum(CAST(round(order_price * 100) AS BIGINT) * sku_num)
                 OVER (PARTITION BY order_id) AS tw
        FROM od) od
  JOIN (SELECT id, CAST(round(final_total_amount * 100) AS BIGINT) AS fc FROM oi) o
    ON od.order_id = o.id)"""),

    "detail_dims": _w(OD + ",\n" + DIMS, """
SELECT od.id AS order_detail_id, od.sku_id,
       CAST(sku.spu_id AS BIGINT) AS spu_id,
       CAST(sku.tm_id AS BIGINT) AS tm_id, CAST(sku.category3_id AS BIGINT) AS category3_id,
       spu.spu_name, tm.tm_name, c3.name AS category3_name
FROM od
LEFT JOIN sku ON od.sku_id = CAST(sku.id AS BIGINT)
LEFT JOIN tm ON CAST(sku.tm_id AS BIGINT) = CAST(tm.id AS BIGINT)
LEFT JOIN c3 ON CAST(sku.category3_id AS BIGINT) = CAST(c3.id AS BIGINT)
LEFT JOIN spu ON CAST(sku.spu_id AS BIGINT) = CAST(spu.id AS BIGINT)"""),

    "order_user_dim": _w(OI + ",\n" + DIMS, """
SELECT oit.id, oit.user_id, oit.create_date,
       CASE WHEN usr.birthday IS NULL THEN NULL
            WHEN a <= 20 THEN '<=20' WHEN a <= 30 THEN '21-30' ELSE '>30' END AS user_age_group,
       usr.gender AS user_gender
FROM oit LEFT JOIN usr ON oit.user_id = CAST(usr.id AS BIGINT),
LATERAL (SELECT date_sub('year', CAST(usr.birthday AS DATE),
                         CAST(oit.create_date AS DATE)) AS a)"""),

    "match_top20": """
SELECT p_partkey, p_name, p_retailprice FROM part
WHERE list_has_any(string_split_regex(lower(p_name), '[^a-z0-9]+'), ['red'])
ORDER BY p_retailprice NULLS FIRST, p_partkey LIMIT 20""",

    "bulk_upsert_latest": _w(AL, """
SELECT mid, uid, ar, ch, vc, dt, hr, mi, ts FROM (
  SELECT mid, uid, ar, ch, vc, strftime(ts_raw, '%Y-%m-%d') AS dt, strftime(ts_raw, '%H') AS hr,
         strftime(ts_raw, '%M') AS mi, ts_ms AS ts,
         row_number() OVER (PARTITION BY mid, strftime(ts_raw, '%Y-%m-%d')
                            ORDER BY ts_ms DESC, event_id DESC) AS rn
  FROM al) WHERE rn = 1"""),

    "rows_as_json": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       json_object('c_custkey', c_custkey, 'c_name', c_name, 'c_nationkey', c_nationkey,
                   'c_acctbal', c_acctbal, 'c_mktsegment', c_mktsegment)::VARCHAR AS value
FROM customer""",
}

_SQL["dwd_order_detail_messages"] = _w(OD, f"""
SELECT 'DWD_ORDER_DETAIL' AS topic, {_typed_json('od', _OD_COLS)} AS value FROM od""")

# Streaming jobs end in the same table as their batch counterparts.
_SQL["stream_route_app_log"] = _SQL["route_app_log"]
_SQL["stream_cdc_route_canal"] = _SQL["cdc_route_canal"]
_SQL["stream_cdc_route_maxwell"] = _SQL["cdc_route_maxwell"]
_SQL["stream_dim_province"] = _SQL["dim_province_latest"]
_SQL["stream_dwd_order_detail"] = _SQL["dwd_order_detail_messages"]
_SQL["stream_dau"] = _SQL["dau_first_touch"]
_SQL["stream_restart"] = _SQL["dau_first_touch"]
_SQL["stream_first_order"] = _SQL["first_order_flag"]
_SQL["stream_replay"] = _SQL["first_order_flag"]
_SQL["stream_order_wide"] = _SQL["order_wide_interval"]


_SQL["stream_dau_late"] = _SQL["dau_first_touch"]
_SQL["stream_redelivery"] = _SQL["first_order_flag"]
_SQL["stream_order_wide_late"] = _SQL["order_wide_interval"]
_SQL["stream_order_pipeline"] = _SQL["order_wide_interval"]
_SQL["dim_province_same_batch"] = _SQL["dim_province_latest"]

_SQL["order_info_quarantine"] = _w(OI, """
SELECT CASE WHEN id % 50 < 3 THEN 'QUARANTINE' ELSE 'DWD_ORDER_INFO' END AS topic,
       CASE id % 50
         WHEN 0 THEN 'garbage ' || id
         WHEN 1 THEN '{"id":"' || id || '","user_id":"' || user_id
                     || '","final_total_amount":"much"}'
         WHEN 2 THEN '{"id":"' || id || '","user_id":"' || user_id
                     || '","create_time":"2020-01-01"}'
         ELSE CAST(id AS VARCHAR) END AS value
FROM oi""")

_SQL["order_wide_full"] = f"""
SELECT w.*, s.final_detail_amount, u.user_age_group, u.user_gender, d.spu_id, d.tm_id,
       d.category3_id, d.spu_name, d.tm_name, d.category3_name
FROM ({_SQL["order_wide"]}) w
JOIN ({_SQL["detail_amount_split"]}) s ON s.order_detail_id = w.order_detail_id
JOIN ({_SQL["detail_dims"]}) d ON d.order_detail_id = w.order_detail_id
JOIN ({_SQL["order_user_dim"]}) u ON u.id = w.order_id"""


_SQL["stream_sliding_window_counts"] = _SQL["sliding_window_counts"]
_SQL["stream_dau_hours"] = _SQL["dau_hour_count"]

_SQL["stream_progress"] = """
WITH s AS (
  SELECT least(greatest(floor((event_id - lo) / ((hi - lo) / 120)), 0), 119) AS slice
  FROM events, (SELECT CAST(min(event_id) AS DOUBLE) AS lo, CAST(max(event_id) AS DOUBLE) AS hi FROM events))
SELECT count(DISTINCT slice) AS batches, count(DISTINCT slice) AS ranges, count(*) AS n_rows,
       CAST(0 AS BIGINT) AS gaps, CAST(0 AS BIGINT) AS late
FROM s"""

# Batch k holds the k-th quarter of the orders' period and was first run when
# the provinces were at their k-th change.
_SQL["stream_replay_dimension"] = _w(STATE, """
SELECT r.id, r.user_id, r.create_time,
       CASE WHEN r.rn = 1 AND st.user_id IS NULL THEN '1' ELSE '0' END AS if_first_order,
       'V' || CAST(least(greatest(floor((t - lo) / ((hi - lo) / 4)), 0), 3) AS BIGINT) || '_' || n_name
         AS province_name
FROM (SELECT id, user_id, province_id, create_time, CAST(epoch(CAST(create_time AS TIMESTAMP)) AS DOUBLE) AS t,
             row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) AS rn FROM b) r
LEFT JOIN st ON r.user_id = st.user_id
LEFT JOIN nation ON n_nationkey = r.province_id,
(SELECT min(CAST(epoch(CAST(create_time AS TIMESTAMP)) AS DOUBLE)) AS lo,
        max(CAST(epoch(CAST(create_time AS TIMESTAMP)) AS DOUBLE)) AS hi FROM b)""")

_SQL["stream_quarantine"] = _w(AL + ",\n" + OD, """
SELECT 'route' AS job, CASE WHEN event_id % 50 = 0 THEN 'QUARANTINE'
                            WHEN has_start AND event_id % 50 <> 1 THEN 'GMALL_START'
                            ELSE 'GMALL_EVENT' END AS topic, count(*) AS n FROM al GROUP BY 2
UNION ALL
SELECT 'dau', 'QUARANTINE', count(*) FROM al WHERE event_id % 50 < 2
UNION ALL
SELECT 'dau', 'device_days', count(DISTINCT mid || strftime(ts_raw, '%Y-%m-%d')) FROM al WHERE event_id % 50 >= 2
UNION ALL
SELECT 'detail', CASE WHEN id % 50 < 2 THEN 'QUARANTINE' ELSE 'DWD_ORDER_DETAIL' END, count(*) FROM od GROUP BY 2""")

_SQL["cdc_quarantine"] = _w(OI, f"""
SELECT CASE WHEN id % 50 < 2 THEN 'QUARANTINE' ELSE 'ODS_ORDER_INFO' END AS topic,
       CASE id % 50 WHEN 0 THEN '{{"table":"order_info","type":"INSERT","data":"oops ' || id || '"}}'
                    WHEN 1 THEN 'garbage ' || id ELSE {_quoted_json('oi', _OI_COLS)} END AS value
FROM oi WHERE id % 50 <> 2""")

_SQL["dim_province_deleted"] = _w(OI, """
SELECT oi.id, oi.province_id, p.name AS province_name, p.area_code AS province_area_code,
       p.iso AS province_3166_2_code
FROM oi LEFT JOIN (
  SELECT n_nationkey AS k, CASE WHEN n_nationkey = 10 THEN 'BACK_' WHEN n_nationkey % 2 = 1 THEN 'OLD_' ELSE '' END
         || n_name AS name, CAST(n_regionkey AS VARCHAR) AS area_code, 'ISO-' || n_nationkey AS iso
  FROM nation WHERE n_nationkey % 5 <> 0 OR n_nationkey = 10) p ON p.k = oi.province_id""")

_SQL["device_report"] = _w(DAU, """
SELECT d.dt, count(DISTINCT d.mid) AS devices,
       (SELECT count(DISTINCT x.mid) FROM dau x WHERE CAST(x.dt AS DATE)
          BETWEEN CAST(d.dt AS DATE) - 6 AND CAST(d.dt AS DATE)) AS trailing,
       (SELECT count(*) FROM (SELECT mid FROM dau GROUP BY mid HAVING min(dt) = d.dt)) AS new_mid
FROM dau d GROUP BY d.dt""")

_SQL["match_top20_index"] = """
SELECT * FROM (SELECT 'red' AS query, p_partkey, p_name, p_retailprice FROM part
WHERE list_has_any(string_split_regex(lower(p_name), '[^a-z0-9]+'), ['red'])
ORDER BY p_retailprice NULLS FIRST, p_partkey LIMIT 20)
UNION ALL
SELECT * FROM (SELECT 'Blue, RING' AS query, p_partkey, p_name, p_retailprice FROM part
WHERE list_has_any(string_split_regex(lower(p_name), '[^a-z0-9]+'), ['blue', 'ring'])
ORDER BY p_retailprice NULLS FIRST, p_partkey LIMIT 20)"""

_SQL["parse_app_log_variant"] = _w(AL, """
SELECT CASE WHEN ok THEN mid END AS mid, CASE WHEN ok THEN uid END AS uid, CASE WHEN ok THEN ar END AS ar,
       CASE WHEN ok THEN ch END AS ch, CASE WHEN ok THEN vc END AS vc, CASE WHEN ok THEN ts_ms END AS ts,
       CASE WHEN ok THEN event_id END AS event_id, coalesce(ok AND has_start, FALSE) AS has_start,
       CASE WHEN ok THEN CAST(event_id % 7 AS VARCHAR) END AS first_item, CASE WHEN ok THEN ch END AS second_tag,
       CAST(NULL AS VARCHAR) AS absent, ok AS is_valid
FROM (SELECT *, event_id % 50 <> 0 AS ok FROM al)""")


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
