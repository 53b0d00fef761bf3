"""Adapters: how the test tables play the messages the warehouse consumes.

The reference consumes JSON messages (app logs, change-data envelopes) and
keyed tables. These functions derive those messages from the given parquet
tables, as DataFrames, so every query's work grows with the tables. Each rule
here is repeated as a CTE in the matching oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rtmart.functions import epoch_millis, timestamp_to_text, to_json_row

# Fixed values of the adapters.
START_TOPIC_EVENT_TYPE = "signup"       # events of this type carry a `start` object
STATE_CUTOFF = "1996-01-01"             # orders before: prior user state; from it on: the batch
DB_NAME = "shop"


# ---------------------------------------------------------------- app logs

def app_log_columns(events: DataFrame) -> DataFrame:
    """events -> the fields of an app log record (not yet serialised)."""
    return events.select(
        F.struct(
            F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"),
            F.col("user_id").cast("string").alias("uid"),
            (F.col("user_id") % 25).cast("string").alias("ar"),
            F.col("event_type").alias("ch"),
            F.get_json_object("props", "$.k").alias("vc"),
        ).alias("common"),
        F.when(F.col("event_type") == START_TOPIC_EVENT_TYPE,
               F.struct(F.lit("icon").alias("entry"))).alias("start"),
        epoch_millis("ts").alias("ts"),
        F.col("event_id"),
    )


def app_log_text(events: DataFrame) -> DataFrame:
    """events -> one raw JSON log line per event, column ``value``.

    ``start`` is present only on start logs (to_json drops the null field).
    """
    c = app_log_columns(events)
    return c.select(to_json_row("common", "start", "ts", "event_id").alias("value"))


def app_log_text_dirty(events: DataFrame) -> DataFrame:
    """Log lines, some unusable: by the event's id, one in 50 each is no JSON, or an
    object that names no device."""
    id_ = F.col("event_id").cast("string")
    kind = F.col("event_id") % 50
    return app_log_columns(events).select(
        F.when(kind == 0, F.concat(F.lit("garbage "), id_))
        .when(kind == 1, F.concat(F.lit('{"ts":"'), id_, F.lit('"}')))
        .otherwise(to_json_row("common", "start", "ts", "event_id")).alias("value"))


def app_log_text_nested(events: DataFrame) -> DataFrame:
    """Log lines with an array of objects; one in 50 is cut off."""
    displays = F.array(F.struct((F.col("event_id") % 7).alias("item"),
                                F.array(F.lit("x"), F.col("common.ch")).alias("tags")))
    text = to_json_row("common", "start", "ts", "event_id", displays.alias("displays"))
    return app_log_columns(events).select(
        F.when(F.col("event_id") % 50 == 0, F.substring(text, 1, 20)).otherwise(text).alias("value"))


# ---------------------------------------------------------------- orders

def order_info_rows(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """orders + customer -> typed order records (``oi``)."""
    o = spread(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                             "o_orderdate"))
    c = customer.select(F.col("c_custkey"), F.col("c_nationkey"))
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    final = F.col("o_totalprice")
    benefit = (F.col("o_orderkey") % 50).cast("double")
    freight = (F.col("o_orderkey") % 20).cast("double")
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.col("c_nationkey").cast("bigint").alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        final.alias("final_total_amount"),
        benefit.alias("benefit_reduce_amount"),
        F.round(final + benefit - freight, 2).alias("original_total_amount"),
        freight.alias("feight_fee"),
        F.lit(None).cast("string").alias("expire_time"),
        timestamp_to_text("o_orderdate", F.col("o_orderkey") % 86400).alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"),
    )


DETAIL_COLUMNS = ["id", "order_id", "sku_id", "order_price", "sku_num", "sku_name",
                  "create_time"]


def _line_id() -> F.Column:
    values = F.concat_ws(
        "|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(F.col("l_extendedprice") * 100).cast("bigint"),
        F.col("l_quantity").cast("bigint"))
    return F.conv(F.substring(F.md5(values), 1, 15), 16, 10).cast("bigint")


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer tasks than the session runs at once, dealt to as many.

    A small test file is one or two tasks however wide the work after it is;
    a scan that has enough tasks by itself stays as it is, without a shuffle.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    tasks = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df if tasks >= wanted else df.repartition(wanted)


def order_detail_rows(lineitem: DataFrame, orders: DataFrame, part: DataFrame,
                      with_order_status: bool = False) -> DataFrame:
    """lineitem + orders + part -> typed order-detail records (``od``).

    ``(l_orderkey, l_linenumber)`` is not unique in the test data; the line's
    own values are, so the detail id is the first 60 bits of their MD5. No
    line has to know of another one. With ``with_order_status`` the order's
    status rides along (the change-data adapters need it; the orders join is
    already there).
    """
    # ids and texts are made after the joins: their source values are smaller to shuffle
    li = spread(lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                                "l_extendedprice", "l_linenumber"))
    o = orders.select("o_orderkey", "o_orderdate", "o_orderstatus")
    p = part.select("p_partkey", "p_name")
    # orders last: the lines then lie by order, as envelopes of an order need them
    j = (li.join(p, li.l_partkey == p.p_partkey, "left")
           .join(o, li.l_orderkey == o.o_orderkey, "inner"))
    return j.select(
        _line_id().alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.col("p_name").alias("sku_name"),
        timestamp_to_text("o_orderdate", F.col("o_orderkey") % 86400
                          + 4 * F.col("l_linenumber"))
        .alias("create_time"),
        *([F.col("o_orderstatus").alias("order_status")] if with_order_status else []),
    )


def _quoted(df: DataFrame) -> list:
    """All columns as strings: change-data rows send every value quoted."""
    return [F.col(c).cast("string").alias(c) for c in df.columns]


def order_info_value(oi: DataFrame) -> F.Column:
    """The text of an ODS_ORDER_INFO message: one JSON object, values quoted."""
    return to_json_row(*_quoted(oi)).alias("value")


def order_info_text(oi: DataFrame, keep: tuple = ()) -> DataFrame:
    """ODS_ORDER_INFO messages: one JSON object per order, values quoted; ``keep``
    are columns that come along."""
    return oi.select(order_info_value(oi), *keep)


def order_info_text_dirty(oi: DataFrame) -> DataFrame:
    """ODS_ORDER_INFO messages, some of them unusable: by the order's id, one
    in 50 each is no JSON, has a number that is none, or a time without a
    clock part."""
    id_ = F.col("id").cast("string")
    user = F.col("user_id").cast("string")
    kind = F.col("id") % 50
    return oi.select(
        F.when(kind == 0, F.concat(F.lit("garbage "), id_))
        .when(kind == 1, F.concat(F.lit('{"id":"'), id_, F.lit('","user_id":"'), user,
                                  F.lit('","final_total_amount":"much"}')))
        .when(kind == 2, F.concat(F.lit('{"id":"'), id_, F.lit('","user_id":"'), user,
                                  F.lit('","create_time":"2020-01-01"}')))
        .otherwise(to_json_row(*_quoted(oi))).alias("value"))


def order_detail_text(od: DataFrame) -> DataFrame:
    """ODS_ORDER_DETAIL messages: one JSON object per line, values quoted."""
    return od.select(to_json_row(*_quoted(od)).alias("value"))


def order_detail_text_dirty(od: DataFrame) -> DataFrame:
    """ODS_ORDER_DETAIL messages, some unusable: by the line's id, one in 50 each is
    no JSON, or has no time."""
    kind = F.col("id") % 50
    id_ = F.col("id").cast("string")
    return od.select(
        F.when(kind == 0, F.concat(F.lit("garbage "), id_))
        .when(kind == 1, F.concat(F.lit('{"id":"'), id_, F.lit('","order_id":"1"}')))
        .otherwise(to_json_row(*_quoted(od))).alias("value"))


# ---------------------------------------------------------------- dimensions

def province_renamed(nation: DataFrame, prefix: str) -> DataFrame:
    """Province change texts, every name with ``prefix``."""
    key = F.col("n_nationkey").cast("string")
    return nation.select(to_json_row(
        key.alias("id"), F.concat(F.lit(prefix), F.col("n_name")).alias("name"),
        F.col("n_regionkey").cast("string").alias("area_code"),
        F.concat(F.lit("CN-"), key).alias("iso_code"),
        F.concat(F.lit("ISO-"), key).alias("iso_3166_2")).alias("value"))


# The change records of the provinces, in order: type, names, keys.
PROVINCE_CHANGES = [("bootstrap-insert", "OLD_", "n_nationkey >= 0"), ("update", "", "n_nationkey % 2 = 0"),
                    ("delete", "", "n_nationkey % 5 = 0"), ("insert", "BACK_", "n_nationkey = 10")]


def province_change_envelopes(nation: DataFrame) -> DataFrame:
    """Maxwell envelopes (value, seq) of PROVINCE_CHANGES; a delete carries the removed row."""
    out = None
    for seq, (op, prefix, keys) in enumerate(PROVINCE_CHANGES):
        data = province_renamed(nation.where(keys), prefix).select(F.concat(
            F.lit(f'{{"database":"{DB_NAME}","table":"base_province","type":"{op}","ts":0,"data":'),
            F.col("value"), F.lit("}")).alias("value"), F.lit(seq).cast("long").alias("seq"))
        out = data if out is None else out.unionByName(data)
    return out


def province_versions(nation: DataFrame) -> DataFrame:
    """Province dimension change rows in two versions.

    Version 1 names every province ``OLD_<name>``; version 2 re-sends the even
    keys with the real name. Columns: ``batch_id, seq, value`` (JSON text).
    """
    base = nation.select("n_nationkey", "n_name", "n_regionkey")

    def rows(version, name_col, cond):
        return base.where(cond).select(
            F.lit(version).cast("bigint").alias("batch_id"),
            F.col("n_nationkey").cast("bigint").alias("seq"),
            to_json_row(
                F.col("n_nationkey").cast("string").alias("id"),
                name_col.alias("name"),
                F.col("n_regionkey").cast("string").alias("area_code"),
                F.concat(F.lit("CN-"), F.col("n_nationkey").cast("string")).alias("iso_code"),
                F.concat(F.lit("ISO-"), F.col("n_nationkey").cast("string")).alias("iso_3166_2"),
            ).alias("value"))

    v1 = rows(1, F.concat(F.lit("OLD_"), F.col("n_name")), F.lit(True))
    v2 = rows(2, F.col("n_name"), F.col("n_nationkey") % 2 == 0)
    return v1.unionByName(v2)


# ---------------------------------------------------------------- user state

def split_orders_by_state_cutoff(oi: DataFrame, cutoff: str = STATE_CUTOFF):
    """-> (orders before cutoff: they make the prior user state, the batch)."""
    before = oi.where(F.col("create_time") < F.lit(cutoff))
    batch = oi.where(F.col("create_time") >= F.lit(cutoff))
    return before, batch


# ---------------------------------------------------------------- dimensions from part / customer

SKU_COLUMNS = ["id", "spu_id", "sku_name", "tm_id", "category3_id"]
USER_COLUMNS = ["id", "name", "birthday", "gender"]


def _brand_id(col) -> F.Column:
    return F.regexp_extract(col, r"#(\d+)", 1)


def sku_rows(part: DataFrame) -> DataFrame:
    """SKU dimension rows: id, product id (the part's size), name, trademark id
    (the brand number) and category id (derived from the type name)."""
    return part.select(F.col("p_partkey").cast("string").alias("id"),
                       F.col("p_size").cast("string").alias("spu_id"),
                       F.col("p_name").alias("sku_name"),
                       _brand_id(F.col("p_brand")).alias("tm_id"),
                       _name_id(F.col("p_type")).alias("category3_id"))


def spu_rows(part: DataFrame) -> DataFrame:
    """Product rows, one per part size."""
    size = F.col("p_size").cast("string")
    return (part.where("p_size IS NOT NULL").select("p_size").distinct()
                .select(size.alias("id"), F.concat(F.lit("SPU_"), size).alias("spu_name")))


def resent(rows: DataFrame, names: list[str]) -> DataFrame:
    """Each row as two changes (``seq`` 1 and 2): the earlier one holds values
    that sort after the real ones, the later one the real ones."""
    stale = rows.select(*[(F.concat(F.lit("~"), F.col(c)) if c in names else F.col(c)).alias(c)
                          for c in rows.columns], F.lit(1).cast("bigint").alias("seq"))
    return rows.withColumn("seq", F.lit(2).cast("bigint")).unionByName(stale)


def trademark_rows(part: DataFrame) -> DataFrame:
    return (part.select("p_brand").distinct()
                .select(_brand_id(F.col("p_brand")).alias("id"), F.col("p_brand").alias("tm_name")))


def _name_id(col) -> F.Column:
    """A stable numeric id from a name: the first 48 bits of its MD5."""
    return F.conv(F.substring(F.md5(col), 1, 12), 16, 10)


def category3_rows(part: DataFrame) -> DataFrame:
    """Category rows, one per distinct type; the id derives from the name, so
    no ranking (and no single task) is needed."""
    return (part.select("p_type").distinct()
                .select(_name_id(F.col("p_type")).alias("id"), F.col("p_type").alias("name")))


def user_rows(customer: DataFrame) -> DataFrame:
    """User dimension rows: birthday and gender derived from the key."""
    k = F.col("c_custkey")
    return customer.select(
        k.cast("string").alias("id"), F.col("c_name").alias("name"),
        F.format_string("%d-%02d-15", (k % 60 + 1940).cast("int"), (k % 12 + 1).cast("int"))
        .alias("birthday"),
        F.when(k % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"))


# ---------------------------------------------------------------- change data

def _with_status(od: DataFrame, oi: DataFrame) -> DataFrame:
    """Detail rows with their order's status (joined only if not carried)."""
    if "order_status" in od.columns:
        return od
    status = oi.select(F.col("id").alias("_oid"), "order_status")
    return od.join(status, od.order_id == status._oid, "inner").drop("_oid")


def _change_type(status_col, insert_word, update_word):
    return F.when(status_col == "P", F.lit(update_word)).otherwise(F.lit(insert_word))


def canal_envelopes(oi: DataFrame, od: DataFrame, customer: DataFrame,
                    envelopes_per_order: int = 1) -> DataFrame:
    """Canal-style envelopes, column ``value``.

    Orders: one envelope each; details: one per order, or the lines dealt by
    their id to ``envelopes_per_order`` envelopes where orders are too large
    for one message; type INSERT unless the order status is P (then UPDATE).
    Customers: user_info INSERTs (not routed downstream).
    """
    def envelope(table, data_arr, typ, ts):
        return to_json_row(
            data_arr.alias("data"), F.lit(DB_NAME).alias("database"),
            F.lit(False).alias("isDdl"), F.array(F.lit("id")).alias("pkNames"),
            F.lit(table).alias("table"), ts.alias("ts"), typ.alias("type"))

    def row_json(df):
        return F.struct(*_quoted(df))

    ts_of = lambda c: F.unix_millis(F.to_timestamp(c, "yyyy-MM-dd HH:mm:ss"))
    orders_env = oi.select(envelope(
        "order_info", F.array(row_json(oi)),
        _change_type(F.col("order_status"), "INSERT", "UPDATE"),
        ts_of(F.col("create_time"))).alias("value"))

    d = _with_status(od, oi).select(
        "order_id", "order_status", "create_time",
        F.pmod(F.col("id"), F.lit(envelopes_per_order)).alias("chunk"),
        F.struct(*[F.col(c).cast("string").alias(c) for c in DETAIL_COLUMNS]).alias("row"))
    detail_env = (d.groupBy("order_id", "chunk")
                   .agg(F.collect_list("row").alias("rows"),
                        F.max("order_status").alias("order_status"),   # one per order
                        F.min("create_time").alias("create_time"))
                   .select(envelope("order_detail", F.col("rows"),
                                    _change_type(F.col("order_status"), "INSERT", "UPDATE"),
                                    ts_of(F.col("create_time"))).alias("value")))

    cust = customer.select("c_custkey", "c_name", "c_nationkey")
    user_env = cust.select(envelope(
        "user_info",
        F.array(F.struct(F.col("c_custkey").cast("string").alias("id"),
                         F.col("c_name").alias("name"))),
        F.lit("INSERT"), F.lit(0).cast("bigint")).alias("value"))
    return orders_env.unionByName(detail_env).unionByName(user_env)


def canal_envelopes_dirty(oi: DataFrame) -> DataFrame:
    """Order envelopes, some unusable: by the order's id, one in 50 each has data that is
    no array, is no JSON, or is not whitelisted and has such data."""
    id_ = F.col("id").cast("string")
    kind = F.col("id") % 50
    bad = lambda typ: F.concat(F.lit('{"table":"order_info","type":"%s","data":"oops ' % typ),
                               id_, F.lit('"}'))
    return oi.select(
        F.when(kind == 0, bad("INSERT")).when(kind == 1, F.concat(F.lit("garbage "), id_))
        .when(kind == 2, bad("UPDATE"))
        .otherwise(to_json_row(F.array(F.struct(*_quoted(oi))).alias("data"), F.lit("order_info").alias("table"),
                               F.lit("INSERT").alias("type"))).alias("value"))


def maxwell_envelopes(oi: DataFrame, od: DataFrame, nation: DataFrame, customer: DataFrame,
                      part: DataFrame, region: DataFrame) -> DataFrame:
    """Maxwell-style envelopes (one row object each, typed values), column ``value``."""
    def envelope(table, data, typ):
        return to_json_row(F.lit(DB_NAME).alias("database"), F.lit(table).alias("table"),
                           typ.alias("type"), F.lit(0).cast("bigint").alias("ts"),
                           data.alias("data")).alias("value")

    def obj(*cols):
        return F.struct(*cols)

    orders_env = oi.select(envelope(
        "order_info", obj(*oi.columns), _change_type(F.col("order_status"), "insert", "update")))
    detail_env = _with_status(od, oi).select(envelope(
        "order_detail", obj(*DETAIL_COLUMNS),
        _change_type(F.col("order_status"), "insert", "update")))
    prov_env = nation.select(envelope(
        "base_province",
        obj(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"),
            F.col("n_regionkey").cast("string").alias("area_code")),
        F.lit("bootstrap-insert")))
    # an empty payload `{}` every 100th customer (all fields null are dropped)
    users = user_rows(customer)
    keep = F.col("id").cast("bigint") % 100 != 0
    user_env = users.select(envelope(
        "user_info", obj(*[F.when(keep, F.col(c)).alias(c) for c in USER_COLUMNS]),
        F.lit("update")))
    sku_env = sku_rows(part).select(envelope("sku_info", obj(*SKU_COLUMNS), F.lit("insert")))
    tm_env = trademark_rows(part).select(envelope("base_trademark", obj("id", "tm_name"),
                                                  F.lit("insert")))
    spu_env = spu_rows(part).select(envelope("spu_info", obj("id", "spu_name"), F.lit("insert")))
    cat_env = category3_rows(part).select(envelope("base_category3", obj("id", "name"),
                                                   F.lit("insert")))
    region_env = region.select(envelope(
        "base_region", obj(F.col("r_regionkey").cast("string").alias("id"),
                           F.col("r_name").alias("region_name")),
        F.lit("insert")))
    out = orders_env
    for e in (detail_env, prov_env, user_env, sku_env, tm_env, spu_env, cat_env, region_env):
        out = out.unionByName(e)
    return out
