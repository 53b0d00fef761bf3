"""Routing of raw messages to topics.

Output frames carry ``topic`` and ``value``; a sink writes them per topic
(Kafka's per-row ``topic`` column, or ``partitionBy('topic')`` for files).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rtmart.functions import json_fields

# Topic names and the change-data whitelists of the reference.
START_TOPIC = "GMALL_START"
EVENT_TOPIC = "GMALL_EVENT"
ODS_PREFIX = "ODS_"
CANAL_TABLES = ("order_info", "order_detail")
CANAL_TYPE = "INSERT"
MAXWELL_FACT_TABLES = ("order_info", "order_detail")
MAXWELL_FACT_TYPE = "insert"
MAXWELL_DIM_TABLES = ("base_province", "user_info", "sku_info", "base_trademark",
                      "base_category3", "spu_info")
QUARANTINE_TOPIC = "QUARANTINE"


def ods_topic(table_col) -> F.Column:
    """P10: topic = 'ODS_' + upper(table)."""
    return F.concat(F.lit(ODS_PREFIX), F.upper(table_col))


def route_app_log(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """logs with a non-null ``start`` object go to GMALL_START, other JSON
    objects to GMALL_EVENT, all other texts to QUARANTINE. A JSON ``null``
    start counts as absent."""
    v = F.col(value_col)
    topic = F.when(F.json_object_keys(v).isNull(), F.lit(QUARANTINE_TOPIC)) \
             .when(F.get_json_object(v, "$.start").isNotNull(), F.lit(START_TOPIC)) \
             .otherwise(F.lit(EVENT_TOPIC))
    return raw.select(topic.alias("topic"), v.alias("value"))


def route_canal(envelopes: DataFrame, value_col: str = "value",
                with_quarantine: bool = True) -> DataFrame:
    """F2 + P11: whitelisted Canal envelopes -> one message per ``data`` element.

    Elements stay raw JSON text. Envelopes that name no table, and whitelisted
    ones whose ``data`` is no array, go to QUARANTINE whole, unless
    ``with_quarantine`` is off. One parse and one output per envelope decide.
    """
    raw = envelopes.select(F.col(value_col).alias("raw"))
    parsed = json_fields(raw, "raw", ["table", "type", "data"], keep=["raw"], prefix="e_")
    listed = F.col("e_table").isin(*CANAL_TABLES) & (F.col("e_type") == CANAL_TYPE)
    is_array = F.substring(F.ltrim("e_data"), 1, 1) == "["
    parsed = parsed.withColumn("e_rows", F.when(listed & is_array, F.from_json("e_data", "array<string>")))
    bad = F.col("e_table").isNull() | (listed & F.col("e_rows").isNull())
    good_rows = F.transform("e_rows", lambda r: F.struct(
        ods_topic(F.col("e_table")).alias("topic"), r.alias("value")))
    if not with_quarantine:
        return parsed.where(listed).select(F.inline(good_rows))
    bad_rows = F.array(F.struct(F.lit(QUARANTINE_TOPIC).alias("topic"), F.col("raw").alias("value")))
    return parsed.where(listed | bad).select(F.inline(F.when(bad, bad_rows).otherwise(good_rows)))


def route_maxwell(envelopes: DataFrame, value_col: str = "value",
                  with_quarantine: bool = True, with_op: bool = False, keep: tuple = ()) -> DataFrame:
    """F3 + F4: Maxwell envelopes -> ODS topics.

    Order facts pass only as inserts; the dimension tables pass with any change
    type (deletes included, as in the reference); ``with_op`` adds the change
    type ``op`` in lower case, so that a dimension's reader can tell a removed
    row, and ``keep`` names columns that come along (a topic's offset). A
    payload must be longer than 3 characters, which drops ``{}``.
    """
    raw = envelopes.select(*keep, F.col(value_col).alias("raw"))
    parsed = json_fields(raw, "raw", ["table", "type", "data"], keep=[*keep, "raw"], prefix="e_")
    data = F.col("e_data")
    listed = (data.isNotNull() & (F.length(data) > 3) & (
        (F.col("e_table").isin(*MAXWELL_FACT_TABLES) & (F.col("e_type") == MAXWELL_FACT_TYPE))
        | F.col("e_table").isin(*MAXWELL_DIM_TABLES)))
    op = [*([F.lower("e_type").alias("op")] if with_op else []), *keep]
    bad = F.col("e_table").isNull()
    if not with_quarantine:
        return parsed.where(listed).select(ods_topic(F.col("e_table")).alias("topic"),
                                         data.alias("value"), *op)
    return parsed.where(listed | bad).select(
        F.when(bad, QUARANTINE_TOPIC).otherwise(ods_topic(F.col("e_table"))).alias("topic"),
        F.when(bad, F.col("raw")).otherwise(data).alias("value"), *op)
