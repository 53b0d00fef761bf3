"""Dimension tables from ODS change messages and their lookups.

Each dimension is parsed from its ODS topic, reduced to the latest row per id
(so a lookup can never fan out), and left-joined. Adaptive execution broadcasts
a dimension whose measured size is small; a larger one is joined by a shuffle,
where a hot key (one SKU with a third of all lines) is split on the fact side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rtmart.functions import parse_typed
from rtmart.operators.upsert import latest_per_key
from rtmart.schemas import L, S

SKU_FIELDS = [("id", L), ("spu_id", L), ("tm_id", L), ("category3_id", L), ("sku_name", S)]
SPU_FIELDS = [("id", L), ("spu_name", S)]
TRADEMARK_FIELDS = [("id", L), ("tm_name", S)]
CATEGORY3_FIELDS = [("id", L), ("name", S)]
USER_FIELDS = [("id", L), ("name", S), ("birthday", S), ("gender", S)]

# The age groups used for ``user_age_group`` (age at order day).
AGE_GROUPS = [(20, "<=20"), (30, "21-30")]
AGE_GROUP_OLDEST = ">30"


def dim_latest(ods: DataFrame, fields, order_cols) -> DataFrame:
    """ODS JSON rows -> typed dimension, the last change per id.

    ``order_cols`` say which change is last: a sequence, or a topic's partition
    and offset. Without them that cannot be known, so they are required.
    """
    keep = list(order_cols)
    if not keep:
        raise ValueError("order columns are needed to tell the last change of an id")
    return latest_per_key(parse_typed(ods, "value", fields, keep=keep), ["id"], keep).drop(*keep)


def detail_dims(details: DataFrame, sku: DataFrame, trademark: DataFrame,
                category3: DataFrame, spu: DataFrame) -> DataFrame:
    """Add spu_id, tm_id, category3_id and their names to order details.

    The small dimensions are joined to the SKUs first, so the details are
    joined once.
    """
    t = trademark.select(F.col("id").alias("_tm"), "tm_name")
    c = category3.select(F.col("id").alias("_c3"), F.col("name").alias("category3_name"))
    p = spu.select(F.col("id").alias("_spu"), "spu_name")
    s = sku.select(F.col("id").alias("_sku"), "spu_id", "tm_id", "category3_id")
    s = (s.join(t, F.col("tm_id") == t._tm, "left").drop("_tm")
          .join(c, F.col("category3_id") == c._c3, "left").drop("_c3")
          .join(p, F.col("spu_id") == p._spu, "left").drop("_spu"))
    return details.join(s, details.sku_id == s._sku, "left").drop("_sku")


def age_group(age) -> F.Column:
    expr = None
    for bound, label in AGE_GROUPS:
        expr = (F.when(age <= bound, F.lit(label)) if expr is None
                else expr.when(age <= bound, F.lit(label)))
    return expr.otherwise(F.lit(AGE_GROUP_OLDEST))


def order_user_dim(orders: DataFrame, users: DataFrame) -> DataFrame:
    """``user_age_group`` (age on the order day) and ``user_gender``.

    The user dimension grows with the customer base: a shuffle join on user
    id, unless its measured size is small.
    """
    u = users.select(F.col("id").alias("_uid"), "birthday", "gender")
    j = orders.join(u, orders.user_id == u._uid, "left")
    age = F.floor(F.months_between(F.to_date("create_date"), F.to_date("birthday")) / 12)
    return (j.withColumn("user_age_group", F.when(F.col("birthday").isNotNull(), age_group(age)))
             .withColumnRenamed("gender", "user_gender")
             .drop("_uid", "birthday"))
