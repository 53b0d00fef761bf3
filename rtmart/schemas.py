"""Record schemas of the warehouse.

Messages are parsed field by field as text (change-data envelopes send numbers
quoted, ``{"id":"22"}``, which a ``bigint`` JSON leaf would read as null) and
then ``try_cast`` to the types below.
"""

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
D = T.DoubleType()


def _strings(*names):
    return [T.StructField(n, S) for n in names]


# Active-device document (one per device and event day).
DAU_INFO = T.StructType(
    _strings("mid", "uid", "ar", "ch", "vc", "dt", "hr", "mi") + [T.StructField("ts", L)])

# Fixed contract values: the fields of the order and detail records, in the
# order the messages declare them.
ORDER_INFO_FIELDS = [
    ("id", L), ("province_id", L), ("order_status", S), ("user_id", L),
    ("final_total_amount", D), ("benefit_reduce_amount", D),
    ("original_total_amount", D), ("feight_fee", D),
    ("expire_time", S), ("create_time", S), ("operate_time", S),
]
ORDER_DETAIL_FIELDS = [
    ("id", L), ("order_id", L), ("sku_id", L), ("order_price", D),
    ("sku_num", L), ("sku_name", S), ("create_time", S),
]
PROVINCE_FIELDS = [("id", S), ("name", S), ("area_code", S), ("iso_code", S),
                   ("iso_3166_2", S)]


# Wide order row, in output order.
ORDER_WIDE_COLUMNS = [
    "order_detail_id", "order_id", "order_status", "create_time", "user_id",
    "sku_id", "sku_price", "sku_num", "sku_name", "benefit_reduce_amount",
    "feight_fee", "original_total_amount", "final_total_amount",
    "if_first_order", "province_name", "province_area_code", "dt",
]

# The wide row with every dimension, in contract order.
ORDER_WIDE_FULL_COLUMNS = [
    "order_detail_id", "order_id", "order_status", "create_time", "user_id",
    "sku_id", "sku_price", "sku_num", "sku_name", "benefit_reduce_amount",
    "feight_fee", "original_total_amount", "final_total_amount", "final_detail_amount",
    "if_first_order", "province_name", "province_area_code", "user_age_group",
    "user_gender", "dt", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name",
    "category3_name",
]

# Detail-layer order message (the order record after flag and enrichment).
DWD_ORDER_INFO_FIELDS = ORDER_INFO_FIELDS + [
    ("create_date", S), ("create_hour", S), ("if_first_order", S), ("province_name", S),
    ("province_area_code", S), ("province_3166_2_code", S),
]
