"""Order x detail wide fact.

The join key is the order id: an order row is unique per id, so a hot order
only fans out on the detail side, which AQE's skew-join handling splits. The
amount split alone needs all lines of an order in one task: it sums them where
they are joined with their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rtmart.functions import text_seconds
from rtmart.schemas import ORDER_WIDE_COLUMNS, ORDER_WIDE_FULL_COLUMNS

__all__ = ["ORDER_WIDE_COLUMNS", "order_wide", "order_wide_windowed", "order_wide_interval",
           "sliding_window_counts", "detail_amount_split"]

# Fixed values of the reference's wide-order job (seconds).
BATCH_SECONDS = 5
WINDOW_SECONDS = 15
SLIDE_SECONDS = 5


def _info_side(info: DataFrame, more: tuple = ()) -> DataFrame:
    """Order fields of the wide row (``id``->order_id, create_date->dt)."""
    cols = [F.col("id").alias("order_id"), "order_status", "create_time", "user_id",
            "benefit_reduce_amount", "feight_fee", "original_total_amount",
            "final_total_amount", "if_first_order", "province_name", "province_area_code",
            F.col("create_date").alias("dt")]
    return info.select(*cols, *more)


def _detail_side(detail: DataFrame, more: tuple = ()) -> DataFrame:
    """Detail fields (``id``->order_detail_id, order_price->sku_price)."""
    return detail.select(F.col("id").alias("order_detail_id"), "order_id", "sku_id",
                         F.col("order_price").alias("sku_price"), "sku_num", "sku_name",
                         F.col("create_time").alias("_detail_time"), *more)


def order_wide(info: DataFrame, detail: DataFrame) -> DataFrame:
    """J1 (batch form): inner equi-join of orders and details on order id."""
    j = _info_side(info).join(_detail_side(detail), "order_id", "inner")
    return j.select(*ORDER_WIDE_COLUMNS)


def _seconds(create_time) -> F.Column:
    return F.unix_timestamp(F.to_timestamp(create_time, "yyyy-MM-dd HH:mm:ss"))


def order_wide_windowed(info: DataFrame, detail: DataFrame,
                        window_s: int = WINDOW_SECONDS, slide_s: int = SLIDE_SECONDS,
                        batch_s: int = BATCH_SECONDS) -> DataFrame:
    """J1 + D2 as the reference ran them: both sides cut into ``batch_s``
    arrival batches, joined inside every ``window_s``/``slide_s`` sliding
    window, and the repeated pairs removed by (order_id, order_detail_id).

    A row of batch b sits in the windows ending at b .. b + window/batch - 1
    (those on the slide grid). A pair is kept when its two batches share such
    a window, so nothing has to be repeated per window: messages delivered
    again are dropped on each side, then one join on the order id.
    """
    span = window_s // batch_s
    step = max(slide_s // batch_s, 1)
    batch_of = lambda c: F.floor(_seconds(F.col(c)) / batch_s)

    i = (_info_side(info).withColumn("_ib", batch_of("create_time"))
         .dropDuplicates(["order_id"]))
    d = (_detail_side(detail).withColumn("_db", batch_of("_detail_time"))
         .dropDuplicates(["order_id", "order_detail_id"]))
    last_shared = F.least("_ib", "_db") + span - 1
    shared = last_shared - F.pmod(last_shared, F.lit(step)) >= F.greatest("_ib", "_db")
    return i.join(d, "order_id", "inner").where(shared).select(*ORDER_WIDE_COLUMNS)


def order_wide_interval(info: DataFrame, detail: DataFrame, bound_s: int = 10,
                        info_more: tuple = (), detail_more: tuple = ()) -> DataFrame:
    """Equi-join on order id plus |detail time - order time| <= bound_s.

    This is the event-time form of the sliding-window join; in streaming the
    same condition plus watermarks bounds the join state.
    """
    i = _info_side(info, info_more).withColumn("_it", text_seconds("create_time"))
    d = _detail_side(detail, detail_more).withColumn("_dt", text_seconds("_detail_time"))
    bound = F.lit(int(bound_s))
    cond = ((i.order_id == d.order_id) & (d._dt >= i._it - bound) & (d._dt <= i._it + bound))
    j = i.join(d, cond, "inner").drop(d.order_id)
    return j.select(*ORDER_WIDE_COLUMNS, *info_more, *detail_more)


def sliding_window_counts(df: DataFrame, ts_col: str = "ts", window_s: int = WINDOW_SECONDS,
                          slide_s: int = SLIDE_SECONDS) -> DataFrame:
    """Rows per sliding window; each row counts in window/slide windows."""
    ts = F.col(ts_col).cast("timestamp")
    g = df.groupBy(F.window(ts, f"{window_s} seconds", f"{slide_s} seconds").alias("w")) \
          .agg(F.count(F.lit(1)).alias("cnt"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    return g.select(F.date_format("w.start", fmt).alias("window_start"),
                    F.date_format("w.end", fmt).alias("window_end"), "cnt")


def detail_amount_split(info: DataFrame, detail: DataFrame, more: tuple = (),
                        stored: bool = False) -> DataFrame:
    """Each line's share of the order's paid amount, in whole cents.

    Weight of a line = price x quantity (the reference's "original amount"
    rule). share = floor(final_cents * weight / total_weight); the line with
    the largest detail id also takes the remainder, so the shares of an order
    add up to its paid amount exactly.

    The lines are shuffled by order id once and take their order's amount
    there; the sums of an order are taken over its lines as they then lie. An
    order's lines meet in one task, as they have to for the amount; those of a
    large order are spilled. ``more`` are columns of the details that come
    along. ``stored`` has no effect any more: the inputs are read once.
    """
    # decimals: the product of two amounts in cents outgrows 64 bits
    cents = lambda c: F.round(F.col(c) * 100).cast("decimal(19,0)")
    weight = cents("order_price") * F.col("sku_num").cast("decimal(19,0)")
    values = ("order_price", "sku_num")          # smaller to shuffle than the weight
    lines = detail.select(F.col("id").alias("order_detail_id"), "order_id",
                          *dict.fromkeys([*more, *values]))
    orders = info.select(F.col("id").alias("order_id"), cents("final_total_amount").alias("fc"))
    share = (F.when(F.col("tw") == 0, F.lit(0).cast("bigint")).otherwise(F.expr("(fc * w) div tw")))
    order = Window.partitionBy("order_id")
    out = (lines.join(orders, "order_id").withColumn("w", weight)
                .withColumns({"tw": F.sum("w").over(order), "last_id": F.max("order_detail_id").over(order)})
                .withColumn("share", share).withColumn("rem", F.col("fc") - F.sum("share").over(order))
                .withColumn("cents", F.col("share") + F.when(
                    F.col("order_detail_id") == F.col("last_id"), F.col("rem")).otherwise(F.lit(0))))
    return out.select("order_detail_id", "order_id", F.col("cents").cast("bigint").alias("cents"),
                      (F.col("cents").cast("double") / 100.0).alias("final_detail_amount"), *more)


# Detail columns of the full wide row, beside the ids and the amount.
FULL_DETAIL_COLUMNS = ("sku_id", "order_price", "sku_num", "sku_name", "spu_id", "tm_id",
                       "category3_id", "spu_name", "tm_name", "category3_name")


def order_wide_full(info: DataFrame, split: DataFrame) -> DataFrame:
    """The wide row with all its fields.

    ``info``: flagged and enriched orders with user_age_group and user_gender;
    ``split``: the amount split of the details of these orders, with
    FULL_DETAIL_COLUMNS: SKU, SPU, trademark and category come along, so that
    the lines are joined by order id only, as they lie after the split.
    """
    i = _info_side(info, ("user_age_group", "user_gender"))
    return (i.join(split.withColumnRenamed("order_price", "sku_price"), "order_id")
            .select(*ORDER_WIDE_FULL_COLUMNS))
