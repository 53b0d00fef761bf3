"""Daily active devices (D1, A1-A3, A5) and their reports.

Plan: raw log text -> from_json -> one aggregate per (event day, device) that
keeps the earliest record -> per-day / per-hour counts. The dedup is an
aggregate (not a window), so it is combined map-side: a device or a day that
holds a third of all records sends one partial row per input partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rtmart.functions import (day_key, json_fields, millis_to_day, millis_to_hour,
                              millis_to_minute, previous_day)

# Fixed values of the report surface (names as the reference's report emits them).
DAU_ID = "dau"
DAU_NAME = "新增日活"
NEW_MID_ID = "new_mid"
NEW_MID_NAME = "新增设备"
HOUR_BUCKETS = 24

_COMMON = ["mid", "uid", "ar", "ch", "vc"]


def parse_app_log(raw: DataFrame, value_col: str = "value", keep=()) -> DataFrame:
    """Raw JSON log text -> typed columns plus ``is_valid``.

    Columns: the ``keep`` columns, mid, uid, ar, ch, vc, ts (epoch ms),
    event_id, has_start, is_valid.
    Invalid rows (malformed JSON, no device id, no numeric ts) are kept with
    ``is_valid = false`` so callers can quarantine them instead of failing.
    A JSON ``null`` start counts as absent.
    """
    top = json_fields(raw, value_col, ["common", "start", "ts", "event_id"], keep=keep,
                      prefix="_")
    both = json_fields(top, "_common", _COMMON, keep=[*keep, "_start", "_ts", "_event_id"])
    ts = F.col("_ts").try_cast("bigint")
    return both.select(
        *keep, *_COMMON,
        ts.alias("ts"),
        F.col("_event_id").try_cast("bigint").alias("event_id"),
        F.col("_start").isNotNull().alias("has_start"),
        (F.col("mid").isNotNull() & ts.isNotNull()).alias("is_valid"),
    )


def parse_app_log_variant(raw: DataFrame, paths: dict[str, str] | None = None,
                          value_col: str = "value") -> DataFrame:
    """P1/P3 by schema on read: the columns of ``parse_app_log`` and one more
    for each of ``paths`` (name -> JSON path of any depth, arrays by
    ``[index]``), as text.

    A text is parsed once into a VARIANT and its fields are taken from that; a
    text that is no JSON gives no VARIANT and is not valid. A JSON ``null``
    counts as absent.
    """
    # a generator is a barrier: filters on the fields do not parse again
    doc = raw.select(F.explode(F.array(F.try_parse_json(value_col))).alias("_doc"))
    field = lambda path: F.try_variant_get("_doc", path, "string")
    ts = field("$.ts").try_cast("bigint")
    start = F.try_variant_get("_doc", "$.start", "variant")
    cols = [field(f"$.common.{c}").alias(c) for c in _COMMON]
    more = [field(p).alias(n) for n, p in (paths or {}).items()]
    out = doc.select(
        *cols, ts.alias("ts"), field("$.event_id").try_cast("bigint").alias("event_id"),
        (start.isNotNull() & ~F.is_variant_null(start)).alias("has_start"), *more)
    return out.withColumn("is_valid", F.col("mid").isNotNull() & F.col("ts").isNotNull())


def valid_logs(parsed: DataFrame) -> DataFrame:
    return parsed.where("is_valid").drop("is_valid")


def dau_first_touch(logs: DataFrame) -> DataFrame:
    """The first record of each device per event day, as an active-device
    document (mid, uid, ar, ch, vc, dt, hr, mi, ts)."""
    return first_records(logs).drop("event_id")


def first_records(logs: DataFrame) -> DataFrame:
    """The document of ``dau_first_touch`` with the ``event_id`` of its record.

    "First" is the smallest (ts, event_id), so the result does not depend on
    arrival order (the reference kept whichever record reached its set first).
    Days follow the session time zone.
    """
    df = logs.select("mid", "uid", "ar", "ch", "vc", "ts", "event_id",
                     millis_to_day("ts").alias("dt"))
    first = df.groupBy("dt", "mid").agg(
        F.min(F.struct("ts", "event_id", "uid", "ar", "ch", "vc")).alias("f"))
    return first.select(
        "mid", F.col("f.uid").alias("uid"), F.col("f.ar").alias("ar"),
        F.col("f.ch").alias("ch"), F.col("f.vc").alias("vc"), "dt",
        millis_to_hour("f.ts").alias("hr"), millis_to_minute("f.ts").alias("mi"),
        F.col("f.ts").alias("ts"), F.col("f.event_id").alias("event_id"))


def dau_total(dau: DataFrame, date: str | None = None) -> DataFrame:
    """Active devices per day (one day when ``date`` is given).

    ``day_key`` is the date without dashes, the suffix of the per-day index.
    """
    d = dau if date is None else dau.where(F.col("dt") == F.lit(date))
    return (d.groupBy("dt").agg(F.count(F.lit(1)).alias("dau_total"))
             .select("dt", day_key("dt").alias("day_key"), "dau_total"))


def dau_hour_count(dau: DataFrame, date: str | None = None) -> DataFrame:
    """Active devices per (day, hour); at most 24 hour buckets per day,
    the largest first. The cut runs on the aggregated rows (<= 24 per day)."""
    d = dau if date is None else dau.where(F.col("dt") == F.lit(date))
    hc = d.groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("cnt"))
    w = Window.partitionBy("dt").orderBy(F.col("cnt").desc(), F.col("hr"))
    return hc.withColumn("_r", F.row_number().over(w)) \
             .where(F.col("_r") <= HOUR_BUCKETS).drop("_r")


def _next_day(day) -> F.Column:
    return F.date_format(F.date_add(F.to_date(day, "yyyy-MM-dd"), 1), "yyyy-MM-dd")


def dau_hour_compare(dau: DataFrame, date: str | None = None,
                     report_id: str = DAU_ID) -> DataFrame:
    """Each day's hour counts next to the previous day's.

    Equivalent to a full outer join of the hour counts with themselves shifted
    by a day, but done in one pass: every hour-count row is emitted once as
    "today" of its day and once as "yesterday" of the next day, then one
    aggregate per (dt, hr) lines them up. An hour missing on one side is null.
    Any report id other than ``dau`` gives an empty result.
    """
    hc = dau_hour_count(dau)
    if date is not None:
        hc = hc.where(F.col("dt").isin(F.lit(date), previous_day(F.lit(date))))
    null = F.lit(None).cast("bigint")
    both = hc.select(F.inline(F.array(
        F.struct(F.col("dt").alias("dt"), "hr", F.col("cnt").alias("today"),
                 null.alias("yesterday")),
        F.struct(_next_day("dt").alias("dt"), "hr", null.alias("today"),
                 F.col("cnt").alias("yesterday")))))
    out = both.groupBy("dt", "hr").agg(F.max("today").alias("today"),
                                      F.max("yesterday").alias("yesterday"))
    if date is not None:
        out = out.where(F.col("dt") == F.lit(date))
    if report_id != DAU_ID:
        out = out.where(F.lit(False))
    return out.select("dt", "hr", "today", "yesterday")


def realtime_total(dau: DataFrame, date: str | None = None) -> DataFrame:
    """Per day, the rows {id: dau, value: total} and {id: new_mid, value: n}.

    ``new_mid`` is computed (devices first seen that day) where the reference
    returned a constant. One pass over the documents: grouping sets give the
    per-day totals and each device's first day in the same aggregate, then a
    second (per-day, small) aggregate counts first days.
    """
    g = dau.select("dt", "mid").groupingSets([["dt"], ["mid"]], "dt", "mid").agg(
        F.count(F.lit(1)).alias("n"), F.min("dt").alias("first_dt"),
        F.grouping_id().alias("gid"))
    per_day_set = F.col("gid") == 1          # mid rolled up
    day = F.when(per_day_set, F.col("dt")).otherwise(F.col("first_dt"))
    both = g.groupBy(day.alias("dt")).agg(
        F.max(F.when(per_day_set, F.col("n"))).alias("dau_total"),
        F.count(F.when(~per_day_set, F.lit(1))).alias("new_mid"))
    if date is not None:
        both = both.where(F.col("dt") == F.lit(date))
    rows = F.array(
        F.struct(F.lit(DAU_ID).alias("id"), F.lit(DAU_NAME).alias("name"),
                 F.col("dau_total").cast("bigint").alias("value")),
        F.struct(F.lit(NEW_MID_ID).alias("id"), F.lit(NEW_MID_NAME).alias("name"),
                 F.col("new_mid").cast("bigint").alias("value")))
    return both.select("dt", F.inline(rows))


def dau_distinct_check(logs: DataFrame) -> DataFrame:
    """A5: distinct devices per day, counted over the logs, next to the number
    of documents that ``dau_first_touch`` makes of them. Two independent
    counts, which must be equal; a day that only one of them has shows null."""
    devices = (logs.select(millis_to_day("ts").alias("dt"), "mid")
               .groupBy("dt").agg(F.count_distinct("mid").alias("distinct_mids")))
    documents = dau_first_touch(logs).groupBy("dt").agg(F.count(F.lit(1)).alias("dau_rows"))
    return devices.join(documents, "dt", "full")


def report_hour_json(dau: DataFrame) -> DataFrame:
    """A3/R2 as JSON text per day: {"yesterday":{hr:n,..},"today":{hr:n,..}}.

    The maps are built from at most 24 aggregated rows per day, hours in
    ascending order (a missing hour is absent; no hours gives ``{}``).
    """
    cmp = dau_hour_compare(dau)
    entry = lambda c: F.when(F.col(c).isNotNull(), F.struct("hr", F.col(c)))
    as_map = lambda c: F.map_from_entries(F.array_sort(F.collect_list(entry(c))))
    g = cmp.groupBy("dt").agg(as_map("yesterday").alias("yesterday"),
                              as_map("today").alias("today"))
    return g.select("dt", F.to_json(F.struct("yesterday", "today")).alias("report"))


def report_total_json(dau: DataFrame) -> DataFrame:
    """R1 as JSON text per day: [{"id":"dau",...,"value":n},{"id":"new_mid",...}].

    Two rows per day are folded into one array, ``dau`` first."""
    rows = realtime_total(dau).withColumn("_o", F.when(F.col("id") == DAU_ID, 0).otherwise(1))
    g = rows.groupBy("dt").agg(F.array_sort(F.collect_list(
        F.struct("_o", "id", "name", "value"))).alias("items"))
    return g.select("dt", F.to_json(F.transform(
        "items", lambda x: F.struct(x["id"].alias("id"), x["name"].alias("name"),
                                    x["value"].alias("value")))).alias("report"))
