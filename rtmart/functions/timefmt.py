"""Date and time helpers. Days and hours follow ``spark.sql.session.timeZone``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def epoch_millis(ts) -> Column:
    """Timestamp (also TIMESTAMP_NTZ, read as session-zone wall time) -> epoch ms."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def millis_to_day(ms) -> Column:
    return F.date_format(F.timestamp_millis(_c(ms)), "yyyy-MM-dd")


def millis_to_hour(ms) -> Column:
    return F.date_format(F.timestamp_millis(_c(ms)), "HH")


def valid_time(text) -> Column:
    """True for a null and for a 'yyyy-MM-dd HH:mm:ss' text."""
    t = _c(text)
    shaped = (F.length(t) == 19) & (F.substring(t, 11, 1) == " ")
    return t.isNull() | (shaped & t.try_cast("timestamp").isNotNull())


def text_seconds(text) -> Column:
    """A 'yyyy-MM-dd HH:mm:ss' text -> epoch seconds; null for another text. A cast, since a
    pattern's parser takes several times as long."""
    t = _c(text)
    shaped = (F.length(t) == 19) & (F.substring(t, 11, 1) == " ")
    return F.when(shaped, F.unix_seconds(t.try_cast("timestamp")))


def millis_to_minute(ms) -> Column:
    return F.date_format(F.timestamp_millis(_c(ms)), "mm")


def create_date(create_time) -> Column:
    """'yyyy-MM-dd HH:mm:ss' -> 'yyyy-MM-dd' (text before the space)."""
    return F.split(_c(create_time), " ").getItem(0)


def create_hour(create_time) -> Column:
    """'yyyy-MM-dd HH:mm:ss' -> 'HH' (text before the first colon of the time; null
    when there is no time)."""
    return F.get(F.split(F.get(F.split(_c(create_time), " "), F.lit(1)), ":"), F.lit(0))


def previous_day(day) -> Column:
    """'yyyy-MM-dd' -> the day before; malformed input raises (ANSI to_date)."""
    return F.date_format(F.date_sub(F.to_date(_c(day), "yyyy-MM-dd"), 1), "yyyy-MM-dd")


def day_key(day) -> Column:
    """'yyyy-MM-dd' -> 'yyyyMMdd' (the per-day index suffix)."""
    return F.replace(_c(day), F.lit("-"), F.lit(""))


def wall_clock_day_key() -> Column:
    """today's date as 'yyyyMMdd' (the original named its daily output
    index after the wall-clock day; tables here are partitioned by the event
    day instead, see ``day_key``)."""
    return F.date_format(F.current_date(), "yyyyMMdd")


def timestamp_to_text(ts, plus_seconds=None) -> Column:
    t = _c(ts).cast("timestamp")
    if plus_seconds is not None:
        t = F.timestamp_micros(F.unix_micros(t) + _c(plus_seconds).cast("bigint") * 1_000_000)
    return F.date_format(t, "yyyy-MM-dd HH:mm:ss")
