"""JSON text <-> columns, all JVM-side built-ins (no Python UDF).

Parsing uses ``json_tuple``: one streaming parse per row that returns the
requested fields as text -- quoted ("22") and bare (22) numbers alike, nested
objects as compact JSON. Being a generator it is also a plan barrier: filters
on parsed fields (including the not-null filters Catalyst infers for join
keys) stay above it instead of being pushed down and re-parsing the text once
per referenced field, and each field is not parsed separately.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rtmart.functions.timefmt import valid_time


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def json_fields(df: DataFrame, text, names: list[str], keep=(), prefix: str = "") -> DataFrame:
    """``keep`` columns plus one string column per top-level field ``names``
    (named ``prefix + name``); a missing field or malformed text gives null."""
    keep = list(keep)
    out = df.select(*keep, F.json_tuple(_c(text), *names))
    return out.toDF(*keep, *[prefix + n for n in names])


def checked_fields(df: DataFrame, text, fields, keep=(), required=("id",), times=()) -> DataFrame:
    """Parse JSON text into typed ``fields`` [(name, type)], the ``keep``
    columns and ``is_valid``.

    A record is valid when its text is an object with every ``required``
    field, every number given is one, and every ``times`` field given is
    'yyyy-MM-dd HH:mm:ss'. In a valid record a missing number is 0 (the
    original records were primitive-typed) and a missing string null.
    """
    raw = json_fields(df, text, [n for n, _ in fields], keep)
    cols, valid = [], F.lit(True)
    for name, typ in fields:
        c = F.col(name)
        if isinstance(typ, T.StringType):
            cols.append(c)
        else:
            cols.append(F.coalesce(c.try_cast(typ), F.lit(0).cast(typ)).alias(name))
            valid = valid & (c.isNull() | c.try_cast(typ).isNotNull())
        if name in required:
            valid = valid & c.isNotNull()
        if name in times:
            valid = valid & valid_time(c)
    return raw.select(*keep, *cols, valid.alias("is_valid"))


def parse_typed(df: DataFrame, text, fields, keep=(), required=("id",), times=()) -> DataFrame:
    """The valid records of ``checked_fields``."""
    return (checked_fields(df, text, fields, keep, required, times)
            .where("is_valid").drop("is_valid"))


def invalid_texts(df: DataFrame, text: str, fields, required=("id",), times=()) -> DataFrame:
    """The texts (column ``value``) of the records that ``parse_typed`` leaves out."""
    texts = df.select(F.col(text).alias("_text"))
    checked = checked_fields(texts, "_text", fields, ["_text"], required, times)
    return checked.where(~F.col("is_valid")).select(F.col("_text").alias("value"))


def to_json_row(*cols, keep_nulls: bool = False) -> Column:
    """Serialise columns to one JSON object by field name."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*cols), opts)
