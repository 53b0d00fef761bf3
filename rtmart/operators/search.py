"""Lookup (F6, T1): full-text match on one field, sort, offset, first k."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

PAGE_SIZE = 20   # the reference's lookup returned the first 20 hits
_SPLIT = "[^a-z0-9]+"


def match_terms(text: str) -> list[str]:
    """Analyse the query text like the field: lower case, split on
    non-alphanumerics, drop empty terms."""
    return [t for t in re.split(_SPLIT, text.lower()) if t]


def terms_column(field: str) -> F.Column:
    """The field's terms (an empty one where it starts or ends with a separator)."""
    return F.split(F.lower(F.col(field)), _SPLIT)


def match_column(field: str, text: str) -> F.Column:
    """True when the field shares any term with ``text`` (a match query)."""
    terms = match_terms(text)
    if not terms:
        return F.lit(False)
    return F.coalesce(F.arrays_overlap(terms_column(field), F.array(*[F.lit(t) for t in terms])),
                      F.lit(False))


def match_sorted(df: DataFrame, field: str, text: str, sort_field: str,
                 tie_breaker: str, size: int = PAGE_SIZE, offset: int = 0) -> DataFrame:
    """Matching rows sorted ascending by ``sort_field`` (ties by
    ``tie_breaker``), rows ``offset .. offset+size-1``.

    Spark plans this as a per-partition top-(offset+size) followed by one
    small merge (TakeOrderedAndProject): no full sort or shuffle of the data.
    """
    hits = df.where(match_column(field, text))
    ordered = hits.orderBy(F.col(sort_field).asc_nulls_first(), F.col(tie_breaker).asc())
    if offset:
        return ordered.offset(offset).limit(size)
    return ordered.limit(size)


def match_count(df: DataFrame, field: str, text: str) -> DataFrame:
    return df.where(match_column(field, text)).agg(F.count(F.lit(1)).alias("hits"))
