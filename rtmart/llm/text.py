"""Column helpers shared by the text operators (all JVM-side).

``documents`` columns used: doc_id, text, lang, source, n_chars. Operators
rename the caller's columns while they work, so an extra column of any name
cannot clash with a working column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Words are runs of characters other than space and U+0009..U+000D.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text() -> Column:
    """The text; a null text counts as empty."""
    return F.coalesce(F.col("text"), F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_RUN), "")


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` computed once per row.

    A lambda variable is evaluated once, while a column referenced inside a
    higher-order function is inlined and evaluated per element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def word_lines(text: Column) -> Column:
    """The \\n-separated lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE))


def without_lines(text: Column, removed: Column) -> Column:
    """The text without the lines at the removed positions, in linear time."""
    return let(F.split(text, "\n"), lambda x: F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), removed),
                    lambda p: F.get(x, p)), "\n"))


def normalised_line(line: Column) -> Column:
    """Lower case, spaces collapsed and trimmed."""
    return F.lower(F.trim(F.regexp_replace(line, SPACE_RUN, " ")))


def row_key() -> Column:
    """Names a row by its content.

    Repeated rows share a key and are one document; rows that share a doc_id
    but differ in text or source are different documents. Stable across task
    retries, unlike generated ids.
    """
    return F.xxhash64("doc_id", "source", "text",
                      F.col("doc_id").isNull(), F.col("source").isNull(),
                      F.col("text").isNull())


def packed(docs: DataFrame, *more: Column) -> DataFrame:
    """The caller's columns as in_0, in_1, ... beside the row's key and more columns."""
    return docs.select(*[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(docs.columns)],
                       row_key().alias("key"), *more)


def unpacked(df: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The caller's columns again, some of them replaced."""
    return df.select(*[replaced.get(c, F.col(f"in_{i}")).alias(c) for i, c in enumerate(columns)])
