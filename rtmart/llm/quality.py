"""Quality rules: text statistics and cross-document line frequency.

A line is hashed after normalising; its distinct documents are counted per
host. Lines found in more than ``max_docs`` documents of one host are removed
from the texts of all of them but the first (smallest doc_id), and a document
whose shortened text holds too few of its words is rejected, beside those that
the base rules reject. Counts other than removed_words are of the given text.

Defined cases: a null text is empty (0 words: base_failed) and stays null; a
text all of whose lines go becomes empty; a null source is a
host of its own; repeated rows are one document and get the same verdict; a
null doc_id is carried as null; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rtmart.llm import text as T
from rtmart.operators.lineage import cut_lineage

#: A window of repeated text has so many words.
WINDOW = 5


def _covered(hashes: Column) -> Column:
    """Words covered by the windows whose hash occurs twice or more."""
    pairs = F.sort_array(F.transform(
        hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        twin = lambda x, i: (x["h"].eqNullSafe(F.get(s, i - 1)["h"])
                             | x["h"].eqNullSafe(F.get(s, i + 1)["h"]))
        return F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))

    def union_length(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, i: F.least(
                F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
            F.lit(0), lambda a, b: a + b)

    return T.let(T.let(pairs, starts), union_length)


def _repeated(w: Column) -> Column:
    """Sorting is paid only by texts that hold some window twice."""
    window_hash = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), window_hash)
    covered = T.let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(F.lit(0)))
    return F.when(F.size(w) > WINDOW, covered).otherwise(F.lit(0))


def text_statistics(docs: DataFrame) -> DataFrame:
    """Packed rows with their text and its base counts; no shuffle.

    Windows are compared by 64-bit hash within one text.
    """
    text = T.whole_text()
    base = T.packed(
        docs, F.col("doc_id").alias("doc_id"), F.col("text").alias("text"),
        T.let(T.words(text), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeated(w).cast("long").alias("n_repeat_words"))).alias("w"),
        F.length(F.translate(text, T.SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long")
        .alias("n_symbols"),
        T.let(T.word_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x)))
        .cast("long").alias("n_dup_lines"))
    return base.select(*[c for c in base.columns if c != "w"], "w.n_words", "w.n_repeat_words")


def document_lines(docs: DataFrame) -> DataFrame:
    """One small row per line with a word: its hash within the host, document, position."""
    lines = docs.select("doc_id", "source", T.row_key().alias("key"),
                        F.posexplode(F.split(T.whole_text(), "\n")).alias("pos", "line"))
    return lines.where(F.col("line").rlike(T.NOT_SPACE)).select(
        "doc_id", "key", "pos",
        F.xxhash64("source", T.normalised_line(F.col("line"))).alias("line_hash"))


def frequent_lines(lines: DataFrame, max_docs: int) -> DataFrame:
    """Hashes of lines in more than max_docs documents of a host, and their first document.

    Occurrences bound distinct documents from above, so only lines that occur
    often enough are counted exactly.
    """
    often = (lines.groupBy("line_hash").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > max_docs).select("line_hash"))
    by_doc = (lines.join(often, "line_hash", "left_semi")
              .groupBy("line_hash", "key").agg(F.min("doc_id").alias("doc_id")))
    return (by_doc.groupBy("line_hash")
            .agg(F.count(F.lit(1)).alias("n_docs"),
                 F.min(F.struct("doc_id", "key")).alias("first"))
            .where(F.col("n_docs") > max_docs)
            .select("line_hash", F.col("first.key").alias("first_key")))


def _judged(docs: DataFrame, max_docs: int = 50, min_left_percent: int = 10,
            min_words: int = 10, max_repeat_percent: int = 20) -> DataFrame:
    """Packed rows: shortened text, changed, counts, removed_words, base_failed and kept."""
    lines = cut_lineage(document_lines(docs), "quality-lines")
    gone = (lines.join(frequent_lines(lines, max_docs), "line_hash")
            .where(F.col("key") != F.col("first_key"))
            # a set: repeated rows list the same places
            .groupBy("key").agg(F.collect_set("pos").alias("removed")))
    changed = F.col("removed").isNotNull()
    rows = (text_statistics(docs).join(gone, "key", "left")
            .withColumn("changed", changed)
            .withColumn("text", F.when(changed, T.without_lines(F.col("text"), F.col("removed")))
                        .otherwise(F.col("text"))))
    left = F.when(F.col("changed"), F.size(T.words(F.col("text")))).otherwise(F.col("n_words"))
    failed = ((F.col("n_words") < min_words)
              | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
    return (rows.withColumn("removed_words", (F.col("n_words") - left).cast("long"))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed")
                        & (100 * (F.col("n_words") - F.col("removed_words"))
                           >= min_left_percent * F.col("n_words"))))


def quality_rules(docs: DataFrame, **limits) -> DataFrame:
    """Per row of ``docs``: doc_id, key, counts, removed_words, base_failed, kept, and
    the shortened text with its n_chars."""
    return _judged(docs.select("doc_id", "source", "text"), **limits).select(
        "doc_id", "key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "removed_words", "base_failed", "kept", "text",
        F.length("text").cast("long").alias("n_chars"))


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with shortened texts; n_chars,
    where there is one, follows them."""
    rows = _judged(docs, **limits).where("kept")
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        given = F.col(f"in_{docs.columns.index('n_chars')}")
        new["n_chars"] = (F.when(F.col("changed"), F.length("text")).otherwise(given)
                          .cast(docs.schema["n_chars"].dataType))
    return T.unpacked(rows, docs.columns, **new)


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(T.documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "removed_words", "base_failed", "kept")
