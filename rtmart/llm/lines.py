"""Line dedup by distinct-site spread.

A HyperLogLog sketch of the sites (``source``) of every line hash, merged by
aggregation, estimates on how many sites a line stands. Clear cases are
decided by the estimate; lines within the sketch's error of the threshold get
an exact distinct count. Lines on ``min_sites`` sites or more are boilerplate:
they go everywhere but in their first place (smallest doc_id, then position),
so no text is lost from the corpus altogether.

Defined cases: null text stays null; null and empty sources are one site;
blank lines stay and are never boilerplate; repeated rows get the same result;
a text all of whose lines go becomes empty; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rtmart.llm import text as T
from rtmart.operators.lineage import cut_lineage

#: 2^12 registers: a relative standard error of about 1.6 %.
SKETCH_BITS = 12
#: Share of the threshold on either side of it where counts are made exact.
NEAR = 0.1


def line_places(docs: DataFrame) -> DataFrame:
    """One small row per line with a word: line hash, site, document, position."""
    lines = docs.select(
        "doc_id", T.row_key().alias("key"),
        F.coalesce("source", F.lit("")).alias("site"),
        F.posexplode(F.split(T.whole_text(), "\n")).alias("pos", "line"))
    return (lines.where(F.col("line").rlike(T.NOT_SPACE))
            .select("doc_id", "key", F.xxhash64("site").alias("site"), "pos",
                    F.xxhash64(T.normalised_line(F.col("line"))).alias("line_hash")))


def boilerplate(places: DataFrame, min_sites: int) -> DataFrame:
    """line_hash and first place of each line on min_sites sites or more."""
    spread = cut_lineage(
        places.groupBy("line_hash").agg(
            F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch"),
            F.min(F.struct("doc_id", "key", "pos")).alias("first"))
        .select("line_hash", "first", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= min_sites * (1 - NEAR)), "line-spread")
    near = spread.where(F.col("sites") <= min_sites * (1 + NEAR))
    exact = (places.join(near.select("line_hash"), "line_hash", "left_semi")
             .groupBy("line_hash", "site").agg(F.lit(1).alias("one"))
             .groupBy("line_hash").agg(F.count("one").alias("exact_sites"))
             .where(F.col("exact_sites") >= min_sites).select("line_hash"))
    clear = spread.where(F.col("sites") > min_sites * (1 + NEAR))
    return (clear.unionByName(near.join(exact, "line_hash", "left_semi"))
            .select("line_hash", F.col("first.key").alias("first_key"),
                    F.col("first.pos").alias("first_pos")))


def _shortened(docs: DataFrame, min_sites: int) -> tuple[DataFrame, dict]:
    """Packed rows with n_removed, and the columns that replace the caller's."""
    places = cut_lineage(line_places(docs), "line-places")
    gone = (places.join(boilerplate(places, min_sites), "line_hash")
            .where((F.col("key") != F.col("first_key")) | (F.col("pos") != F.col("first_pos")))
            # a set: repeated rows name the same places
            .groupBy("key").agg(F.collect_set("pos").alias("removed")))
    rows = T.packed(docs, F.col("text").alias("text")).join(gone, "key", "left")
    changed = F.col("removed").isNotNull()
    new = {"text": F.when(changed, T.without_lines(F.col("text"), F.col("removed")))
           .otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        given = F.col(f"in_{docs.columns.index('n_chars')}")
        new["n_chars"] = (F.when(changed, F.length(new["text"])).otherwise(given)
                          .cast(docs.schema["n_chars"].dataType))
    return rows.withColumn("n_removed", F.coalesce(F.size("removed"), F.lit(0))), new


def without_boilerplate(docs: DataFrame, min_sites: int = 10) -> DataFrame:
    """``docs`` with shortened texts; n_chars, where there is one, follows them."""
    rows, new = _shortened(docs, min_sites)
    return T.unpacked(rows, docs.columns, **new)


def removed_lines(docs: DataFrame, min_sites: int = 10) -> DataFrame:
    """doc_id, n_removed and the shortened text of each row."""
    rows, new = _shortened(docs.select("doc_id", "source", "text"), min_sites)
    return rows.select(F.col("in_0").alias("doc_id"),
                       F.col("n_removed").cast("long").alias("n_removed"), new["text"].alias("text"))


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    return removed_lines(T.documents(spark, sf_dir)).select(
        "doc_id", "n_removed", F.length("text").cast("long").alias("n_chars"),
        F.md5("text").alias("text_md5"))
