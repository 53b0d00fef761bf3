"""License scans: base phrases and ordered signature rules.

Every text's words are counted; only texts that hold a keyword are normalised
and scanned. Keywords found in a text are joined to their rules (a fixed
table of a few hundred rows), each rule's matches become word intervals, and
an interval contained in one of a better tier, or in a longer one of its own
tier, is suppressed. Intervals are rows, handled by window functions, so a
text with very many of them stays linear.

Defined cases: null text is empty; texts without words have no labels and
score 0; repeated rows get the same result; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from rtmart.llm import text as T
from rtmart.llm.license_rules import CONFIDENCE, license_rules
from rtmart.llm.urls import ascii_lower
from rtmart.operators.lineage import cut_lineage

#: phrase: label of the base scan
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_SCORE = 0.5

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"              # after lower-casing


def _prefilter(rules: list[tuple]) -> str:
    """A pattern over normalised text that every text with a base phrase or a rule's keyword passes."""
    return " (?:" + "|".join(sorted({r[2] for r in rules} | {p.split()[0] for p in BASE})) + ")"


def scanned_texts(docs: DataFrame, rules: list[tuple]) -> DataFrame:
    """doc_id, key, n_words of every row; norm (' w1 w2 ... ') where a keyword stands."""
    words = F.trim(F.regexp_replace(ascii_lower(T.whole_text()), NOT_WORD, " "))
    norm = F.concat(F.lit(" "), words, F.lit(" "))
    texts = docs.select("doc_id", T.row_key().alias("key"), norm.alias("norm"))
    spaces = F.length("norm") - F.length(F.translate("norm", " ", ""))
    return texts.select(
        "doc_id", "key",
        F.when(F.length("norm") > 2, spaces - 1).otherwise(0).cast("long").alias("n_words"),
        F.when(F.col("norm").rlike(_prefilter(rules)), F.col("norm")).alias("norm"))


def _places(words: Column, phrase: str) -> Column:
    parts = phrase.split()
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - len(parts), F.lit(0)))

    def here(i: Column) -> Column:
        match = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            match = match & (F.get(words, i + k) == part)
        return F.coalesce(match, F.lit(False))

    return F.filter(starts, here)


def base_scan(scanned: DataFrame) -> DataFrame:
    """n_base, first_word, last_word, base_labels (array) added; norm dropped."""
    def found(words: Column) -> Column:
        places = [(label, _places(words, phrase)) for phrase, label in BASE.items()]
        return F.array(*[F.struct(F.lit(label).alias("label"), p.alias("places"))
                         for label, p in places])

    hits = F.when(F.col("norm").isNotNull(),
                  T.let(F.split(F.trim("norm"), " "), found))
    base = scanned.select("doc_id", "key", "n_words", hits.alias("hits"))
    all_places = F.flatten(F.transform("hits", lambda h: h["places"]))
    labels = F.transform(F.filter("hits", lambda h: F.size(h["places"]) > 0), lambda h: h["label"])
    base = base.select("doc_id", "key", "n_words", all_places.alias("places"),
                       F.coalesce(labels, F.array().cast("array<string>")).alias("base_labels"))
    return base.select("doc_id", "key", "n_words", "base_labels",
                       F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_base"),
                       F.array_min("places").cast("long").alias("first_word"),
                       F.array_max("places").cast("long").alias("last_word"))


def rule_intervals(scanned: DataFrame, rules: list[tuple]) -> DataFrame:
    """key, rule, tier, label, start, end: the words of every match of every rule."""
    spark = scanned.sparkSession
    table = spark.createDataFrame(
        [(i, tier, label, keyword, f"(?<= ){pattern}(?= )")
         for i, (tier, label, keyword, pattern) in enumerate(rules)],
        "rule int, tier int, label string, keyword string, pattern string")
    keywords = F.array(*[F.lit(k) for k in sorted({r[2] for r in rules})])
    present = F.filter(keywords, lambda k: F.contains("norm", F.concat(F.lit(" "), k)))
    texts = (scanned.where(F.col("norm").isNotNull()).select("key", "norm")
             .dropDuplicates(["key"]))
    # the rules are a constant of this package: a few hundred rows
    tried = (texts.select("key", "norm", F.explode(present).alias("keyword"))
             .join(F.broadcast(table), "keyword"))
    spaces = lambda c: F.length(c) - F.length(F.translate(c, " ", ""))
    matches = F.expr("regexp_extract_all(norm, pattern, 0)")
    gaps = F.expr("split(norm, pattern)")
    tried = tried.select("key", "rule", "tier", "label", F.posexplode(
        F.arrays_zip(matches.alias("m"), F.slice(gaps, F.lit(1), F.size(matches)).alias("g")))
        .alias("k", "x"))
    tried = tried.select("key", "rule", "tier", "label", "k", spaces(F.col("x.m")).alias("m"),
                         spaces(F.col("x.g")).alias("g"))
    so_far = W.partitionBy("key", "rule").orderBy("k")
    start = (F.sum(F.col("g") + F.col("m")).over(so_far) - F.col("m") - 1).cast("long")
    return (tried.withColumn("start", start)
            .select("key", "rule", "tier", "label", "start",
                    (F.col("start") + F.col("m") + 1).alias("end")))


def unsuppressed(intervals: DataFrame) -> DataFrame:
    """Intervals not contained in one of a better tier or a longer one of their tier."""
    tiers = sorted(CONFIDENCE)
    upto = W.partitionBy("key").orderBy("start").rangeBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy("key").orderBy("start").rangeBetween(W.unboundedPreceding, -1)
    reach = {t: F.max(F.when(F.col("tier") == t, F.col("end"))) for t in tiers}
    out = intervals.withColumns({f"to_{t}": reach[t].over(upto) for t in tiers})
    out = out.withColumns({f"by_{t}": reach[t].over(before) for t in tiers})
    contained = F.lit(False)
    for t in tiers:
        better = (F.col("tier") > t) & (F.col(f"to_{t}") >= F.col("end"))
        longer = (F.col("tier") == t) & ((F.col(f"to_{t}") > F.col("end"))
                                         | (F.col(f"by_{t}") >= F.col("end")))
        contained = contained | F.coalesce(better, F.lit(False)) | F.coalesce(longer, F.lit(False))
    return out.where(~contained).select("key", "rule", "tier", "label", "start", "end")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per row: words, base phrases and their places, labels of base and rules, score."""
    rules = license_rules()
    scanned = cut_lineage(scanned_texts(docs, rules), "license-texts")
    confidence = F.element_at(F.create_map(*[F.lit(x) for kv in CONFIDENCE.items() for x in kv]),
                              F.col("tier"))
    found = (unsuppressed(rule_intervals(scanned, rules)).groupBy("key")
             .agg(F.collect_set("label").alias("rule_labels"),      # at most one per rule
                  F.max(confidence).alias("rule_score")))
    all_labels = F.array_sort(F.array_union(
        "base_labels", F.coalesce("rule_labels", F.array().cast("array<string>"))))
    return base_scan(scanned).join(found, "key", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"),
        F.array_join(all_labels, ",").alias("labels"),
        F.greatest(F.coalesce("rule_score", F.lit(0.0)),
                   F.when(F.col("n_base") > 0, BASE_SCORE).otherwise(0.0)).alias("score"))


def op9_license_scans(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(T.documents(spark, sf_dir))
