"""Filter interaction audit by exact constrained least squares.

Five filters are applied to every whole text. A document's failures are a mask
of five bits, so one pass tabulates how many documents each of the 32
coalitions of filters removes (those whose mask meets the coalition). Shapley
values are the solution of the kernel-weighted least squares problem that fits
additive contributions to the coalition values, under the constraint that the
contributions add up to what all filters remove together (efficiency). Its
normal equations are solved in rationals. Their matrix depends on the
coalitions only, so they are solved once for each unit vector of coalition
values; the solution of a part is that operator applied to its own 32 values.
Step counts of an order are differences of coalition values.

Failure E compares texts table-wide: a text's digest is reduced to its least
doc_id by aggregation, and documents that do not fail are counted there, so
the copies of one text are never joined or gathered.

Defined cases: a null text is empty; a null lang and an empty one are the same
part; a null doc_id is no smaller doc_id and fails no E; repeated rows of a
doc_id are each counted and are not each other's smaller copies; of repeated
labels of a doc_id the largest holds, a missing or null one is 0; very long
texts are counted whole; an empty table gives no rows; other columns of the
caller are not read.
"""

from __future__ import annotations

import itertools
import json
from fractions import Fraction
from math import comb, factorial

from pyspark.sql import Column, DataFrame, functions as F

from rtmart.llm import text as T
from rtmart.operators.lineage import cut_lineage

FILTERS = "ABCDE"
COPY_BIT = 1 << FILTERS.index("E")
#: Join keys of rows without a doc_id are spread over so many values.
SPREAD = 1024


# -- Shapley values by constrained least squares -----------------------------

def _solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """Solutions of matrix x = right, for several right sides (columns), in rationals."""
    n = len(matrix)
    rows = [list(m) + list(r) for m, r in zip(matrix, right)]
    for k in range(n):
        pivot = next(i for i in range(k, n) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [v / rows[k][k] for v in rows[k]]
        for i in range(n):
            if i != k and rows[i][k]:
                rows[i] = [a - rows[i][k] * b for a, b in zip(rows[i], rows[k])]
    return [row[n:] for row in rows]


def shapley_operator(players: int) -> list[list[Fraction]]:
    """(players, coalitions): Shapley values are this matrix times the coalition values.

    Minimises sum over proper coalitions S of k(S) (v(S) - sum of x_i in S)^2
    under sum of all x_i = v(all), with the kernel k(S) = (n - 1) /
    (C(n, |S|) |S| (n - |S|)); the last unknown is the multiplier.
    """
    n, whole = players, (1 << players) - 1
    member = [[Fraction(s >> i & 1) for i in range(n)] for s in range(whole + 1)]

    def kernel(s: int) -> Fraction:
        size = s.bit_count()
        return Fraction(n - 1, comb(n, size) * size * (n - size)) if 0 < size < n else Fraction(0)

    matrix = [[sum(kernel(s) * m[i] * m[j] for s, m in enumerate(member)) for j in range(n)] + [Fraction(1)]
              for i in range(n)] + [[Fraction(1)] * n + [Fraction(0)]]
    right = [[kernel(s) * member[s][i] for s in range(whole + 1)] for i in range(n)]
    right.append([Fraction(int(s == whole)) for s in range(whole + 1)])
    return _solve(matrix, right)[:n]


# -- documents ---------------------------------------------------------------

def failures(text: Column) -> Column:
    """The mask of the failures A to D, A the lowest bit."""
    words = T.let(T.words(text), lambda w: F.struct(F.size(w).alias("n"),
                                                    F.size(F.array_distinct(w)).alias("d")))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return T.let(words, lambda w: (
        F.when(w["n"] < 100, 1).otherwise(0)
        + F.when(100 * w["d"].cast("long") < 80 * w["n"].cast("long"), 2).otherwise(0)
        + F.when(100 * capitals.cast("long") > 10 * F.length(text).cast("long"), 4).otherwise(0)
        + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows (doc_id, ...) with good and toxic, 0 or 1."""
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    # rows without a doc_id meet no label: spread over keys, not sent to one task
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(SPREAD)) + 1).otherwise(F.lit(0))
    marks = marks.withColumn("l_spread", F.lit(0).cast("long"))
    joined = rows.withColumn("spread", spread.cast("long")).join(
        marks, (F.col("doc_id") == F.col("l_id")) & (F.col("spread") == F.col("l_spread")), "left")
    return joined.drop("l_id", "l_spread", "spread").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents of each part that fail exactly the mask's filters."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("lang"), F.lit("")).alias("part"), T.whole_text().alias("text"))
    rows = rows.select("doc_id", "part", F.unhex(F.md5("text")).alias("digest"),
                       failures(F.col("text")).alias("mask"))
    # equal digests have equal masks, so the mask is no key of its own
    rows = rows.groupBy("digest", "doc_id", "part").agg(F.count(F.lit(1)).alias("n"), F.max("mask").alias("mask"))
    rows = cut_lineage(_labelled(rows, labels), "filter-audit")
    counts = ["n", "good", "toxic"]
    rows = rows.withColumns({c: F.col(c) * F.col("n") for c in ("good", "toxic")})
    # of a text: the rows of its least doc_id, one entry for each part they lie in
    least = rows.where("doc_id IS NOT NULL").groupBy("digest", "part").agg(
        F.min(F.struct("doc_id", "mask", *counts)).alias("f"))
    owners = least.groupBy("digest").agg(F.min("f.doc_id").alias("first"),
                                         F.collect_list(F.struct("part", "f")).alias("parts"))
    owners = owners.select(F.explode(
        F.filter("parts", lambda p: p["f"]["doc_id"] == F.col("first"))).alias("p"))
    passing = owners.select("p.part", *[F.col(f"p.f.{c}").alias(c) for c in ("mask", *counts)]).unionByName(
        rows.where("doc_id IS NULL").select("part", "mask", *counts))
    # all fail E but the passing ones, which are moved back to the mask without it
    moved = passing.select("part", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), *counts),
        F.struct((F.col("mask") + COPY_BIT).alias("mask"), *[(-F.col(c)).alias(c) for c in counts]))).alias("m"))
    failing = rows.select("part", (F.col("mask") + COPY_BIT).alias("mask"), *counts)
    return failing.unionByName(moved.select("part", "m.*")).groupBy("part", "mask").agg(
        *[F.sum(c).alias(c) for c in counts])


def coalitions(counts: DataFrame) -> DataFrame:
    """part, n, good, toxic: arrays of what each coalition of filters removes, by its bits."""
    removes = F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))      # at most 32 masks a part

    def removed(c):
        return F.transform(removes, lambda s: F.aggregate("masks", F.lit(0).cast("long"), lambda total, m: (
            total + F.when(m["mask"].bitwiseAND(s) != 0, m[c]).otherwise(0)))).alias(c)

    masks = counts.groupBy("part").agg(F.sum("n").alias("documents"), F.collect_list(
        F.struct("mask", "n", "good", "toxic")).alias("masks"))
    return masks.select("part", "documents", *map(removed, ("n", "good", "toxic")))


def step_plan(filters: str = FILTERS) -> list[dict]:
    """Every step of every order: the coalitions before and after it, and its filter's bit."""
    plan = []
    for order in itertools.permutations(filters):
        before = 0
        for step, f in enumerate(order, 1):
            bit = 1 << filters.index(f)
            plan.append({"filter_order": "".join(order), "step": step, "f": filters.index(f),
                         "before": before, "after": before | bit, "alone": bit,
                         "others": ((1 << len(filters)) - 1) & ~bit})
            before |= bit
    return plan


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The row of every part, order and step."""
    orders = factorial(len(FILTERS))
    operator = [[w * orders for w in row] for row in shapley_operator(len(FILTERS))]
    assert all(w.denominator == 1 for row in operator for w in row)
    weights = F.from_json(F.lit(json.dumps([list(map(int, row)) for row in operator])), "array<array<long>>")
    values = coalitions(mask_counts(docs, labels)).withColumn("sums", F.transform(
        weights, lambda row: F.aggregate(F.zip_with(row, "n", lambda w, v: w * v), F.lit(0).cast("long"),
                                         lambda total, x: total + x)))
    plan = F.from_json(F.lit(json.dumps(step_plan())), "array<struct<filter_order:string,step:int,f:int,"
                       "before:int,after:int,alone:int,others:int>>")
    steps = values.withColumn("s", F.explode(plan))

    def gained(c, after="s.after", before="s.before"):
        return F.get(c, F.col(after)) - F.get(c, F.col(before))

    whole = F.lit((1 << len(FILTERS)) - 1)
    return steps.select(
        "part", "s.filter_order", "s.step",
        (F.col("documents") - F.get("n", F.col("s.after"))).alias("kept"),
        gained("n").alias("removed"),
        (F.get("n", F.col("s.alone")) - gained("n")).alias("redundant"),
        (F.get("n", whole) - F.get("n", F.col("s.others"))).alias("unique_fails"),
        gained("good").alias("good_lost"), gained("toxic").alias("toxic_lost"),
        F.get("sums", F.col("s.f")).alias("shapley"))


def op12_filter_interaction_audit(spark, sf_dir: str) -> DataFrame:
    return audit(T.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
