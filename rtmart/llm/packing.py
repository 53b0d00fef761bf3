"""Packing: optimal length buckets and token-budget batches.

Texts are cut into pieces of at most ``max_len`` words, so the histogram of
piece lengths has at most ``max_len`` entries whatever the corpus. Dynamic
programming over it finds the bucket boundaries with the least padding. In
each bucket, pieces are dealt to shards by hash and numbered there; a batch
holds as many pieces as the token budget allows at the bucket's length. The
number of shards follows the histogram, so no task's group grows with the data.

Defined cases: null and wordless texts give no piece; repeated rows give their
pieces again; ties are broken by hash; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from rtmart.llm import text as T

MAX_LEN = 2048
BUCKETS = 8
TOKEN_BUDGET = 16384
#: Pieces in a shard: this many, or four batches where that is more.
SHARD_ROWS = 2048


def pieces(docs: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """doc_id, source, key, piece, n_tokens, text: every word is in one piece."""
    def cut(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(w) - 1) / max_len).cast("int"))
        return F.when(F.size(w) > 0, F.transform(starts, lambda k: F.struct(
            k.alias("piece"), F.slice(w, k * max_len + 1, F.lit(max_len)).alias("words"))))

    cut_up = docs.select("doc_id", "source", T.row_key().alias("key"),
                         F.explode(T.let(T.words(T.whole_text()), cut)).alias("p"))
    return cut_up.select("doc_id", "source", "key", F.col("p.piece").alias("piece"),
                         F.size("p.words").alias("n_tokens"),
                         F.array_join("p.words", " ").alias("text"))


def length_histogram(docs: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """n_tokens, n: the lengths of pieces(), without cutting the texts."""
    size = docs.select(F.size(T.words(T.whole_text())).alias("size"))
    each = size.groupBy("size").agg(F.count(F.lit(1)).alias("texts"))
    both = each.select(F.explode(F.array(
        F.struct(F.lit(max_len).alias("n_tokens"),
                 (F.expr(f"size div {max_len}") * F.col("texts")).alias("n")),
        F.struct((F.col("size") % max_len).alias("n_tokens"), F.col("texts").alias("n")))).alias("x"))
    return (both.where((F.col("x.n") > 0) & (F.col("x.n_tokens") > 0))
            .groupBy("x.n_tokens").agg(F.sum("x.n").alias("n")))


def optimal_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least total padding."""
    order = np.argsort(lengths)
    ls, cs = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    m = len(ls)
    if not m:
        return []
    # prefix counts and tokens; padding of (i, j] is l_j * pieces - tokens
    pieces_to = np.concatenate(([0], np.cumsum(cs))).astype(float)
    tokens_to = np.concatenate(([0], np.cumsum(cs * ls))).astype(float)
    best = np.full(m + 1, np.inf)
    best[0] = 0
    came = []
    for _ in range(min(buckets, m)):
        now, back = np.full(m + 1, np.inf), np.zeros(m + 1, int)
        now[0] = 0
        for j in range(1, m + 1):
            total = best[:j] + ls[j - 1] * (pieces_to[j] - pieces_to[:j]) \
                - (tokens_to[j] - tokens_to[:j])
            back[j] = int(total.argmin())
            now[j] = total[back[j]]
        best = now
        came.append(back)
    bounds, j = [], m
    for back in reversed(came):
        if j:
            bounds.append(int(ls[j - 1]))
            j = back[j]
    return bounds[::-1]


def pack(docs: DataFrame, max_len: int = MAX_LEN, buckets: int = BUCKETS,
         budget: int = TOKEN_BUDGET) -> DataFrame:
    """Pieces with bucket_len, shard, batch (in the shard) and slot (in the batch)."""
    histogram = {r["n_tokens"]: r["n"] for r in length_histogram(docs, max_len).collect()}
    bounds = optimal_boundaries(list(histogram), list(histogram.values()), buckets)
    out = pieces(docs, max_len)

    def by_bucket(values: list[int]) -> Column:
        chosen = F.lit(values[-1] if values else 1)
        for bound, value in reversed(list(zip(bounds[:-1], values[:-1]))):
            chosen = F.when(F.col("n_tokens") <= bound, F.lit(value)).otherwise(chosen)
        return chosen

    capacity = [max(1, budget // b) for b in bounds]
    sizes, low = [], 0
    for b in bounds:
        sizes.append(sum(n for length, n in histogram.items() if low < length <= b))
        low = b
    shards = [max(1, -(-n // max(4 * c, SHARD_ROWS))) for n, c in zip(sizes, capacity)]
    mixed = F.xxhash64("key", "piece", F.lit(11))
    out = (out.withColumn("bucket_len", by_bucket(bounds)).withColumn("mixed", mixed)
           .withColumn("shard", F.pmod("mixed", by_bucket(shards).cast("long"))))
    number = F.row_number().over(W.partitionBy("bucket_len", "shard")
                                 .orderBy("mixed", "key", "piece")) - 1
    out = out.withColumn("number", number).withColumn("capacity", by_bucket(capacity))
    return out.select("doc_id", "source", "piece", "text", "n_tokens", "bucket_len", "shard",
                      F.expr("number div capacity").alias("batch"),
                      (F.col("number") % F.col("capacity")).alias("slot"))


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return pack(T.documents(spark, sf_dir).select("doc_id", "source", "text"))
