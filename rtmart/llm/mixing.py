"""Mixing sources to target weights, block by block.

The words of each source are laid end to end and cut into blocks of fixed
length. A source gets as many slots as its target asks for; a multinomial draw
decides how many of them each output shard holds. Slot k of epoch e holds the
block that a pseudorandom permutation of the source's block numbers gives to k,
so an epoch takes every block once. Slots and blocks are joined by source and
block number. The last slot of a source is cut so that its words meet the target.

The mix is mixed_blocks: a row per slot, with its shard and the block's joined
words. The documents' pieces and the words taken of each are read off it.

Defined cases: null text has no words; a null source is a source of its own,
last in order; repeated rows are separate documents of equal standing; sources
without words have target 0; an empty table gives no rows. Everything follows
from the rows and the seed, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from rtmart.llm import text as T
from rtmart.operators.lineage import cut_lineage

BLOCK_WORDS = 512
#: A source's target is at most so many times its size.
MOST_TIMES = 3
SEED = 7
#: Rows that one part of a source's layout holds on average, at most.
PART_ROWS = 512
SLOTS_PER_SHARD = 1024


# -- layout ---------------------------------------------------------------

def _source_name() -> Column:
    """A join key that is never null."""
    return F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))


def _parts(docs: DataFrame) -> DataFrame:
    """Rows with src, size (words), and the part of the source they lie in."""
    n = max(1, -(-docs.count() // PART_ROWS))
    key = T.row_key()
    return docs.select(
        "*", _source_name().alias("src"), F.size(T.words(T.whole_text())).cast("long").alias("size"),
        F.pmod(F.xxhash64(key), F.lit(n)).alias("part"), key.alias("key"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """src, source_size, target from (src, source_size): one row per source.

    Weights 1, 2, 3, repeating, in code point order, the null source last.
    Targets fill up to a common level per weight, no source above its limit.
    """
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rank = F.row_number().over(W.orderBy((F.col("src") == "").cast("int"), "src"))
    limit = (MOST_TIMES * F.col("source_size")).cast("double")
    s = (sizes.withColumn("weight", ((rank - 1) % 3 + 1).cast("double"))
         .withColumn("limit", limit))
    before = (W.orderBy(F.col("limit") / F.col("weight"), "src")
              .rowsBetween(W.unboundedPreceding, -1))
    total = F.sum("source_size").over(everything)
    weights = F.sum("weight").over(everything)
    # the level if just the sources before this one were at their limits
    level = ((total - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
             / (weights - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    s = s.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return s.select("src", "source_size",
                    F.least("limit", F.col("level") * F.col("weight")).alias("target"))


def layout(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, sources): rows with src, part, rn, size, start (first word in the source)."""
    rows = _parts(docs)
    parts = cut_lineage(rows.groupBy("src", "part").agg(F.sum("size").alias("part_size")),
                        "mix-parts")
    sizes = parts.groupBy("src").agg(F.sum("part_size").alias("source_size"))
    sources = cut_lineage(source_targets(sizes), "mix-sources")
    # one row per part, not per document: a hot source's parts are few
    earlier = W.partitionBy("src").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = (parts.withColumn("part_start", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)))
             .join(sources, "src"))
    inside = W.partitionBy("src", "part").orderBy("key")
    rows = (rows.withColumn("rn", F.row_number().over(inside))
            .withColumn("inner", F.coalesce(
                F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
            .join(parts, ["src", "part"])
            .withColumn("start", F.col("part_start") + F.col("inner")))
    return rows.drop("inner", "part_start", "part_size"), sources


def _blocks_of(row_words: Column | None, block: int) -> Column:
    """Array of the pieces of a row: block number, place in it, words, text."""
    start, size = F.col("start"), F.col("size")

    def piece(b: Column) -> Column:
        first = F.greatest(b * block, start)
        n = F.least((b + 1) * block, start + size) - first
        fields = [b.alias("block"), (first - b * block).alias("at"), n.alias("n")]
        if row_words is not None:
            fields.append(F.slice(row_words, (first - start + 1).cast("int"), n.cast("int"))
                          .alias("words"))
        return F.struct(*fields)

    numbers = F.sequence(F.floor(start / block), F.floor((start + size - 1) / block))
    return F.when(size > 0, F.transform(numbers, piece))


# -- draws ----------------------------------------------------------------

def permuted(index: np.ndarray, n: int, seed: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 applied to each index (per seed).

    Four Feistel rounds over the next even power of two; values that fall
    outside are sent through again until they fall inside.
    """
    half = max(1, (int(n - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    value, out = index.astype(np.uint64), np.empty(len(index), np.uint64)
    seeds, todo = seed.astype(np.uint64), np.arange(len(index))
    while len(todo):
        left, right = value >> shift, value & mask
        for r in range(4):
            x = right + seeds + np.uint64(0x9E3779B97F4A7C15 * (r + 1) & (2 ** 64 - 1))
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((x ^ (x >> np.uint64(31))) & mask)
        value = (left << shift) | right
        done = value < np.uint64(n)
        out[todo[done]] = value[done]
        value, seeds, todo = value[~done], seeds[~done], todo[~done]
    return out.astype(np.int64)


def shard_counts(slots: int, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(shards with slots, slots in each): a multinomial draw over equal shards."""
    rng = np.random.default_rng(seed)
    if slots < shards:                       # the same draw, one slot at a time
        return np.unique(rng.integers(0, shards, slots), return_counts=True)
    counts = rng.multinomial(slots, np.full(shards, 1 / shards))
    found = np.flatnonzero(counts)
    return found, counts[found]


def draw_slots(sources: DataFrame, shards: int, block: int) -> DataFrame:
    """src, shard, slot, block, words: one row per slot."""
    size, goal = F.col("source_size"), F.round("target").cast("long")
    plan = (sources.where((F.col("source_size") > 0) & (F.col("target") > 0))
            .select("src", F.xxhash64("src", F.lit(SEED)).alias("seed"),
                    F.expr(f"source_size div {block}").alias("full"),
                    (size % block).alias("tail"),
                    F.expr("cast(round(target) as long) div source_size").alias("epochs"),
                    (goal % size).alias("left")))
    plan = plan.withColumn("per_epoch", F.col("full") + (F.col("tail") > 0).cast("long"))
    plan = plan.withColumn("last_full", F.least("full", F.expr(f"left div {block}")))
    plan = plan.withColumn("rest", F.col("left") - F.col("last_full") * block)
    plan = plan.withColumn("slots", F.col("epochs") * F.col("per_epoch") + F.col("last_full")
                           + (F.col("rest") > 0).cast("long"))

    def deal(batches):
        for batch in batches:
            for r in batch.to_pylist():
                found, n = shard_counts(r["slots"], shards, r["seed"] & (2 ** 63 - 1))
                first = np.cumsum(n) - n
                k = len(found)
                yield pa.RecordBatch.from_pydict(
                    {"shard": found.astype(np.int64), "first": first.astype(np.int64),
                     "n": n.astype(np.int64)} | {c: pa.array([r[c]] * k, t) for c, t in kept})

    kept = [("src", pa.string())] + [(c, pa.int64()) for c in (
        "seed", "full", "tail", "epochs", "per_epoch", "rest")]
    fields = "shard long, first long, n long, src string, " + ", ".join(
        f"{c} long" for c, _ in kept[1:])

    def fill(batches):
        for batch in batches:
            for r in batch.to_pylist():
                slot = np.arange(r["first"], r["first"] + r["n"])
                epoch, k = slot // r["per_epoch"], slot % r["per_epoch"]
                number = np.full(len(slot), r["full"])         # the tail block
                inner = k < r["full"]
                if inner.any():
                    with np.errstate(over="ignore"):
                        seeds = (epoch[inner].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                                 ^ np.uint64(r["seed"] & (2 ** 64 - 1)))
                        number[inner] = permuted(k[inner], r["full"], seeds)
                taken = np.where(inner, block, r["tail"])
                # the slot after the last whole one of the last epoch
                taken = np.where((epoch == r["epochs"]) & (k == r["last"]) & (r["rest"] > 0),
                                 r["rest"], taken)
                yield pa.RecordBatch.from_pydict(
                    {"src": pa.array([r["src"]] * len(slot), pa.string()),
                     "shard": np.full(len(slot), r["shard"]), "slot": slot,
                     "block": number, "words": taken})

    dealt = (plan.select(*[c for c, _ in kept], "slots", "last_full")
             .repartition("src").mapInArrow(deal, fields))
    last = plan.select("src", F.col("last_full").alias("last"))
    # spread over tasks by shard, so that a hot source is dealt by many
    return (dealt.join(last, "src").repartition("src", "shard")
            .mapInArrow(fill, "src string, shard long, slot long, block long, words long"))


def n_shards(sources: DataFrame, block: int) -> int:
    words = sources.agg(F.sum("target")).first()[0] or 0
    return max(1, int(-(-words // (block * SLOTS_PER_SHARD))))


def _mix(rows: DataFrame, sources: DataFrame, given: list[str], block: int) -> DataFrame:
    """src, shard, slot, block, words, text, places: a row per slot.

    ``places`` lists the pieces of documents in the block: at, n, and the ``given``
    columns of their rows.
    """
    pieces = rows.select(
        *given, "src",
        F.explode(T.let(T.words(T.whole_text()), lambda w: _blocks_of(w, block))).alias("p"))
    pieces = pieces.select("src", F.col("p.block").alias("block"), F.struct(
        F.col("p.at").alias("at"), F.col("p.n").alias("n"),
        F.array_join("p.words", " ").alias("piece"), *given).alias("piece"))
    # grouped by the join's key, so texts are dealt once for both
    whole = pieces.groupBy("src", "block").agg(F.array_sort(
        F.collect_list("piece"), lambda x, y: (x["at"] - y["at"]).cast("int")).alias("pieces"))
    slots = draw_slots(sources, n_shards(sources, block), block)
    text = F.array_join(F.transform("pieces", lambda x: x["piece"]), " ")
    full = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, x: n + x["n"])
    mix = whole.join(slots, ["src", "block"]).withColumns(
        {"full": full, "text": text, "w": F.col("words").cast("int")})
    return mix.select(
        "src", "shard", "slot", "block", "words",
        F.when(F.col("words") < F.col("full"), F.expr("substring_index(text, ' ', w)"))
        .otherwise(F.col("text")).alias("text"),
        F.transform("pieces", lambda x: F.struct(
            x["at"].alias("at"), x["n"].alias("n"), *[x[c].alias(c) for c in given]))
        .alias("places"))


def mixed_blocks(docs: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The mix: source, shard, slot, block, words and the joined text of each slot."""
    rows, sources = layout(docs.select("doc_id", "source", "text"))
    mix = _mix(rows, sources, [], block)
    return mix.select(F.when(F.col("src") != "", F.expr("substring(src, 2)")).alias("source"),
                      "shard", "slot", "block", "words", "text")


def _taken_pieces(mix: DataFrame, given: list[str]) -> DataFrame:
    """shard, slot, at, n, piece and the given columns: the mix's texts, by document."""
    def cut(w: Column) -> Column:
        inside = F.filter("places", lambda p: p["at"] < F.size(w))
        return F.transform(inside, lambda p: F.struct(
            p["at"].alias("at"), *[p[c].alias(c) for c in given],
            F.slice(w, (p["at"] + 1).cast("int"), p["n"].cast("int")).alias("words")))

    drawn = mix.select("shard", "slot", F.explode(T.let(F.split("text", " "), cut)).alias("p"))
    return drawn.select("shard", "slot", F.col("p.at").alias("at"),
                        *[F.col(f"p.{c}").alias(c) for c in given],
                        F.size("p.words").alias("n"), F.array_join("p.words", " ").alias("piece"))


def mixed_documents(docs: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The mix as rows of documents: a row per drawn piece of a document.

    Columns of ``docs``, the text being the piece's words (single spaces). A
    document of several blocks gives a row for each; a block drawn again
    repeats its rows.
    """
    given = [F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(docs.columns) if c != "text"]
    rows, sources = layout(docs.select(*given, "doc_id", "source", "text"))
    names = [f"in_{i}" for i, c in enumerate(docs.columns) if c != "text"]
    drawn = _taken_pieces(_mix(rows, sources, names, block), names)
    new = {"text": F.col("piece")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("piece").cast(docs.schema["n_chars"].dataType)
    return T.unpacked(drawn, docs.columns, **new)


def taken_words(docs: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, size, source_size, target, taken, mix_digest per row, read off the mix.

    ``mix_digest`` is made of the row's words in the mix and the shards, slots
    and places where they stand.
    """
    row = ["src", "part", "rn"]
    rows, sources = layout(docs.select("doc_id", "source", "text"))
    named = rows.withColumn("row", F.struct(*row))
    taken = (_taken_pieces(_mix(named, sources, ["row"], block), ["row"])
             .groupBy(*[F.col(f"row.{c}").alias(c) for c in row])
             .agg(F.sum("n").alias("taken"),
                  F.bit_xor(F.xxhash64("shard", "slot", "at", "piece")).alias("mix_digest")))
    return rows.select(*row, "doc_id", "size", "source_size", "target").join(
        taken, row, "left").select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("mix_digest", F.lit(0)).cast("long").alias("mix_digest"))


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    return taken_words(T.documents(spark, sf_dir))
