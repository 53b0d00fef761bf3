"""SimHash near-dedup with bit-sliced comparison.

Fingerprints are built from XXH64 hashes of word shingles. Distinct
fingerprints meet where two of five bit bands agree: within a radius of 3 at
least two bands are equal, so no link is missed. Where they meet, their bit
planes are stored vertically (64 fingerprints to a machine word) and a query
updates all distances of a block at once with carry-save counters, plane by
plane, until every lane has passed the radius. Meeting places that hold many
fingerprints are cut into chunks and compared chunk pair by chunk pair; what
leaves a task is a spanning forest of its links, never all pairs.

Defined cases: null text is empty; a text without words has fingerprint zero;
null doc_ids keep their fingerprint and take the component of the others;
repeated rows are one group; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rtmart.llm import text as T
from rtmart.llm.graph import connected_components
from rtmart.llm.runs import blocks, whole_groups
from rtmart.operators.lineage import cut_lineage

SEED = 42
BITS = 64
#: Bits whose shingle hashes are unpacked at once (bounds memory on long texts).
SHINGLES_AT_ONCE = 1 << 16
#: Fingerprints of one meeting place that one chunk holds.
CHUNK = 1024
#: Rows of whole small groups that are compared as one block.
BLOCK = 256
#: Planes between two looks at whether a block can be abandoned.
LOOK_EVERY = 8


# -- fingerprints ---------------------------------------------------------

def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of each shingle as 8 big-endian bytes, one row per shingle."""
    parts = text.lower().split()      # ASCII letters; space and U+0009..U+000D
    if not parts:
        return np.empty((0, 8), np.uint8)
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(parts) > size:
        starts, ends = starts[: len(parts) - size + 1], ends[size - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_digest
    hashed = b"".join([digest(joined[a:b], SEED)
                       for a, b in zip(starts.tolist(), ends.tolist())])
    return np.frombuffer(hashed, np.uint8).reshape(-1, 8)


def fingerprint(text: bytes, size: int) -> int:
    """Bits set in over half the shingle hashes, as a signed 64-bit integer."""
    hashes = shingle_hashes(text, size)
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), SHINGLES_AT_ONCE):
        counts += np.unpackbits(hashes[k:k + SHINGLES_AT_ONCE], axis=1).sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, key, fp of each row; the whole text, read once."""
    def run(batches):
        for batch in batches:
            texts = batch.column("utf8")
            fps = [fingerprint(x.as_py(), shingle) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(fps, pa.int64())],
                ["doc_id", "key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), T.row_key().alias("key"),
                       F.encode(T.whole_text(), "UTF-8").alias("utf8"))
    return rows.mapInArrow(run, "doc_id long, key long, fp long")


# -- bit-sliced comparison ------------------------------------------------

def bit_planes(fps: np.ndarray) -> np.ndarray:
    """(64, words): plane k holds bit k of all fingerprints, 64 lanes to a word."""
    lanes = -(-len(fps) // 64) * 64
    padded = np.zeros(lanes, np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(lanes, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within_radius(queries: np.ndarray, planes: np.ndarray, radius: int) -> np.ndarray:
    """(queries, words): lanes whose distance to the query is at most the radius.

    ``count[j]`` is bit j of all distances; a carry out of the top bit sets
    ``over`` for good. Counters hold values up to 2^bits - 1 >= radius.
    """
    bits = max(1, int(radius).bit_length())
    shape = (len(queries), planes.shape[1])
    count = [np.zeros(shape, np.uint64) for _ in range(bits)]
    over = np.zeros(shape, np.uint64)
    full = ~np.uint64(0)
    for k in range(BITS):
        flip = np.where((queries >> np.uint64(k)) & np.uint64(1), full, np.uint64(0))
        carry = planes[k][None, :] ^ flip[:, None]
        for j in range(bits):
            count[j], carry = count[j] ^ carry, count[j] & carry
        over |= carry
        if k % LOOK_EVERY == LOOK_EVERY - 1 and bool((over == full).all()):
            break
    # lanes still counted may hold radius+1 .. 2^bits - 1
    high, equal = np.zeros(shape, np.uint64), np.full(shape, full)
    for j in reversed(range(bits)):
        if (radius >> j) & 1:
            equal &= count[j]
        else:
            high |= equal & count[j]
            equal &= ~count[j]
    return ~(over | high)


def spanning_links(fps: np.ndarray, group: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(i, j) index pairs that span the links inside each group of the block."""
    n = len(fps)
    planes = bit_planes(fps)
    near = np.concatenate([within_radius(fps[k:k + BLOCK], planes, radius)
                           for k in range(0, n, BLOCK)])
    free = np.ones(n, bool)
    links = []
    for start in range(n):
        if not free[start]:
            continue
        free[start] = False
        queue = [start]
        while queue:
            i = queue.pop()
            lanes = np.unpackbits(near[i].view(np.uint8), bitorder="little")[:n]
            found = np.flatnonzero(lanes.astype(bool) & free & (group == group[i]))
            free[found] = False
            queue.extend(found.tolist())
            links.extend((i, j) for j in found.tolist())
    return links


# -- meeting places -------------------------------------------------------

def _bands(n: int) -> list[tuple[int, int]]:
    """n bands of bits as (shift, mask), as even as possible."""
    edges = [BITS * k // n for k in range(n + 1)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(edges, edges[1:])]


def meeting_places(nodes: DataFrame, radius: int, agreeing: int = 2) -> DataFrame:
    """(place, fp): within the radius, two fingerprints share a place.

    radius + agreeing bands; at most ``radius`` of them can differ, so
    ``agreeing`` are equal.
    """
    bands = _bands(radius + agreeing)
    fp = F.col("fp")
    places = []
    for t, chosen in enumerate(combinations(bands, agreeing)):
        parts = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit(mask)) for a, mask in chosen]
        places.append(F.xxhash64(F.lit(t), *parts))
    return nodes.select(F.explode(F.array(*places)).alias("place"), "fp")


def near_links(nodes: DataFrame, radius: int) -> DataFrame:
    """Spanning links (u, v) between fingerprints within the radius."""
    places = cut_lineage(meeting_places(nodes, radius), "simhash-places")
    sizes = (places.groupBy("place").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > 1))
    chunks = F.ceil(F.col("n") / (2 * CHUNK)) * F.when(F.col("n") > 2 * CHUNK, 2).otherwise(1)
    shared = places.join(sizes, "place").select("place", "fp", chunks.cast("int").alias("k"))
    # a row of chunk c meets every other chunk d once, as the pair (min, max)
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("k")).cast("int")
    dealt = shared.select("place", "fp", "k", own.alias("c"), F.explode(
        F.sequence(F.lit(0), F.col("k") - 1)).alias("d"))
    dealt = dealt.where((F.col("k") == 1) | (F.col("c") != F.col("d")))
    dealt = dealt.select(
        F.xxhash64("place", F.least("c", "d"), F.greatest("c", "d")).alias("spot"), "fp")

    def run(batches):
        for table in whole_groups(batches, "spot"):
            spots = table.column("spot").to_numpy()
            fps = table.column("fp").to_numpy()
            us, vs = [], []
            for start, end, groups in blocks(spots, BLOCK):
                group = np.repeat(np.arange(len(groups)), np.diff([*groups, end]))
                values = fps[start:end]
                for i, j in spanning_links(values.view(np.uint64), group, radius):
                    us.append(values[i])
                    vs.append(values[j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return (dealt.repartition("spot").sortWithinPartitions("spot")
            .mapInArrow(run, "u long, v long"))


def near_groups(docs: DataFrame, shingle: int, radius: int) -> DataFrame:
    """doc_id, key, fp, root (its group), component_id (smallest doc_id of the group)."""
    rows = cut_lineage(fingerprints(docs, shingle), "simhash-fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    nodes = cut_lineage(nodes, "simhash-nodes")
    roots = connected_components(near_links(nodes.select("fp"), radius))
    nodes = (nodes.join(roots, nodes["fp"] == roots["node"], "left")
             .select("fp", "least_id", F.coalesce("root", "fp").alias("root")))
    least = nodes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    nodes = nodes.join(least, "root").select("fp", "root", "component_id")
    return rows.join(nodes, "fp").select("doc_id", "key", "fp", "root", "component_id")


def one_of_each_group(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row of each group of near copies: the smallest doc_id's."""
    groups = near_groups(docs, shingle, radius)
    chosen = (groups.groupBy("root")
              .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key"))
                   .alias("first"))
              .select(F.col("first.key").alias("key")))
    rows = T.packed(docs).join(chosen, "key", "left_semi")
    # rows equal in doc_id, source and text may still be repeated
    return T.unpacked(rows.dropDuplicates(["key"]), docs.columns)


def op6_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    groups = near_groups(T.documents(spark, sf_dir), shingle=3, radius=3)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")
