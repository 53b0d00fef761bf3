"""Embedding near-dedup by counting collisions of one-dimensional projections.

Unit vectors are projected on many Gaussian directions. Two vectors collide on
a direction when one lies in the window centred on the other; near pairs
collide on most directions, far pairs on few, so a pair is verified (cosine in
double precision) only when its count reaches a bound that near pairs miss
with a probability of ``COUNT_MISS`` at most. A one-dimensional window alone holds a
fixed share of all rows, whatever its width, so counting starts only for pairs
that meet in a cell of several sorted projections cut at fixed widths; there
are enough cell tables that a pair at the threshold misses all of them with a
probability of ``MISS`` at most, and the number of projections to a cell grows
with the logarithm of the rows, which keeps chance meetings few.

Equal vectors are one class, compared once. A cell with many rows is cut into
chunks and compared chunk pair by chunk pair. What leaves a task is a count
per vector and a spanning forest of its links, never all pairs; a pair that
meets in several cells is counted in the first of them.

Defined cases: null, empty, zero vectors and those with null or non-finite
components link with nothing; vectors of different lengths never link;
repeated rows are vectors of their own that link; vec_id null is carried and
never names a component unless all its vectors have none; an empty table gives
no rows.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rtmart.llm.graph import connected_components
from rtmart.llm.runs import blocks, whole_groups
from rtmart.operators.lineage import cut_lineage

MIN_COSINE = 0.95
#: Cells are so many times as wide as a near pair's typical difference.
CELL_WIDTH = 6.0
#: Half a counting window, in the same unit.
WINDOW = 1.5
COUNTED = 64
MISS = 0.002
#: The same for the count; a far lower bound costs next to nothing, as far
#: pairs collide on a quarter of the directions.
COUNT_MISS = 1e-5
#: Rows of one cell that one chunk holds.
CHUNK = 512
BLOCK = 256
#: Rows of small cells that are compared together.
PACKED = 64
SEED = 13


def _normal(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def _same_cell(width: float, spread: float) -> float:
    """P(two points whose difference is N(0, spread) share a cell of random offset)."""
    r = width / spread
    return (2 * _normal(r) - 1) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(rows: int, min_cosine: float = MIN_COSINE) -> dict:
    """Cells, tables and the count bound for a table of so many distinct vectors."""
    near = math.sqrt(2 - 2 * min_cosine)
    width = CELL_WIDTH * near
    p_near, p_far = _same_cell(width, near), _same_cell(width, math.sqrt(2))
    per_cell = max(1, math.ceil(math.log(10 * max(rows, 1)) / -math.log(p_far)))
    tables = math.ceil(math.log(MISS) / math.log(1 - p_near ** per_cell))
    p = 2 * _normal(WINDOW) - 1
    bound, missed = 0, 0.0
    while True:                   # the largest bound that near pairs rarely miss
        missed += math.comb(COUNTED, bound) * p ** bound * (1 - p) ** (COUNTED - bound)
        if missed > COUNT_MISS:
            break
        bound += 1
    return {"min_cosine": min_cosine, "width": width, "window": WINDOW * near,
            "per_cell": per_cell, "tables": tables, "bound": bound}


@cache
def _directions(dim: int, per_cell: int, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dim])
    counted = rng.standard_normal((dim, COUNTED))
    return (rng.standard_normal((dim, per_cell * tables)), rng.random(per_cell * tables), counted)


def cell_codes(units: np.ndarray, p: dict) -> np.ndarray:
    """(rows, tables): the cell of each row in each table, as one integer."""
    m, t = p["per_cell"], p["tables"]
    directions, offsets, _ = _directions(units.shape[1], m, t)
    cells = np.floor(units @ directions / p["width"] + offsets).astype(np.int64).astype(np.uint64)
    codes = np.full((len(units), t), units.shape[1], np.uint64)
    with np.errstate(over="ignore"):
        for k in range(m):
            codes = (codes ^ cells[:, k::m]) * np.uint64(0x9E3779B97F4A7C15)
            codes ^= codes >> np.uint64(29)
    return codes


def unit_rows(column: pa.ChunkedArray | pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) for each vector length in the column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(int)
    out = []
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        x = values[starts[rows][:, None] + np.arange(dim)]
        x = x / np.abs(x).max(axis=1, keepdims=True)
        out.append((rows, x / np.linalg.norm(x, axis=1, keepdims=True)))
    return out


def classes(vectors: DataFrame) -> DataFrame:
    """node, vector, n, least_id of each distinct linkable vector."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    linkable = F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    return (vectors.where(linkable).groupBy("vector")
            .agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("n"))
            .select(F.xxhash64("vector").alias("node"), "vector", "n", "least_id"))


def cells(reps: DataFrame, p: dict) -> DataFrame:
    """(place, t, node): a row per class and table."""
    def run(batches):
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            for rows, units in unit_rows(batch.column("vector")):
                codes = cell_codes(units, p)
                t = np.broadcast_to(np.arange(p["tables"]), codes.shape)
                yield pa.RecordBatch.from_pydict({
                    "place": codes.ravel().view(np.int64), "t": t.ravel().astype(np.int32),
                    "node": np.repeat(nodes[rows], p["tables"])})

    return reps.select("node", "vector").mapInArrow(run, "place long, t int, node long")


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Some of the links (i, j), enough to span their components."""
    parent = np.arange(n)
    while True:
        # hang each root under the least root that it is linked to
        a, b = parent[i], parent[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if not (low < high).any():
            break
        np.minimum.at(parent, high, low)
        while (parent[parent] != parent).any():
            parent = parent[parent]
    return [(k, int(parent[k])) for k in np.flatnonzero(parent != np.arange(n))]


def _colliding(projected: np.ndarray, group: np.ndarray, p: dict):
    """(i, j) arrays, i < j: pairs of one group that collide on enough directions."""
    n = len(group)
    for q in range(0, n, BLOCK):
        count = np.zeros((min(BLOCK, n - q), n), np.uint8)
        for k in range(COUNTED):                    # the window centred on each query
            count += np.abs(projected[q:q + BLOCK, k, None] - projected[None, :, k]) <= p["window"]
        i, j = np.nonzero(count >= p["bound"])
        i += q
        keep = (i < j) & (group[i] == group[j])
        yield i[keep], j[keep]


def _compare(units, table, own, low, high, group, weight, p):
    """(links per row, forest) of one block of whole groups; rows of one length."""
    n = len(units)
    _, _, counted = _directions(units.shape[1], p["per_cell"], p["tables"])
    links = np.zeros(n, np.int64)
    found_i, found_j = [np.empty(0, int)], [np.empty(0, int)]
    codes = None
    for i, j in _colliding((units @ counted).astype(np.float32), group, p):
        # rows of one chunk meet in several chunk pairs: only one of them counts
        same = own[i] == own[j]
        mine = ~same | np.where(own[i] == 0, high[i] <= 1, low[i] == 0)
        i, j = i[mine], j[mine]
        near = np.einsum("ij,ij->i", units[i], units[j]) >= p["min_cosine"]
        i, j = i[near], j[near]
        if not len(i):
            continue
        if group[0] != group[-1]:                # few of the rows are near another
            rows, at = np.unique(np.concatenate((i, j)), return_inverse=True)
            codes = cell_codes(units[rows], p)
        else:
            at = np.concatenate((i, j))
            codes = cell_codes(units, p) if codes is None else codes
        for s in range(0, len(i), 1 << 14):      # met in an earlier table already?
            a, b = at[s:len(i)][:1 << 14], at[len(i) + s:][:1 << 14]
            first = (codes[a] == codes[b]).argmax(axis=1) == table[i[s:s + (1 << 14)]]
            found_i.append(i[s:s + (1 << 14)][first])
            found_j.append(j[s:s + (1 << 14)][first])
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    np.add.at(links, i, weight[j])
    np.add.at(links, j, weight[i])
    return links, _forest(i, j, n)


def near_pairs(reps: DataFrame, p: dict) -> DataFrame:
    """u, v, links: spanning links (links 0), and u = v with the links counted for u."""
    places = cut_lineage(cells(reps, p), "vector-cells")
    sizes = (places.groupBy("place", "t").agg(F.count(F.lit(1)).alias("m"))
             .where(F.col("m") > 1))
    chunks = F.when(F.col("m") > 2 * CHUNK, F.ceil(F.col("m") / CHUNK)).otherwise(1).cast("int")
    met = places.join(sizes, ["place", "t"]).select(
        "place", "t", "node", chunks.alias("k"))
    met = met.withColumn("own", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    met = met.where((F.col("k") == 1) | (F.col("own") != F.col("other")))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    met = met.select("node", "t", "own", low.alias("low"), high.alias("high"),
                     F.xxhash64("place", "t", low, high).alias("spot"))
    met = met.join(reps.select("node", "vector", "n"), "node")

    def run(batches):
        for table in whole_groups(batches, "spot"):
            spots = table.column("spot").to_numpy()
            for start, end, groups in blocks(spots, PACKED):
                part = table.slice(start, end - start)
                group = np.repeat(np.arange(len(groups)), np.diff([*groups, end]))
                c = {x: part.column(x).to_numpy() for x in ("node", "n", "t", "own", "low", "high")}
                for rows, units in unit_rows(part.column("vector")):
                    links, forest = _compare(units, *(c[x][rows] for x in ("t", "own", "low", "high")),
                                             group[rows], c["n"][rows], p)
                    node, has = c["node"][rows], np.flatnonzero(links)
                    u = [*node[has], *(node[a] for a, _ in forest)]
                    v = [*node[has], *(node[b] for _, b in forest)]
                    yield pa.RecordBatch.from_pydict({
                        "u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()),
                        "links": pa.array([*links[has], *[0] * len(forest)], pa.int64())})

    return (met.repartition("spot").sortWithinPartitions("spot")
            .mapInArrow(run, "u long, v long, links long"))


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of (vec_id, embedding)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("vector"))
    reps = cut_lineage(classes(rows), "vector-classes")
    found = cut_lineage(near_pairs(reps, plan(reps.count(), min_cosine)), "vector-links")
    links = found.groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    roots = connected_components(found.where(F.col("u") != F.col("v")).select("u", "v"))
    nodes = (reps.select("node", "n", "least_id").join(links, "node", "left")
             .join(roots, "node", "left")
             .select("node", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     "least_id", F.coalesce("root", "node").alias("root")))
    least = nodes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    nodes = nodes.join(least, "root").select("node", "n_links", "component_id")
    rows = rows.withColumn("node", F.xxhash64("vector"))
    out = rows.join(nodes, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op4_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
