"""Vector code compression: product quantisation in exact integers.

Components become integers floor(256 x); a vector is cut into 16 equal parts
and each part position has a codebook of 64 entries, moved by two rounds of
assignment and averaging. Distances come from matrix products in float64 that
are exact: integers are split into limbs so short that no sum of products
reaches 2^53, and the products of limbs are put together in int64. The nearest
entry is the first least one.

A task adds up each entry's parts by itself, so a round shuffles one row for
each partition, part and entry, whatever the number of vectors. The codebooks
are of fixed size and travel with the tasks.

Defined cases: vectors that are null or hold null or non-finite components are
dropped; shorter vectors (empty ones too) are filled up with zeros, and all to
a multiple of 16, so equal vectors of a length that 16 divides are taken as
they are; integers beyond ``largest`` (for 64 components 2^27, which is 2^19
before scaling) are held there, so that a vector's squared distance fits in 64
bits, and a label's summed error ends at the largest long; equal vec_ids are ordered by their
vectors, null ones come last; fewer than 64 vectors give fewer entries;
repeated rows are each coded alike; an empty table gives no rows; other
columns of the caller are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rtmart.operators.lineage import cut_lineage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256.0
#: float64 adds integers below this exactly.
EXACT = 53
#: Vectors compared at once.
ROWS_AT_ONCE = 2048


# -- exact products ----------------------------------------------------------

def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 arrays L_k with values = sum of L_k 2^(k bits) and |L_k| <= 2^bits."""
    out = []
    while True:
        if not values.size or np.abs(values).max() <= 1 << bits:
            return [*out, values.astype(np.float64)]
        high = values >> bits                      # rounds down, so the rest is not negative
        out.append((values - (high << bits)).astype(np.float64))
        values = high


def exact_dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a (.., n, d) times b (.., d, k) in int64, for results within 63 bits."""
    terms = max(1, a.shape[-1])
    bits = (EXACT - 1 - (terms - 1).bit_length()) // 2     # terms * 2^(2 bits) < 2^53
    total = np.zeros(1, np.int64)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(limbs(b, bits)):
            total = total + (np.matmul(x, y).astype(np.int64) << np.int64(bits * (i + j)))
    return total


def nearest(parts: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parts, rows) numbers of the first nearest entries, and their squared distances.

    ``parts`` is (parts, rows, width), ``books`` (parts, entries, width), int64.
    """
    own = np.einsum("prw,prw->pr", parts, parts)
    gap = np.einsum("pew,pew->pe", books, books)[:, None, :] - 2 * exact_dot(parts, books.transpose(0, 2, 1))
    first = gap.argmin(axis=2)
    return first, own + np.take_along_axis(gap, first[:, :, None], axis=2)[:, :, 0]


def moved(books: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Entries replaced by the floor of their parts' mean; unused ones stay."""
    used = counts > 0
    mean = sums // np.where(used, counts, 1)[:, :, None]
    return np.where(used[:, :, None], mean, books)


# -- vectors -----------------------------------------------------------------

def largest(width: int) -> int:
    """Integers are held within this: width * (2 largest)^2 < 2^63."""
    return 1 << (61 - (width - 1).bit_length()) // 2


def integers(column: pa.Array, width: int) -> np.ndarray:
    """(rows, width) int64 of an Arrow list column without nulls, filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        flat = np.clip(np.floor(flat * SCALE), -largest(width), largest(width)).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def cut(vectors: np.ndarray) -> np.ndarray:
    """(rows, width) as (parts, rows, width of a part)."""
    return vectors.reshape(len(vectors), PARTS, -1).transpose(1, 0, 2)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and embedding of the vectors whose components are all finite."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").where(
        F.coalesce(finite, F.lit(False)))


def _assigned(batch: pa.RecordBatch, books: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, parts, entry numbers, distances) of bounded runs of a batch's rows."""
    column = batch.column(batch.schema.get_field_index("embedding"))
    width = PARTS * books.shape[2]
    for at in range(0, len(column), ROWS_AT_ONCE):
        parts = cut(integers(column.slice(at, ROWS_AT_ONCE), width))
        yield at, parts, *nearest(parts, books)


def first_codebooks(rows: DataFrame) -> np.ndarray | None:
    """The parts of the vectors with the smallest vec_ids; None without vectors."""
    longest = rows.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        return None
    width = PARTS * max(1, -(-longest // PARTS))
    least = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(ENTRIES)
    vectors = pa.array([r[0] for r in least.collect()], pa.list_(pa.float64()))
    return np.ascontiguousarray(cut(integers(vectors, width)))


def entry_sums(rows: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of the parts that are assigned to each entry."""
    entries, width = books.shape[1:]

    def run(batches):
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for _, parts, first, _ in _assigned(batch, books):
                slot = (np.arange(PARTS)[:, None] * entries + first).ravel()
                counts += np.bincount(slot, minlength=PARTS * entries).reshape(counts.shape)
                np.add.at(sums.reshape(-1, width), slot, parts.reshape(-1, width))
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]),
             pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    partial = rows.select("embedding").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    # one number of a sum a row: at most 16 * 64 * width of them, from each partition
    each = partial.select("part", "entry", "n", F.posexplode("sums").alias("at", "x"))
    total = each.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
    for r in total.collect():
        counts[r["part"], r["entry"]] = r["n"]
        sums[r["part"], r["entry"], r["at"]] = r["x"]
    return sums, counts


def codebooks(rows: DataFrame, rounds: int = ROUNDS) -> np.ndarray | None:
    """(parts, entries, width of a part) after the rounds; None without vectors."""
    books = first_codebooks(rows)
    for _ in range(rounds if books is not None else 0):
        books = moved(books, *entry_sums(rows, books))
    return books


def coded(rows: DataFrame, books: np.ndarray | None) -> DataFrame:
    """vec_id, label, codes (16 entry numbers) and error of each vector."""
    label = rows.schema["label"].dataType.simpleString()

    def run(batches):
        for batch in batches if books is not None else ():
            codes, errors = [], []
            for _, _, first, distance in _assigned(batch, books):
                codes.append(first.T)
                errors.append(distance.sum(axis=0))
            if codes:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"),
                     pa.array(list(np.concatenate(codes).astype(np.int32)), pa.list_(pa.int32())),
                     pa.array(np.concatenate(errors))], ["vec_id", "label", "codes", "error"])

    return rows.mapInArrow(run, f"vec_id long, label {label}, codes array<int>, error long")


def decoded(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    """(rows, width) integers that codes (rows, parts) stand for."""
    return books[np.arange(PARTS)[None, :], codes].reshape(len(codes), -1)


def digest(books: np.ndarray | None) -> str:
    values = "" if books is None else ",".join(map(str, books.ravel().tolist()))
    return hashlib.sha256(values.encode()).hexdigest()


def compressed(vectors: DataFrame) -> tuple[DataFrame, np.ndarray | None]:
    """The coded vectors, in the shared folder, and the codebooks that decode them."""
    rows = usable(vectors)
    books = codebooks(rows)
    return cut_lineage(coded(rows, books), "vector-codes"), books


def op13_vector_code_compression(spark, sf_dir: str) -> DataFrame:
    rows, books = compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    # few labels are sent to the rows; with many, adaptive execution splits a hot one
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    labels = rows.groupBy(F.col("label").alias("of")).agg(
        F.least(F.sum(F.col("error").cast("decimal(20,0)")).cast("decimal(38,0)"), most)
        .cast("long").alias("label_error"))
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c.cast("long"))), 2, "0")), "")
    return rows.join(labels, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", code.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
