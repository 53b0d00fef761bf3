"""As-of reads of versioned tables, and what a batch pins for its replay.

A micro-batch that reads a side table reads it as of that table's newest
complete version and stores this number beside its own output before anything
is written. A replay of the batch finds the number there and reads the same
rows, whatever the side table has become in the meantime.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rtmart.operators.upsert import (as_of_floor, file_system, latest_per_key, read_versions,
                                     version_numbers)

PINS = "_pins"          # hidden from readers of the table it lies in
KEPT_PINS = 100         # a stream replays its last batch only


def newest_version(spark: SparkSession, path: str) -> int | None:
    """The largest version that was written to its end; None without one."""
    return max(version_numbers(spark, path), default=None)


def read_as_of(spark: SparkSession, path: str, keys: list[str], order_cols: list[str],
               version: int | None, deleted_col: str | None = None) -> DataFrame | None:
    """The latest row per key over the versions up to ``version``.

    None for no version. Raises where a fold has already taken in later
    versions and dropped the earlier ones, instead of giving later rows.
    """
    if version is None:
        return None
    floor = as_of_floor(spark, path)
    if floor is not None and version < floor:
        raise ValueError(f"{path} can be read as of version {floor} or later only, not {version}")
    rows = read_versions(spark, path).where(F.col("batch_id") <= F.lit(int(version)))
    order = ["batch_id", "kind"] + [c for c in order_cols if c not in ("batch_id", "kind")]
    return latest_per_key(rows, keys, order, deleted_col).drop("batch_id", "kind")


@dataclass
class VersionedTable:
    """A keyed table kept as versions, readable as of any of them."""

    spark: SparkSession
    path: str
    keys: list[str]
    order_cols: list[str]
    deleted_col: str | None = None

    def version(self) -> int | None:
        return newest_version(self.spark, self.path)

    def as_of(self, version: int | None) -> DataFrame | None:
        return read_as_of(self.spark, self.path, self.keys, self.order_cols, version,
                          self.deleted_col)


def _pin_numbers(fs, folder) -> list[int]:
    if not fs.exists(folder):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_pin(spark: SparkSession, path: str, batch: int) -> dict | None:
    """What batch ``batch`` of the table at ``path`` pinned."""
    jvm, root, fs = file_system(spark, f"{path.rstrip('/')}/{PINS}")
    pin = jvm.org.apache.hadoop.fs.Path(root, f"{int(batch)}.json")
    if not fs.exists(pin):
        return None
    source = fs.open(pin)
    text = bytes(source.readAllBytes()).decode()
    source.close()
    return json.loads(text)


def last_pin(spark: SparkSession, path: str, before: int) -> dict | None:
    """The pin of the last batch before ``before`` that has one."""
    jvm, root, fs = file_system(spark, f"{path.rstrip('/')}/{PINS}")
    earlier = [n for n in _pin_numbers(fs, root) if n < before]
    return read_pin(spark, path, earlier[-1]) if earlier else None


def pinned(spark: SparkSession, path: str, batch: int, now: Callable[[], dict]) -> dict:
    """The batch's pin: the stored one, or ``now()`` stored first.

    It appears under its name by a rename, whole or not at all. Only the last
    KEPT_PINS are kept.
    """
    found = read_pin(spark, path, batch)
    if found is not None:
        return found
    jvm, root, fs = file_system(spark, f"{path.rstrip('/')}/{PINS}")
    Path = jvm.org.apache.hadoop.fs.Path
    values = now()
    fs.mkdirs(root)
    staged = Path(root, f"{int(batch)}.json.tmp")
    out = fs.create(staged, True)
    out.write(bytearray(json.dumps(values).encode()))
    out.close()
    if not fs.rename(staged, Path(root, f"{int(batch)}.json")):
        raise RuntimeError(f"could not store the pin of batch {batch} below {path}")
    for n in _pin_numbers(fs, root)[:-KEPT_PINS]:
        fs.delete(Path(root, f"{n}.json"), False)
    return values

