"""Keyed upsert (K3/K4/A6): latest row per key.

A keyed store (a row store with upsert, or a search index with document ids)
is kept as append-only versions; readers take the latest version per key.
The reduction is an aggregate, ``max(struct(order..., values...))`` per key, so
it is combined map-side before the shuffle: a hot key costs one row per input
partition in the exchange, never a whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str],
                   deleted_col: str | None = None, first: bool = False) -> DataFrame:
    """Keep, per ``keys``, the row with the greatest (``first``: the smallest)
    ``order_cols`` tuple.

    Rows equal in ``order_cols`` are copies of one change; should they differ,
    the remaining columns decide, so the result is deterministic. With
    ``deleted_col``, keys whose latest row is a delete are removed.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols + rest])
    agg = df.groupBy(*keys).agg((F.min if first else F.max)(packed).alias("_latest"))
    out = agg.select(*[F.col(k) for k in keys],
                     *[F.col("_latest").getField(c).alias(c) for c in order_cols + rest])
    if deleted_col:
        out = out.where(~F.coalesce(F.col(deleted_col), F.lit(False))).drop(deleted_col)
    return out.select(*df.columns) if not deleted_col else out


# Layout: <path>/batch_id=N/kind=delta  -- the rows batch N wrote
#         <path>/batch_id=N/kind=base   -- every version before N, folded
# Within one batch_id, "delta" sorts after "base", so a batch's own rows win.
DELTA = "delta"
BASE = "base"


BLOOM_VALUES = 1_000_000      # distinct values a row group's Bloom filter is sized for


def write_version(df: DataFrame, path: str, batch_id: int,
                  partition_by: list[str] | None = None, kind: str = DELTA,
                  bloom: list[str] | None = None, compression: str | None = None,
                  rebalance: bool = True) -> None:
    """Write one batch's rows as version ``batch_id``.

    The directory of a version is overwritten as a whole, so a replayed batch
    (at-least-once delivery) replaces its own earlier attempt: idempotent.
    ``partition_by`` adds sub-folders (e.g. ``dt``) so readers of one key
    value prune the others; ``bloom`` names columns that get a Parquet Bloom
    filter, so that readers of a few values skip whole row groups.
    ``rebalance=False`` is for rows of which a task has few such values: they
    are written as they lie, not shuffled into few files a folder.
    """
    target = f"{path.rstrip('/')}/batch_id={int(batch_id)}/kind={kind}"
    if partition_by:   # few files per folder; AQE still splits a hot value
        df = df.hint("rebalance", *partition_by) if rebalance else df
        w = df.write.mode("overwrite").partitionBy(*partition_by)
    else:
        w = df.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    for c in bloom or []:
        w = (w.option(f"parquet.bloom.filter.enabled#{c}", "true")
             .option(f"parquet.bloom.filter.expected.ndv#{c}", str(BLOOM_VALUES)))
    w.parquet(target)


def is_complete(spark: SparkSession, path: str, batch_id: int, kind: str = DELTA) -> bool:
    """Whether version ``batch_id`` has been written to its end."""
    jvm, root, fs = file_system(spark, f"{path.rstrip('/')}/batch_id={int(batch_id)}/kind={kind}")
    return fs.exists(jvm.org.apache.hadoop.fs.Path(root, "_SUCCESS"))


def write_version_once(df: DataFrame, path: str, batch_id: int,
                       partition_by: list[str] | None = None, **how) -> None:
    """``write_version`` for versions that a file stream reads (``how``: its other options).

    A version that is complete stays as it is: a replay gives the same rows
    and must not put them under new file names, which the stream would take
    as new input. It is written aside and renamed, so the stream finds all of
    its files or none.
    """
    if is_complete(df.sparkSession, path, batch_id):
        return
    jvm, root, fs = file_system(df.sparkSession, path.rstrip("/"))
    Path = jvm.org.apache.hadoop.fs.Path
    name = f"batch_id={int(batch_id)}"
    write_version(df, f"{path.rstrip('/')}/_aside", batch_id, partition_by, **how)
    fs.delete(Path(root, name), True)                 # an attempt that was not finished
    if not fs.rename(Path(root, f"_aside/{name}"), Path(root, name)):
        raise RuntimeError(f"could not put version {batch_id} in place below {path}")


def write_files_once(df: DataFrame, path: str, batch_id: int) -> None:
    """Add one batch's rows to a plain folder of files, once.

    The rows are written aside first; a batch that is complete there is not
    written again, and its files are then moved into the folder under their
    names. A replay finds it complete and moves what is left.
    """
    spark = df.sparkSession
    aside = f"{path.rstrip('/')}/_aside"
    if not is_complete(spark, aside, batch_id):
        write_version(df, aside, batch_id)
    jvm, root, fs = file_system(spark, path.rstrip("/"))
    Path = jvm.org.apache.hadoop.fs.Path
    written = Path(root, f"_aside/batch_id={int(batch_id)}/kind={DELTA}")
    for st in fs.listStatus(written):
        name = st.getPath().getName()
        if name.startswith("part-") and not fs.rename(st.getPath(), Path(root, f"batch-{int(batch_id)}-{name}")):
            raise RuntimeError(f"could not put {name} of batch {batch_id} in place below {path}")
    drop_versions(spark, aside, before=batch_id)


def drop_versions(spark: SparkSession, path: str, before: int) -> None:
    """Delete the versions earlier than ``before``, for good."""
    _, root, fs = file_system(spark, path)
    for st in fs.listStatus(root) if fs.exists(root) else []:
        name = st.getPath().getName()
        if name.startswith("batch_id=") and int(name.split("=", 1)[1]) < int(before):
            fs.delete(st.getPath(), True)


def version_numbers(spark: SparkSession, path: str) -> list[int]:
    """The versions written to their end, ascending (a folder listing)."""
    jvm, root, fs = file_system(spark, path)
    if not fs.exists(root):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(root)]
    numbers = sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("batch_id="))
    return [n for n in numbers if any(is_complete(spark, path, n, k) for k in (DELTA, BASE))]


def as_of_floor(spark: SparkSession, path: str) -> int | None:
    """The earliest version that the table can still be read as of, if folds have dropped some."""
    jvm, root, fs = file_system(spark, path)
    if not fs.exists(root):
        return None
    names = [st.getPath().getName() for st in fs.listStatus(root)]
    return max((int(n[len(FLOOR):]) for n in names if n.startswith(FLOOR)), default=None)


def read_versions(spark: SparkSession, path: str, schema=None,
                  before: int | None = None) -> DataFrame:
    """All stored versions (columns ``batch_id`` and ``kind`` from the folders).

    ``before=N`` reads what batch N builds on: versions ``< N`` plus the base
    folded at N (partition pruning). A replayed batch N therefore never sees
    its own earlier output.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.option("basePath", path).parquet(path)
    if before is not None:
        b = F.lit(int(before))
        df = df.where((F.col("batch_id") < b)
                      | ((F.col("batch_id") == b) & (F.col("kind") == F.lit(BASE))))
    return df


def read_latest(spark: SparkSession, path: str, keys: list[str], order_cols: list[str],
                schema=None, before: int | None = None) -> DataFrame:
    """Latest row per key over the stored versions (``batch_id`` kept)."""
    order = ["batch_id", "kind"] + [c for c in order_cols if c not in ("batch_id", "kind")]
    return latest_per_key(read_versions(spark, path, schema, before), keys, order).drop("kind")


def read_first(spark: SparkSession, path: str, keys: list[str],
               order_cols: list[str] | None = None, columns: tuple = ()) -> DataFrame:
    """The first row per key over the stored versions, by ``order_cols`` or
    else by version: what came first stays, whatever is delivered again.
    ``columns``: those wanted, keys included (default: all)."""
    order = order_cols or ["batch_id", "kind"]
    rows = read_versions(spark, path)
    if columns:
        rows = rows.select(*columns, *[c for c in ["batch_id", "kind", *order] if c not in columns])
    return latest_per_key(rows, keys, order, first=True).drop("kind")


FOLDED = "_folded_"      # lists the folders that a fold made redundant
FLOOR = "_as_of_floor_"  # names the fold whose redundant folders are gone


def file_system(spark: SparkSession, path: str):
    """(JVM gateway, Hadoop path, its file system)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    _, root, fs = file_system(spark, path)
    return fs.exists(root)


def compact(spark: SparkSession, path: str, keys: list[str], order_cols: list[str],
            at: int, schema=None, drop_older: bool = True,
            partition_by: list[str] | None = None, since: int | None = None,
            first: bool = False, cluster_by: list[str] | None = None) -> None:
    """Fold stored versions into the base of version ``at``.

    ``cluster_by`` sorts the folded rows by these columns over all files and
    adds Bloom filters on them: a read of a few keys then touches the few row
    groups that may hold them, however large the base is.

    ``first`` keeps the first row per key (see ``read_first``) instead of the
    latest.

    ``since=None`` folds every version before ``at`` (a full base: reads then
    start there). ``since=M`` folds only the deltas of batches ``M .. at-1``
    into a segment; older bases stay, so the cost is proportional to the
    recent batches, not to the table. Readers take the latest row per key
    over bases and deltas, which is the same result either way.

    Steps: delete what the fold before this one made redundant, stage the
    folded rows in a hidden folder, write them as ``batch_id=at/kind=base``,
    then list what they make redundant in a ``_folded_<at>`` file. So a folder
    outlives its fold by one whole period, and a reader that listed files
    before the fold still finds them; until then the redundant rows change no
    result. No step removes data not held elsewhere; a re-run after a crash
    repeats the same result.
    """
    base = path.rstrip("/")
    staged = f"{base}/_compact_{int(at)}"
    if drop_older:                           # before the files are listed
        drop_folded(spark, base, before=at)
    versions = read_versions(spark, path, schema, before=at)
    if since is not None:
        versions = versions.where(
            (F.col("batch_id") > F.lit(int(since)))
            | ((F.col("batch_id") == F.lit(int(since))) & (F.col("kind") == F.lit(DELTA))))
    if first:
        order = order_cols or ["batch_id", "kind"]
    else:
        order = ["batch_id", "kind"] + [c for c in order_cols if c not in ("batch_id", "kind")]
    folded = latest_per_key(versions, keys, order, first=first).drop("kind", "batch_id")
    folded.write.mode("overwrite").parquet(staged)
    rows = spark.read.parquet(staged)
    if cluster_by:
        rows = rows.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    write_version(rows, base, at, partition_by, kind=BASE, bloom=cluster_by)
    jvm, root, fs = file_system(spark, base)
    Path = jvm.org.apache.hadoop.fs.Path
    lo = -1 if since is None else int(since)
    redundant = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if not name.startswith("batch_id="):
            continue
        b = int(name.split("=", 1)[1])
        if lo < b < int(at):
            redundant.append(name)
        elif b == lo:                        # that batch's own base stays
            redundant.append(f"{name}/kind={DELTA}")
    out = fs.create(Path(f"{base}/{FOLDED}{int(at)}"), True)
    out.write(bytearray("\n".join(redundant).encode()))
    out.close()
    fs.delete(Path(staged), True)


def drop_folded(spark: SparkSession, path: str, before: int) -> None:
    """Delete the folders that folds earlier than ``before`` made redundant."""
    base = path.rstrip("/")
    jvm, root, fs = file_system(spark, base)
    Path = jvm.org.apache.hadoop.fs.Path
    if not fs.exists(root):
        return
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if not name.startswith(FOLDED) or int(name[len(FOLDED):]) >= int(before):
            continue
        floor = Path(f"{base}/{FLOOR}{int(name[len(FOLDED):])}")
        fs.create(floor, True).close()       # before anything is gone
        source = fs.open(st.getPath())
        listed = bytes(source.readAllBytes()).decode().split("\n")
        source.close()
        for folder in filter(None, listed):
            target = Path(f"{base}/{folder}")
            fs.delete(target, True)
            if "/" in folder and fs.exists(target.getParent()) \
                    and len(fs.listStatus(target.getParent())) == 0:
                fs.delete(target.getParent(), True)
        fs.delete(st.getPath(), False)


def compaction_plan(batch: int, every: int, full_every: int | None) -> tuple[bool, int | None]:
    """(compact now?, since) for a tiered schedule: every ``every`` batches
    fold the deltas since the previous fold; every ``full_every`` batches
    (if given) fold everything."""
    if not every or batch <= 0 or batch % every:
        return False, None
    if full_every and batch % full_every == 0:
        return True, None
    return True, max(batch - every, 0)
