"""Stage a table as time-ordered stream input files (test harness).

In production the input is a Kafka topic. Here a DataFrame derived from the
given tables is written once to the shared folder (cutting its lineage, so
the upstream joins run once), then all time slices are written by one job
into ``_slice=k`` folders. Every slice has the same number of files, which
follows the row count: a stream that reads so many files a micro-batch
(``slice_files``) reads whole slices, so no batch holds later rows than the
next one. The file times of slice k are then set in slice order (a metadata
call per file), so the file source reads the slices in order; this needs a
file system that keeps such times (an object store may not).

A stateless job needs no order: its input is written as it is (``stage_files``).
Where the bounds are known beforehand, slices too are written by the tasks that
make the rows (``lying``), without a copy or a shuffle.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, functions as F

from rtmart.operators.lineage import write_and_read
from rtmart.operators.upsert import file_system
from rtmart.session import setting


def _order_slices(spark, path: str, slices) -> None:
    jvm, _, fs = file_system(spark, path)
    Path = jvm.org.apache.hadoop.fs.Path
    now = int(time.time() * 1000)
    for k in slices:
        folder = Path(f"{path.rstrip('/')}/_slice={k}")
        if not fs.exists(folder):
            continue
        for st in fs.listStatus(folder):
            fs.setTimes(st.getPath(), now + 1000 * int(k), -1)


ROWS_PER_FILE = 200_000
ROWS_PER_SLICE = 16_000_000


def _fill_slices(df: DataFrame, path: str, slices, files: int) -> None:
    """Add empty files to slices that have fewer than ``files``: the rows of a
    file may be too few to make one."""
    spark = df.sparkSession
    jvm, _, fs = file_system(spark, path)
    Path = jvm.org.apache.hadoop.fs.Path
    missing = []
    for k in slices:
        folder = Path(f"{path.rstrip('/')}/_slice={k}")
        have = len(fs.listStatus(folder)) if fs.exists(folder) else 0
        missing += [(folder, n) for n in range(have, files)]
    if not missing:
        return
    empty = f"{path.rstrip('/')}_empty"
    df.limit(0).coalesce(1).write.mode("overwrite").parquet(empty)
    source = next(st.getPath() for st in fs.listStatus(Path(empty))
                  if st.getPath().getName().endswith(".parquet"))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder, n in missing:
        fs.mkdirs(folder)
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, fs, Path(folder, f"empty-{n:05d}.parquet"),
                                               False, True, conf)
    fs.delete(Path(empty), True)


def _slice_of(bounds: tuple, n_slices: int):
    """The slice of a row by its time ``_t``; times beyond the bounds are in the first and last."""
    lo, hi = bounds
    width = (hi - lo) / n_slices if hi > lo else 1.0
    return F.least(F.greatest(F.floor((F.col("_t") - lo) / width), F.lit(0)),
                   F.lit(n_slices - 1)).cast("int")


def _write_as_they_lie(sliced: DataFrame, path: str, slices: list, files: int,
                       rows_per_file: int | None) -> None:
    """Write rows with their ``_slice`` by the tasks that have them.

    A task holds a file of each slice open, so that no text is sorted. Slices
    get empty files up to the largest number that one has below ``path``.
    """
    spark = sliced.sparkSession
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(len(slices) + 1)):
        (sliced.write.mode("append").option("maxRecordsPerFile", rows_per_file or 0)
               .partitionBy("_slice").parquet(path))
    _fill_slices(spark.createDataFrame([], sliced.drop("_slice").schema), path, slices,
                 max(files, slice_files(spark, path)))


def stage_time_slices(df: DataFrame, time_col, path: str, n_slices: int,
                      files_per_slice: int, bounds: tuple | None = None,
                      keep: list[str] | None = None, only: range | None = None,
                      rows_per_file: int | None = ROWS_PER_FILE,
                      rows_per_slice: int | None = None, stored: bool = False,
                      made: tuple = (), lying: bool = False) -> tuple:
    """Write ``df`` as ``n_slices`` time slices under ``path``.

    ``time_col`` is a numeric column or expression (e.g. epoch seconds).
    Returns the (low, high) time bounds used, so a second input can be cut on
    the same boundaries. Only the bounds and the row count reach the driver.
    ``keep`` names the columns written (default: all); ``only`` writes a
    subset of slices (a later call appends the rest, read after the earlier
    ones). A slice has ``files_per_slice`` files, or more where they would
    hold over ``rows_per_file`` rows each (None: never). There are more slices
    where they would hold over ``rows_per_slice`` rows each (None: never).
    ``stored``: ``df`` is read from files and need not be copied first.
    ``made``: columns (e.g. texts) written in place of the kept ones, made from
    them after the shuffle. ``lying``: the rows are written once, by the tasks
    that make them, into ``n_slices`` between the ``bounds`` given; a slice has
    the files that those tasks make.
    """
    t = F.col(time_col) if isinstance(time_col, str) else time_col
    cols = keep or list(df.columns)
    timed = df.select(*cols, t.cast("double").alias("_t"))
    if lying:
        slices = list(only if only is not None else range(n_slices))
        sliced = timed.withColumn("_slice", _slice_of(bounds, n_slices))
        if only is not None:
            sliced = sliced.where(F.col("_slice").isin(slices))
        _write_as_they_lie(sliced.select(*cols, "_slice"), path, slices, files_per_slice, rows_per_file)
        _order_slices(df.sparkSession, path, slices)
        return bounds
    staged_path = f"{path.rstrip('/')}_staged"
    staged = timed if stored else write_and_read(timed, staged_path)
    row = staged.agg(F.min("_t").alias("lo"), F.max("_t").alias("hi"),
                     F.count(F.lit(1)).alias("n")).first()
    if bounds is None:
        bounds = (float(row["lo"] or 0.0), float(row["hi"] or 0.0))
    if rows_per_slice:
        n_slices = max(n_slices, -(-row["n"] // rows_per_slice))
    idx = _slice_of(bounds, n_slices)
    slices = list(only if only is not None else range(n_slices))
    files = files_per_slice
    if rows_per_file:
        files = max(files, -(-row["n"] // (n_slices * rows_per_file)))
    out = list(made) or cols
    sliced = staged.withColumn("_slice", idx).where(F.col("_slice").isin(slices))
    file = (F.col("_slice") - slices[0]) * files + F.pmod(F.xxhash64(*cols), F.lit(files)).cast("int")
    (sliced.repartitionById(files * len(slices), file).select(*out, "_slice")
           .write.mode("append").partitionBy("_slice").parquet(path))
    _fill_slices(staged.select(*out), path, slices, files)
    _order_slices(df.sparkSession, path, slices)
    if not stored:
        _, root, fs = file_system(df.sparkSession, staged_path)
        fs.delete(root, True)
    return bounds


def slice_files(spark, path: str) -> int:
    """The files of one slice below ``path``: what a micro-batch reads."""
    jvm, root, fs = file_system(spark, path)
    folders = [st.getPath() for st in fs.listStatus(root) if st.isDirectory()
               and st.getPath().getName().startswith("_slice=")]
    return max((len(fs.listStatus(f)) for f in folders), default=1)


def stage_files(df: DataFrame, path: str, batches: int, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Write ``df`` once, as its tasks give it, for a job that needs no order.

    Returns the files a micro-batch is to read for ``batches`` of them.
    """
    (df.write.mode("overwrite").option("compression", "zstd")        # texts, written once and read once
       .option("maxRecordsPerFile", rows_per_file).parquet(path))
    _, root, fs = file_system(df.sparkSession, path)
    files = sum(st.getPath().getName().endswith(".parquet") for st in fs.listStatus(root))
    return max(1, -(-files // batches))
