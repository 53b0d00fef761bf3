"""Durable record of what every micro-batch covered.

A query keeps its last progress reports in memory and its checkpoint the
offsets of the last hundred batches or so. ``ProgressLog`` stores one small
record of every finished batch - the offsets it covered of each source, its
rows, and the rows its stateful operators left out as late - in the shared
folder. Records lie under the query's id and the batch's number, so a report
that comes again replaces itself. After FOLD_EVERY batches the small files are
folded into one; a fold's number range is its name, and readers take a record
once, so a crash between the fold and the clean-up repeats nothing.

A driver that dies after a commit and before its report leaves no record; the
checkpoint still has the offsets of such batches, and ``attach`` with the
checkpoint's path stores them (their row counts are null).
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from rtmart.operators.upsert import file_system

FOLD_EVERY = 500
SCHEMA = ("query string, batch_id long, source string, start_offset string, end_offset string, "
          "rows long, late_rows long, finished string")


def _as_text(offset) -> str | None:
    return None if offset is None else offset if isinstance(offset, str) else json.dumps(offset)


class ProgressLog(StreamingQueryListener):
    """Stores the progress of the session's streaming queries below ``path``."""

    def __init__(self, spark: SparkSession, path: str, fold_every: int = FOLD_EVERY):
        self.spark, self.path, self.fold_every = spark, path.rstrip("/"), fold_every
        self._ended: dict[str, threading.Event] = {}
        self._jvm, _, self._fs = file_system(spark, self.path)

    # -- listener ------------------------------------------------------------

    def onQueryStarted(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        late = sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", []))
        self._store(p["id"], p["batchId"], [
            {"query": p["id"], "batch_id": p["batchId"], "source": f"{i}: {s.get('description')}",
             "start_offset": _as_text(s.get("startOffset")), "end_offset": _as_text(s.get("endOffset")),
             "rows": s.get("numInputRows"), "late_rows": late if i == 0 else 0, "finished": p.get("timestamp")}
            for i, s in enumerate(p.get("sources", []))])
        if self.fold_every and (p["batchId"] + 1) % self.fold_every == 0:
            self.fold(p["id"])

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    # -- use -----------------------------------------------------------------

    def attach(self, checkpoint: str | None = None) -> "ProgressLog":
        """Listen from now on; first store what the checkpoint knows and the log does not."""
        if checkpoint is not None:
            self._catch_up(checkpoint)
        self.spark.streams.addListener(self)
        return self

    def detach(self, query=None, timeout: float = 60.0) -> None:
        """Stop listening, after the last report of ``query`` has come."""
        if query is not None:
            done = self._ended.setdefault(str(query.runId), threading.Event())
            if not done.wait(timeout):
                raise TimeoutError("the query's last progress report has not come")
        self.spark.streams.removeListener(self)

    # -- files ---------------------------------------------------------------

    def _p(self, *parts):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _read(self, path) -> str:
        source = self._fs.open(path)
        text = bytes(source.readAllBytes()).decode()
        source.close()
        return text

    def _write(self, folder: str, name: str, records: list[str]) -> None:
        """Appears under its name whole or not at all."""
        staged = self._p(folder, f"_{name}")
        out = self._fs.create(staged, True)
        out.write(bytearray("".join(r + "\n" for r in records).encode()))
        out.close()
        self._fs.delete(self._p(folder, name), False)
        self._fs.rename(staged, self._p(folder, name))

    def _names(self, folder: str) -> list[str]:
        if not self._fs.exists(self._p(folder)):
            return []
        return sorted(st.getPath().getName() for st in self._fs.listStatus(self._p(folder)))

    def _store(self, query: str, batch: int, records: list[dict]) -> None:
        if records:
            self._fs.mkdirs(self._p(query))
            self._write(query, f"batch-{batch:019d}.json", [json.dumps(r) for r in records])

    def fold(self, query: str) -> None:
        """One file of the query's single records."""
        names = [n for n in self._names(query) if n.startswith("batch-")]
        if not names:
            return
        lines = [line for n in names for line in self._read(self._p(query, n)).splitlines()]
        self._write(query, f"batches-{names[0][6:25]}-{names[-1][6:25]}.json", lines)
        for n in names:
            self._fs.delete(self._p(query, n), False)

    def _known(self, query: str) -> set[int]:
        known = set()
        for n in self._names(query):
            if n.startswith("batch-"):
                known.add(int(n[6:25]))
            elif n.startswith("batches-"):
                known.update(range(int(n[8:27]), int(n[28:47]) + 1))
        return known

    def _catch_up(self, checkpoint: str) -> None:
        Path = self._jvm.org.apache.hadoop.fs.Path
        root = checkpoint.rstrip("/")
        if not self._fs.exists(Path(f"{root}/metadata")):
            return
        query = json.loads(self._read(Path(f"{root}/metadata")))["id"]

        def numbers(folder):
            path = Path(f"{root}/{folder}")
            names = [st.getPath().getName() for st in self._fs.listStatus(path)] if self._fs.exists(path) else []
            return {int(n) for n in names if n.isdigit()}

        offsets, known = numbers("offsets"), self._known(query)
        for batch in sorted(numbers("commits") & offsets - known):
            if batch and batch - 1 not in offsets:
                continue                     # its start is not known any more
            # a version line, a line of metadata, then a line for each source
            ends = self._read(Path(f"{root}/offsets/{batch}")).splitlines()[2:]
            starts = self._read(Path(f"{root}/offsets/{batch - 1}")).splitlines()[2:] if batch else []
            self._store(query, batch, [
                {"query": query, "batch_id": batch, "source": f"{i}: {root}",
                 "start_offset": starts[i] if i < len(starts) and starts[i] != "-" else None,
                 "end_offset": end, "rows": None, "late_rows": None, "finished": None}
                for i, end in enumerate(ends) if end != "-"])


def batch_offsets(spark: SparkSession, path: str) -> DataFrame:
    """One row for each finished batch and source, however long ago.

    Columns of ``SCHEMA``; offsets are the source's JSON texts.
    """
    rows = (spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").json(path.rstrip("/")))
    return rows.dropDuplicates(["query", "batch_id", "source"])


def uncovered(offsets: DataFrame) -> DataFrame:
    """The batches that do not start where the one before ended (there should be none)."""
    from pyspark.sql import Window

    place = F.substring_index("source", ":", 1)
    # one row a batch of one query and source: metadata, not data
    last = Window.partitionBy("query", place).orderBy("batch_id")
    told = offsets.withColumn("expected", F.lag("end_offset").over(last)).withColumn(
        "number", F.row_number().over(last))
    return told.where((F.col("number") > 1) & ~F.col("expected").eqNullSafe(F.col("start_offset")))


def late_rows(offsets: DataFrame) -> int:
    """Rows that the queries' stateful operators left out as later than the watermark."""
    return offsets.agg(F.coalesce(F.sum("late_rows"), F.lit(0))).first()[0]
