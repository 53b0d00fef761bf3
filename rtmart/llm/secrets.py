"""Secret scans: base patterns and a character network over all candidates.

Base findings come from the fixed patterns. Candidates are all runs of token
characters of SHORTEST or more, whatever they hold; the ones in which a base
finding's value lies are labelled findings, those that no base finding
overlaps are labelled clean. The network starts from a fit on the driver (at
most ``sample`` distinct findings and as many clean candidates) and is then
fitted in ROUNDS on all findings and all clean candidates of all texts: each
text is of one round, in which tasks add up the gradient over its candidates;
both labels weigh the same, and the clean candidates above the twentieth that
scored highest in the round before are left out (see ``secret_net.train``).
Then every candidate is scored in its context. Calibration and threshold come
from the counts of all these scores: the threshold keeps the wanted share of
all labelled findings, and a candidate at or above it that no base finding
overlaps is added as kind ``model``.

Defined cases: a null text is empty; a text of any length is scanned whole;
without labelled findings of both kinds nothing is added; repeated rows get
the same spans; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rtmart.llm import secret_net as N, text as T
from rtmart.operators.lineage import cut_lineage

KINDS = ["assign", "access", "hex", "model"]
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
HEX = re.compile("[0-9a-f]{24,}")
#: The shortest candidate.
SHORTEST = 6
#: Labelled findings, and as many clean candidates, of the start at most.
SAMPLE = 3000
#: Steps over all candidates; each text counts in one of them.
ROUNDS = 8
#: Sums of gradients are whole multiples of this, so that their order does not matter.
GRAIN = 2.0 ** -24
#: By character code: token characters and digits.
_TOKEN, _DIGIT = [np.isin(np.arange(256), N.text_codes(some)).tobytes() for some in (
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-", "0123456789")]
#: The shortest access or hex finding.
SHORTEST_KEY = 20


def base_findings(text: str, start: np.ndarray | None = None,
                  end: np.ndarray | None = None) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of the base findings, by start, then kind.

    The text's candidates, if given, tell where to look: an access or hex finding
    holds token characters only, so it lies within one candidate.
    """
    spans = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        spans += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= 6]
    # longest runs, so demanding the length is the same as dropping shorter ones
    runs = [(0, len(text))]
    if start is not None:
        long = np.flatnonzero(end - start >= SHORTEST_KEY)
        runs = zip(start[long].tolist(), end[long].tolist())
    for a, b in runs:
        spans += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text, a, b)]
        spans += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text, a, b)]
    return sorted(spans)


def candidates(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of token characters of SHORTEST or more."""
    token = np.frombuffer(b"\0" + codes.tobytes().translate(_TOKEN) + b"\0", bool)
    edge = np.flatnonzero(token[1:] != token[:-1])
    start, end = edge[::2], edge[1::2]
    long = end - start >= SHORTEST
    return start[long], end[long]


def labelled(start: np.ndarray, end: np.ndarray, findings: list) -> tuple[np.ndarray, np.ndarray]:
    """Which candidates hold a finding's value, and which no finding overlaps."""
    found, clean = np.zeros(len(start), bool), np.ones(len(start), bool)
    for a, _, b, value in findings:
        for x, mark, to in ((a, clean, False), (value, found, True)):
            mark[np.searchsorted(end, x, "right"):np.searchsorted(start, b, "left")] = to
    return found, clean


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), T.row_key().alias("key"),
                       T.whole_text().alias("text"))


def training_windows(docs: DataFrame) -> DataFrame:
    """found, window, order: every labelled finding and two clean candidates of each text."""
    def run(batches):
        for batch in batches:
            found, window = [], []
            for key, value in zip(batch.column("key").to_pylist(), batch.column("text")):
                text = value.as_py()
                codes = N.text_codes(text)
                start, end = candidates(codes)
                hit, clean = labelled(start, end, base_findings(text, start, end))
                clean = np.flatnonzero(clean)
                chosen = []
                if len(clean):
                    digits = np.flatnonzero(np.frombuffer(codes.tobytes().translate(_DIGIT), bool))
                    with_digit = clean[np.searchsorted(digits, end[clean]) > np.searchsorted(digits, start[clean])]
                    chosen = [some[key % len(some)] for some in (clean, with_digit) if len(some)]
                for label, some in ((True, np.flatnonzero(hit)), (False, np.array(chosen, int))):
                    for k in range(0, len(some), 4096):
                        at = some[k:k + 4096]
                        window.extend(w.tobytes() for w in N.windows(codes, start[at], end[at]))
                        found.extend([label] * len(at))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.bool_()), pa.array(window, pa.binary())],
                                             ["found", "window"])

    each = _rows(docs).select("key", "text").mapInArrow(run, "found boolean, window binary")
    # equal findings of copied texts teach nothing new
    return each.distinct().withColumn("order", F.xxhash64("window", F.lit(3)))


def fitted(windows: DataFrame, sample: int = SAMPLE) -> dict | None:
    """The network's start, fitted on a bounded sample; None without both labels."""
    rows = [r for found in (True, False) for r in
            windows.where(F.col("found") == found).orderBy("order", "window").limit(sample).collect()]
    y = np.array([r["found"] for r in rows], np.float32)
    if len(set(y.tolist())) < 2:
        return None
    return N.train(N.from_bytes([bytes(r["window"]) for r in rows]), y)


def _chunks(codes: np.ndarray, start: np.ndarray, end: np.ndarray, which: np.ndarray):
    """(places, windows) of the candidates ``which``, some thousands at once."""
    for k in range(0, len(which), 4096):
        at = which[k:k + 4096]
        yield at, N.windows(codes, start[at], end[at])


def round_sums(texts: DataFrame, net: dict, most: float) -> DataFrame:
    """found, place, value: gradient (in GRAINs, by place), rows (place -1) and counts of
    raw scores (from place PLACES on) of all candidates of ``texts`` (key, text)."""
    shared = texts.sparkSession.sparkContext.broadcast(net)      # of fixed size

    def run(batches):
        net = shared.value
        pairs = N.pair_tables(net)
        sums = {label: [np.zeros(N.PLACES), np.zeros(N.BINS, np.int64)] for label in (True, False)}
        waiting = {label: [] for label in sums}

        def add(label, enough):
            if sum(map(len, waiting[label])) >= enough:
                g, z = N.gradient(net, np.concatenate(waiting[label]), label, np.inf if label else most, pairs)
                sums[label][0] += g
                sums[label][1] += np.bincount(N.bins(z), minlength=N.BINS)
                waiting[label].clear()

        for batch in batches:
            for key, value in zip(batch.column("key").to_pylist(), batch.column("text")):
                text = value.as_py()
                codes = N.text_codes(text)
                start, end = candidates(codes)
                rng = np.random.default_rng(key & (2 ** 63 - 1))
                findings = base_findings(text, start, end)
                for label, marked in zip((True, False), labelled(start, end, findings)):
                    for _, x in _chunks(codes, start, end, np.flatnonzero(marked)):
                        waiting[label].append(N.hidden(x, rng))
                        add(label, 4096)
        for label in sums:
            add(label, 1)
        for label, (g, counts) in sums.items():
            value = np.concatenate([[counts.sum()], np.rint(g / GRAIN).astype(np.int64), counts])
            at = np.flatnonzero(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(at), pa.bool_()), pa.array(at - 1, pa.int32()),
                 pa.array(value[at], pa.int64())],
                ["found", "place", "value"])

    each = texts.mapInArrow(run, "found boolean, place int, value long")
    return each.groupBy("found", "place").agg(F.sum("value").alias("value"))


def fitted_to_all(docs: DataFrame, net: dict, rounds: int = ROUNDS) -> dict:
    """The network after a step for each round's texts; every candidate counts once."""
    adam, most = N.Adam(), np.inf
    for k in range(rounds):
        texts = (_rows(docs).where(F.pmod(F.xxhash64("key"), F.lit(rounds)) == k).select("key", "text"))
        g, rows = np.zeros(N.PLACES), {True: 0, False: 0}
        clean = np.zeros(N.BINS)
        sums = {label: np.zeros(N.PLACES) for label in rows}
        for r in round_sums(texts, net, most).collect():         # of fixed size
            if r["place"] < 0:
                rows[r["found"]] = r["value"]
            elif r["place"] < N.PLACES:
                sums[r["found"]][r["place"]] = r["value"] * GRAIN
            elif not r["found"]:
                clean[r["place"] - N.PLACES] = r["value"]
        if not all(rows.values()):          # a round without both labels moves nothing
            continue
        for label, n in rows.items():
            g += sums[label] / (2 * n)
        net = adam.moved(net, g)
        if rows[False] > 20:
            most = N.low_edge(N.quantile_bin(clean, 0.95) + 1)
    return net


def raw_scores(net: dict, x: np.ndarray, pairs: list) -> np.ndarray:
    return N.scores(dict(net, slope=1.0, offset=0.0), x, pairs)


def _bins_of(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return N.bins(np.clip(np.log(p) - np.log1p(-p), -60, 60))


def finding_counts(windows: DataFrame, net: dict) -> np.ndarray:
    """Of all labelled findings, how many score in each of BINS."""
    shared = windows.sparkSession.sparkContext.broadcast(net)    # of fixed size

    def run(batches):
        net = shared.value
        pairs = N.pair_tables(net)
        counts = np.zeros(N.BINS, np.int64)
        for batch in batches:
            if batch.num_rows:
                p = raw_scores(net, N.from_bytes(batch.column("window").to_pylist()), pairs)
                counts += np.bincount(_bins_of(p), minlength=N.BINS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], ["bin", "n"])

    return _counted(windows.where("found").select("window").mapInArrow(run, "bin int, n long"))


def _counted(bins: DataFrame) -> np.ndarray:
    counts = np.zeros(N.BINS)
    for r in bins.groupBy("bin").agg(F.sum("n").alias("n")).collect():      # at most BINS rows
        counts[r["bin"]] = r["n"]
    return counts


_SCANNED = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, base string, "
            "start array<long>, end array<long>, p array<double>, bin array<int>, n array<long>")


def scanned(docs: DataFrame, net: dict | None, least: float) -> DataFrame:
    """Base findings of each row and its clean candidates with a raw score of ``least`` or
    more; in the first row of a batch, the counts of the batch's raw scores by bin."""
    shared = docs.sparkSession.sparkContext.broadcast(net)       # of fixed size

    def run(batches):
        net = shared.value
        pairs = N.pair_tables(net) if net is not None else None
        for batch in batches:
            bases, counts = [], [[], [], []]
            more = [[[] for _ in range(batch.num_rows)] for _ in range(3)]
            seen, waiting = np.zeros(N.BINS, np.int64), []

            def score(enough):
                if sum(len(x) for *_, x in waiting) < enough:
                    return
                p = raw_scores(net, np.concatenate([x for *_, x in waiting]), pairs)
                seen[:] += np.bincount(_bins_of(p), minlength=N.BINS)
                parts = np.split(p, np.cumsum([len(x) for *_, x in waiting])[:-1])
                for (row, start, end, x), own in zip(waiting, parts):
                    high = np.flatnonzero(own >= least)
                    for k, got in enumerate((start, end, own)):
                        more[k][row] += got[high].tolist()
                waiting.clear()

            for row, value in enumerate(batch.column("text")):
                text = value.as_py()
                codes = N.text_codes(text)
                start, end = candidates(codes)
                findings = base_findings(text, start, end)
                own = [(a, kind, b) for a, kind, b, _ in findings]
                if net is not None:
                    for at, x in _chunks(codes, start, end, np.flatnonzero(labelled(start, end, findings)[1])):
                        waiting.append((row, start[at], end[at], x))
                        score(4096)
                bases.append(joined(own))
                for k in range(3):
                    counts[k].append(sum(x[1] == k for x in own))
            score(1)
            starts, ends, ps = more
            at = np.flatnonzero(seen)
            first = lambda values: [values.tolist()] + [None] * (len(bases) - 1) if bases else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array([hashlib.sha256(x.encode()).hexdigest() for x in bases], pa.string()),
                 pa.array(bases, pa.string()),
                 pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())),
                 pa.array(ps, pa.list_(pa.float64())),
                 pa.array(first(at), pa.list_(pa.int32())), pa.array(first(seen[at]), pa.list_(pa.int64()))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "start", "end", "p", "bin", "n"])

    return _rows(docs).select("doc_id", "text").mapInArrow(run, _SCANNED)


def scan_secrets(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of each row."""
    windows = cut_lineage(training_windows(docs), "secret-windows")
    net = fitted(windows, sample)
    least = 1.0
    if net is not None:
        net = fitted_to_all(docs, net)
        found = finding_counts(windows, net)
        least = N.least_score(found) / 2            # the threshold is no lower
    rows = cut_lineage(scanned(docs, net, least), "secret-scores")
    if net is not None:
        clean = _counted(rows.where("bin IS NOT NULL").select(F.inline(F.arrays_zip("bin", "n"))))
        least = N.settled(net, found, clean)["least"]

    def run(batches):
        for batch in batches:
            spans = []
            for base, start, end, p in zip(*[batch.column(c).to_pylist() for c in ("base", "start", "end", "p")]):
                own = [x.split(":") for x in base.split(",")] if base else []
                own = [(int(a), KINDS.index(kind), int(b)) for kind, a, b in own]
                spans.append(joined(sorted(own + [(a, 3, b) for a, b, x in zip(start, end, p) if x >= least])))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")],
                 pa.array(spans, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return rows.drop("bin", "n").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def op5_secret_scans(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(T.documents(spark, sf_dir))
