"""A small character convolutional network in numpy.

Input: a candidate's characters, the first and last of a long one, with some
before and after it. One convolution over characters (as embedding tables, one
for each offset of the kernel), rectified, the maximum over each of the three
parts, and one logistic unit. A convolution of one-hot characters is a sum of
table rows; for scoring, the tables of two neighbouring offsets are one table
of character pairs.
"""

from __future__ import annotations

import numpy as np

LEFT, INSIDE, RIGHT = 24, 28, 8
WIDTH = LEFT + INSIDE + RIGHT
#: Of a candidate longer than INSIDE, so many of its last characters are shown.
TAIL = 8
PARTS = [(0, LEFT), (LEFT, LEFT + INSIDE), (LEFT + INSIDE, WIDTH)]
CHARS = 98          # 0 nothing, 1..95 printable ASCII, 96 white space, 97 other
KERNEL, FILTERS = 4, 16
#: Characters of the kernel before and after its place.
BEFORE, AFTER = 1, 2
#: Characters of a text that are encoded at once.
AT_ONCE = 1 << 20

_CODE = np.full(129, 97, np.uint8)
_CODE[33:127] = np.arange(2, 96)
_CODE[[32, 9, 10, 11, 12, 13]] = 96
_CODE_BYTES = _CODE.tobytes().ljust(256, b"\x61")
#: By the length of a candidate, which places of INSIDE show a character.
_SHOWN = (np.arange(INSIDE) < np.arange(INSIDE + 1)[:, None]).astype(np.uint8)


def text_codes(text: str) -> np.ndarray:
    """The code of every character."""
    out = np.empty(len(text), np.uint8)
    for a in range(0, len(text), AT_ONCE):
        part = text[a:a + AT_ONCE]
        if part.isascii():
            points = part.encode("ascii")
        else:
            points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
            points = np.minimum(points, 128).astype(np.uint8).tobytes()
        out[a:a + AT_ONCE] = np.frombuffer(points.translate(_CODE_BYTES), np.uint8)
    return out


def windows(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """(candidates, WIDTH) codes around text[start:end]; 0 where there is no character."""
    padded = np.zeros(LEFT + len(codes) + WIDTH, np.uint8)
    padded[LEFT:LEFT + len(codes)] = codes

    def runs(at, n):
        # a run is copied as one item of n bytes, not byte by byte
        return np.ndarray(len(padded) - n + 1, f"V{n}", padded, 0, (1,))[at].view(np.uint8).reshape(-1, n)

    out = runs(start, WIDTH)
    size = end - start
    shown = out[:, LEFT:LEFT + INSIDE]
    shown *= _SHOWN[np.minimum(size, INSIDE)]
    long = np.flatnonzero(size > INSIDE)
    if len(long):
        shown[long, INSIDE - TAIL:] = runs(end[long] + LEFT - TAIL, TAIL)
    out[:, LEFT + INSIDE:] = runs(end + LEFT, RIGHT)
    return out


def from_bytes(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.uint8).reshape(-1, WIDTH)


def _logits(net: dict, out: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(places of the maxima by part, pooled, logits) of convolved windows."""
    where = [out[:, a:b].argmax(axis=1) + a for a, b in PARTS]
    rows, filters = np.arange(len(out))[:, None], np.arange(FILTERS)
    pooled = np.concatenate([np.maximum(out[rows, w, filters], 0) for w in where], axis=1)
    return where, pooled, pooled @ net["weights"] + net["shift"]


def _forward(net: dict, x: np.ndarray):
    padded = np.pad(x, ((0, 0), (BEFORE, AFTER)))
    out = np.zeros((len(x), WIDTH, FILTERS), np.float32) + net["bias"]
    for k in range(KERNEL):
        out += net["tables"][k][padded[:, k:k + WIDTH]]
    return padded, *_logits(net, out)


def pair_tables(net: dict) -> list[np.ndarray]:
    """(pairs of characters, FILTERS) tables of the kernel's first and last two offsets; the first with the bias."""
    t = net["tables"]
    pairs = [(t[k][:, None, :] + t[k + 1][None, :, :]).reshape(-1, FILTERS) for k in (0, 2)]
    return [pairs[0] + net["bias"], pairs[1]]


def scores(net: dict, x: np.ndarray, pairs: list[np.ndarray] | None = None, at_once: int = 256) -> np.ndarray:
    """Calibrated probabilities.

    Places lie before candidates in memory, so a part's maximum runs over whole blocks.
    """
    first, last = pairs or pair_tables(net)
    z = np.empty(len(x))
    held = [np.empty((max(b - a for a, b in PARTS), at_once, FILTERS), first.dtype) for _ in range(2)]
    for k in range(0, len(x), at_once):
        n = min(at_once, len(x) - k)
        padded = np.zeros((WIDTH + BEFORE + AFTER, n), np.int32)
        padded[BEFORE:BEFORE + WIDTH] = x[k:k + at_once].T
        pair = padded[:-1] * CHARS + padded[1:]
        pooled = []
        for a, b in PARTS:
            out, more = [m[:b - a] if n == at_once else np.empty((b - a, n, FILTERS), m.dtype) for m in held]
            first.take(pair[a:b], axis=0, out=out, mode="clip")
            out += last.take(pair[a + 2:b + 2], axis=0, out=more, mode="clip")
            pooled.append(out.max(axis=0))
        z[k:k + at_once] = np.maximum(np.concatenate(pooled, axis=1), 0) @ net["weights"] + net["shift"]
    return 1 / (1 + np.exp(-np.clip(net["slope"] * z + net["offset"], -60, 60)))


#: The learned arrays, in the order of a gradient's places.
LEARNED = ["tables", "bias", "weights", "shift"]
SHAPES = [(KERNEL, CHARS, FILTERS), (FILTERS,), (len(PARTS) * FILTERS,), ()]
PLACES = sum(int(np.prod(s)) for s in SHAPES)
#: Raw scores are counted in bins of 1 / FINE from -SPAN to SPAN.
FINE, SPAN = 32, 40
BINS = 2 * SPAN * FINE


def bins(z: np.ndarray) -> np.ndarray:
    """The bin of each raw score; the outer bins take what lies beyond."""
    return np.clip(np.floor((z + SPAN) * FINE), 0, BINS - 1).astype(np.int64)


def low_edge(bin: int) -> float:
    return bin / FINE - SPAN


def hidden(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The windows with either side of the context hidden half of the time."""
    seen = x.copy()
    for a, b in (PARTS[0], PARTS[2]):          # the candidate must count by itself too
        seen[rng.random(len(seen)) < 0.5, a:b] = 0
    return seen


def _alike(x: np.ndarray) -> np.ndarray:
    """The windows in an order that puts those with the same empty places together."""
    inside = np.count_nonzero(x[:, LEFT:LEFT + INSIDE], axis=1)
    return np.argsort(inside + 64 * (x[:, LEFT - 1] == 0) + 128 * (x[:, LEFT + INSIDE] == 0), kind="stable")


def _telling_places(padded: np.ndarray) -> list[np.ndarray]:
    """By part, the places at which the kernel sees a character in some column, and the last of the others.

    All the others give the same value, so the maxima are those over all places.
    """
    seen = np.r_[0, np.cumsum(padded.any(axis=1))]
    empty = seen[KERNEL:] == seen[:-KERNEL]
    out = []
    for a, b in PARTS:
        keep = ~empty[a:b]
        none = np.flatnonzero(~keep)
        keep[none[-1:]] = True
        out.append(np.flatnonzero(keep) + a)
    return out


def gradient(net: dict, x: np.ndarray, label: bool, most: float = np.inf,
             pairs: list[np.ndarray] | None = None, at_once: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(sum of the log loss's gradient over windows of one label, by PLACES; raw scores).

    Windows with a raw score above ``most`` add nothing.
    """
    first, last = pairs or pair_tables(net)
    total = [np.zeros(s) for s in SHAPES]
    zs = np.empty(len(x), np.result_type(net["weights"], np.float32))
    order = _alike(x)
    first, last = [t.astype(np.float32, copy=False) for t in (first, last)]
    seen = np.ascontiguousarray(x[order].T)
    # the same memory for each block: fresh memory costs more than the sums
    held = [np.empty((max(b - a for a, b in PARTS), at_once, FILTERS), np.float32) for _ in range(2)]
    rows = np.repeat(np.arange(at_once), len(PARTS) * FILTERS)
    filters = np.tile(np.arange(FILTERS), at_once * len(PARTS))
    for k in range(0, len(x), at_once):
        block = order[k:k + at_once]
        padded = np.zeros((WIDTH + BEFORE + AFTER, len(block)), np.int32)
        padded[BEFORE:BEFORE + WIDTH] = seen[:, k:k + at_once]
        pair = padded[:-1] * CHARS + padded[1:]
        tops, where = [], []
        for (a, _), places in zip(PARTS, _telling_places(padded)):
            out, more = [m[:len(places), :len(block)] if len(block) == at_once
                         else np.empty((len(places), len(block), FILTERS), np.float32) for m in held]
            first.take(pair[places], axis=0, out=out, mode="clip")
            out += last.take(pair[places + 2], axis=0, out=more, mode="clip")
            # positive floats are in order as integers, so one maximum finds the place too,
            # which stands in the lowest five bits
            bits = out.view(np.int32)
            bits &= ~31
            bits |= (places - a).astype(np.int32)[:, None, None]
            top = bits.max(axis=0)
            where.append((top & 31) + a)
            tops.append((top & ~31).view(np.float32))
        pooled, at = np.maximum(np.concatenate(tops, axis=1), 0), np.concatenate(where, axis=1)
        z = pooled @ net["weights"] + net["shift"]
        zs[block] = z
        d = 1 / (1 + np.exp(-np.clip(z.astype(float), -60, 60))) - float(label)
        d[z > most] = 0
        back = (d[:, None] * net["weights"] * (pooled > 0)).ravel()
        total[1] += back.reshape(-1, len(PARTS), FILTERS).sum(axis=(0, 1))
        total[2] += d @ pooled
        total[3] += d.sum()
        live = np.flatnonzero(back)
        filter, back = filters[live], back[live]
        place = at.ravel()[live] * len(z) + rows[live]
        flat = padded.ravel().astype(np.int64) * FILTERS
        for k in range(KERNEL):
            total[0][k] += np.bincount(flat[place + k * len(z)] + filter, back, CHARS * FILTERS).reshape(CHARS, FILTERS)
    return np.concatenate([t.ravel() for t in total]), zs


class Adam:
    """Steps of a net by gradients over PLACES."""

    def __init__(self, rate: float = 0.01):
        self.rate, self.step = rate, 0
        self.first, self.second = np.zeros(PLACES), np.zeros(PLACES)

    def moved(self, net: dict, g: np.ndarray) -> dict:
        self.step += 1
        self.first = 0.9 * self.first + 0.1 * g
        self.second = 0.999 * self.second + 0.001 * g ** 2
        by = self.rate * (self.first / (1 - 0.9 ** self.step)) / (
            np.sqrt(self.second / (1 - 0.999 ** self.step)) + 1e-8)
        out, a = dict(net), 0
        for name, shape in zip(LEARNED, SHAPES):
            n = int(np.prod(shape))
            out[name] = (net[name] - by[a:a + n].reshape(shape)).astype(np.float32)
            a += n
        return out


def train(x: np.ndarray, y: np.ndarray, batch: int = 128, rate: float = 0.01, steps: int = 40,
          min_recall: float = 0.99, seed: int = 17) -> dict:
    """Fit on four fifths of the findings, both labels weighing the same, either
    side of the context hidden half of the time; calibrate and set the threshold
    on the rest, context shown. After half of the steps the highest twentieth of
    the clean candidates is left out: findings that no label marks would teach
    the opposite.

    The threshold keeps ``min_recall`` of the held-out true findings, with room:
    it lies halfway from the largest that does down to the clean candidates,
    but for their highest twentieth, among which are the findings that no label
    marks. A lower threshold only keeps more findings. Findings too few to hold out some of both labels are used for
    both.
    """
    rng = np.random.default_rng(seed)
    net = {"tables": rng.normal(0, 0.1, (KERNEL, CHARS, FILTERS)).astype(np.float32),
           "bias": np.zeros(FILTERS, np.float32),
           "weights": rng.normal(0, 0.1, len(PARTS) * FILTERS).astype(np.float32),
           "shift": np.float32(0), "slope": 1.0, "offset": 0.0}
    first = {k: np.zeros_like(net[k]) for k in LEARNED}
    second = {k: np.zeros_like(net[k]) for k in LEARNED}
    order = rng.permutation(len(x))
    fit, held = order[len(x) // 5:], order[:len(x) // 5]
    if len(set(y[held].tolist())) < 2 or len(set(y[fit].tolist())) < 2:
        fit = held = order
    pools = [fit[y[fit] > 0.5], fit[y[fit] <= 0.5]]
    steps = max(steps, 4 * len(fit) // batch)
    for step in range(1, steps + 1):
        if step == steps // 2 and len(pools[1]) > 20:
            p = scores(net, x[pools[1]])
            pools[1] = pools[1][p <= np.quantile(p, 0.95)]
        now = np.concatenate([rng.choice(pool, batch // 2) for pool in pools])
        seen = hidden(x[now], rng)
        padded, where, pooled, z = _forward(net, seen)
        d = ((1 / (1 + np.exp(-np.clip(z, -60, 60))) - y[now]) / len(now)).astype(np.float32)
        grad = {"weights": pooled.T @ d, "shift": d.sum(), "bias": np.zeros_like(net["bias"]),
                "tables": np.zeros_like(net["tables"])}
        back = d[:, None] * net["weights"] * (pooled > 0)
        rows, filters = np.arange(len(now))[:, None], np.arange(FILTERS)
        for p, w in enumerate(where):
            g = back[:, p * FILTERS:(p + 1) * FILTERS]
            grad["bias"] += g.sum(axis=0)
            for k in range(KERNEL):
                np.add.at(grad["tables"][k], (padded[rows, w + k], filters), g)
        for k in LEARNED:
            first[k] = 0.9 * first[k] + 0.1 * grad[k]
            second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
            net[k] = net[k] - rate * (first[k] / (1 - 0.9 ** step)) / (
                np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    z = np.concatenate([_forward(net, x[held[k:k + 512]])[-1] for k in range(0, len(held), 512)])
    net["slope"], net["offset"] = _calibrated(z, y[held])
    p, true = scores(net, x[held]), y[held] > 0.5
    kept = np.sort(p[true])
    low = kept[int(np.floor((1 - min_recall) * len(kept)))]
    clean = min(low, float(np.quantile(p[~true], 0.95)))
    net["threshold"] = float((low + clean) / 2)
    return net


def settled(net: dict, found: np.ndarray, clean: np.ndarray, min_recall: float = 0.99) -> dict:
    """The net calibrated, and its threshold, by the counts of raw scores (by BINS)
    of all findings and of all clean candidates; see ``train``."""
    z = (np.arange(BINS) + 0.5) / FINE - SPAN
    both = found.sum() + clean.sum()             # both labels weigh the same
    weight = np.r_[found / max(found.sum(), 1), clean / max(clean.sum(), 1)] * both / 2
    slope, offset = _calibrated(np.r_[z, z], np.repeat([1.0, 0.0], BINS), weight)
    out = dict(net, slope=slope, offset=offset)
    out["least"] = (least_score(found, min_recall) + min(
        least_score(found, min_recall), raw_probability(low_edge(quantile_bin(clean, 0.95))))) / 2
    raw = np.log(out["least"] / (1 - out["least"]))
    out["threshold"] = float(1 / (1 + np.exp(-np.clip(slope * raw + offset, -60, 60))))
    return out


def raw_probability(z):
    return 1 / (1 + np.exp(-np.clip(z, -60.0, 60.0)))


def quantile_bin(counts: np.ndarray, share: float) -> int:
    """The bin in which the row at ``share`` of all, in ascending order, lies."""
    return int(np.searchsorted(np.cumsum(counts), int(np.floor(share * counts.sum())), "right").clip(0, BINS - 1))


def least_score(found: np.ndarray, min_recall: float = 0.99) -> float:
    """The largest bin edge that ``min_recall`` of the counted findings reach, uncalibrated."""
    return float(raw_probability(low_edge(quantile_bin(found, 1 - min_recall))))


def _calibrated(z: np.ndarray, y: np.ndarray, weight: np.ndarray | float = 1.0) -> tuple[float, float]:
    """Slope and offset of a logistic fit of the outcomes on the raw scores."""
    # counts smoothed towards even odds, so separable scores stay finite
    n, true = np.sum(weight * np.ones(len(y))), np.sum(weight * y)
    t = np.where(y > 0.5, (true + 1) / (true + 2), 1 / (n - true + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -60, 60)))
        w, r = weight * (p * (1 - p) + 1e-6), weight * (p - t)
        h = np.array([[np.sum(w * z * z), np.sum(w * z)], [np.sum(w * z), np.sum(w)]]) + 1e-6 * np.eye(2)
        move = np.linalg.solve(h, np.array([np.sum(r * z), np.sum(r)]))
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
    return float(max(a, 1e-3)), float(b)
