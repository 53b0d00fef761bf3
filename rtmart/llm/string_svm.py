"""A subsequence string kernel on words, Nyström features and a linear support vector machine.

The kernel of two words adds up, over every three characters that both hold in
the same order, DECAY to the power of the characters that the occurrences
span, within REACH characters: characters put between those of a word lower
the value but do not end it, and marks take up room but are no characters of
their own. Values are scaled by each word's kernel with itself, taken as if no
three of its characters repeated, and raised to SHARPEN, which keeps the
kernel positive. The kernel of a sentence and a landmark word
adds up its words.

Landmark columns times the inverse root of the landmarks' own kernel matrix
are Nyström features; the machine is linear in them, so all its weights come
down to one number for each landmark, and a sentence's margin to the sum of
one number for each of its words.
"""

from __future__ import annotations

import numpy as np

DECAY = 0.8
REACH = 8
SHARPEN = 3
#: Characters of a unit; longer ones are cut into overlapping windows.
LONGEST = 24
#: (first gap, second gap) of the triples within REACH.
GAPS = [(a, b) for a in range(1, REACH) for b in range(1, REACH - a + 1)]
_SYMBOLS = 64


def symbols(text: str) -> np.ndarray:
    """Letters and digits as 1..36, characters beyond ASCII as 37..62 by remainder, marks as 0."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int32)
    out = 37 + points % 26
    out[points < 128] = 0
    letters, digits = (points >= 97) & (points <= 122), (points >= 48) & (points <= 57)
    out[letters] = points[letters] - 96
    out[digits] = points[digits] - 21
    return out


def _laid_out(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols with room between the units, each one's unit, units' lengths)."""
    pad = "\0" * REACH
    lengths = np.fromiter(map(len, units), np.int64, len(units))
    return symbols(pad.join(units) + pad), np.repeat(np.arange(len(units)), lengths + REACH), lengths


def _codes(chars: np.ndarray):
    """(code of the triple that starts at each place, weight) of each gap pair; marks have code parts 0."""
    n = len(chars) - REACH
    for a, b in GAPS:
        yield (chars[:n] * _SYMBOLS + chars[a:n + a]) * _SYMBOLS + chars[a + b:n + a + b], DECAY ** (a + b + 1)


def _is_triple(code: np.ndarray) -> np.ndarray:
    return (code % _SYMBOLS > 0) & (code // _SYMBOLS % _SYMBOLS > 0) & (code >= _SYMBOLS ** 2)


def own_kernel(units: list[str]) -> np.ndarray:
    """Each unit's kernel with itself if no triple repeats."""
    chars, owner, lengths = _laid_out(units)
    total = np.zeros(len(units))
    for a, b in GAPS:
        total += np.maximum(lengths - a - b, 0) * DECAY ** (2 * (a + b + 1))
    marked = np.flatnonzero(np.bincount(owner[chars == 0], minlength=len(units)) > REACH)
    if len(marked):                          # triples with a mark do not count
        chars, owner, _ = _laid_out([units[i] for i in marked])
        total[marked] = 0
        for code, w in _codes(chars):
            total[marked] += w * w * np.bincount(owner[:len(code)][_is_triple(code)], minlength=len(marked))
    return total


def landmark_table(landmarks: list[str]) -> dict:
    """What words are compared with: for each triple code, the landmarks that have it and their weights."""
    chars, owner, _ = _laid_out(landmarks)
    sums: dict[tuple[int, int], float] = {}
    for code, w in _codes(chars):
        for k in np.flatnonzero(_is_triple(code)).tolist():
            pair = (int(code[k]), int(owner[k]))
            sums[pair] = sums.get(pair, 0.0) + w
    own = np.sqrt(own_kernel(landmarks))
    pairs = sorted(sums)
    codes, first, number = np.unique([c for c, _ in pairs], return_index=True, return_counts=True)
    row = np.full(_SYMBOLS ** 3, -1, np.int32)
    row[codes] = np.arange(len(codes))
    return {"landmarks": list(landmarks), "row": row, "first": first, "number": number,
            "landmark": np.array([m for _, m in pairs]),
            "weight": np.array([sums[p] / own[p[1]] for p in pairs])}


def kernel(units: list[str], table: dict) -> np.ndarray:
    """(units, landmarks) sharpened kernel values; 0 for units of fewer than three characters."""
    marks = len(table["landmarks"])
    if not units:
        return np.zeros((0, marks))
    chars, owner, _ = _laid_out(units)
    who, rows, weights = [], [], []
    for code, w in _codes(chars):
        row = table["row"][code]
        hit = np.flatnonzero(row >= 0)
        who.append(owner[hit])
        rows.append(row[hit])
        weights.append(np.full(len(hit), w))
    who, rows, weights = map(np.concatenate, (who, rows, weights))
    number = table["number"][rows]           # one entry for each landmark that has the triple
    entry = np.arange(number.sum()) + np.repeat(table["first"][rows] - (np.cumsum(number) - number), number)
    out = np.bincount(np.repeat(who, number) * marks + table["landmark"][entry],
                      np.repeat(weights, number) * table["weight"][entry], len(units) * marks)
    own = own_kernel(units)
    return (out.reshape(-1, marks) / np.sqrt(np.where(own > 0, own, 1))[:, None]) ** SHARPEN


def inverse_root(table: dict, ridge: float = 1e-6) -> np.ndarray:
    """The inverse square root of the landmarks' kernel matrix; its null space is left out."""
    k = kernel(table["landmarks"], table)
    values, vectors = np.linalg.eigh((k + k.T) / 2)
    keep = values > ridge * max(values.max(), ridge)
    return (vectors[:, keep] / np.sqrt(values[keep])) @ vectors[:, keep].T


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = 60,
            seed: int = 11) -> tuple[np.ndarray, float]:
    """Weights and shift of a linear machine with squared hinge loss, by dual coordinate descent.

    ``y`` is +1 or -1.
    """
    rng = np.random.default_rng(seed)
    x = np.hstack([x, np.ones((len(x), 1))])
    upper = 1 / (2 * cost)
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    norm = np.einsum("ij,ij->i", x, x) + upper
    for _ in range(rounds):
        largest = 0.0
        for i in rng.permutation(len(x)):
            gradient = y[i] * (x[i] @ w) - 1 + upper * alpha[i]
            step = max(alpha[i] - gradient / norm[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w += step * y[i] * x[i]
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return w[:-1], float(w[-1])


def word_weights(table: dict, root: np.ndarray, w: np.ndarray) -> np.ndarray:
    """One number for each landmark: a word's share of the margin is its kernel times these."""
    return root @ w


def probability(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit of labels (0, 1) on margins; the slope is not negative."""
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    centre, spread = margin.mean(), max(margin.std(), 1e-9)
    z, (a, b) = (margin - centre) / spread, (1.0, 0.0)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -50, 50)))
        r, v = p - target, p * (1 - p) + 1e-9
        h = np.array([[(v * z * z).sum(), (v * z).sum()], [(v * z).sum(), v.sum()]]) + 1e-9 * np.eye(2)
        move = np.linalg.solve(h, np.array([(r * z).sum(), r.sum()]))
        a, b = max(a - float(np.clip(move[0], -1, 1)), 0.0), b - float(np.clip(move[1], -1, 1))
        if np.abs(move).max() < 1e-8:
            break
    return a / spread, b - a * centre / spread
