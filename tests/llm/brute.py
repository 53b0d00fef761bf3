"""Plain-Python versions of the operators, for small fixtures."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import xxhash

SPACE = " \t\n\x0b\f\r"
WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


def quality(docs, max_docs=20, min_left=30):
    """{(doc_id, text): (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)}"""
    def norm(line):
        return " ".join(x for x in re.split("[\x20\x09-\x0d]+", line) if x).lower()

    holders = defaultdict(set)
    distinct = {(d["doc_id"], d["source"], d["text"]) for d in docs}
    for doc_id, source, text in distinct:
        for line in (text or "").split("\n"):
            if words(line):
                holders[source, norm(line)].add((doc_id is not None, doc_id or 0, text))
    out = {}
    for doc_id, source, text in distinct:
        t = text or ""
        w = words(t)
        lines = [x for x in t.split("\n") if words(x)]
        grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        n = Counter(grams)
        covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(5)}
        removed = 0
        for line in lines:
            who = holders[source, norm(line)]
            if len(who) > max_docs and min(who)[:2] != (doc_id is not None, doc_id or 0):
                removed += len(words(line))
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        out[doc_id, text] = (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
            len(covered), failed, not failed and 100 * (len(w) - removed) >= min_left * len(w))
    return out


def fingerprint(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, linked):
    """The least index reachable from each of n items; linked(i, j)."""
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(n)]


LICENSE_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def license_words(text):
    return LICENSE_WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base_places(text):
    """[(start, label)] of the base phrases."""
    w = license_words(text)
    found = []
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"),
                          ("all rights reserved", "reserved")):
        p = phrase.split()
        found += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return found


def rule_spans(text, rules):
    """{(tier, label, start, end)}: rule matches in words, suppressed ones left out."""
    w = license_words(text)
    norm = " " + " ".join(w) + " "
    spans = []
    for i, (tier, label, keyword, pattern) in enumerate(rules):
        if " " + keyword not in norm:
            continue
        for m in re.finditer(f"(?<= ){pattern}(?= )", norm):
            start = norm[:m.start()].count(" ") - 1
            spans.append((tier, label, start, start + m.group().count(" ") + 1))
    return {a for a in spans if not any(
        (b[0] < a[0] or (b[0] == a[0] and b[3] - b[2] > a[3] - a[2]))
        and b[2] <= a[2] and b[3] >= a[3] for b in spans)}


SECRET_KINDS = ["assign", "access", "hex"]


def secret_base(text):
    spans = []
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(pattern, text, re.I | re.A):
        if len(m.group(2)) >= 6:
            spans.append((m.start(), 0, m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if m.end() - m.start() >= 20:
            spans.append((m.start(), 1, m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if m.end() - m.start() >= 24:
            spans.append((m.start(), 2, m.end()))
    return sorted(spans)


def segmentations(word, probability):
    """Summed probability of all ways to cut the word into pieces, start by start."""
    sums = [1.0] + [0.0] * len(word)
    for start in range(len(word)):
        for end in range(start + 1, len(word) + 1):
            sums[end] += sums[start] * probability.get(word[start:end], 0.0)
    return sums[-1]
