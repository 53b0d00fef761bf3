"""Toxicity, filter audit and vector codes against brute force."""

import hashlib
import itertools
import random
import zlib
from collections import Counter
from fractions import Fraction
from math import factorial

import duckdb
import numpy as np
import pytest

from rtmart.llm import audit, string_svm as S, toxicity, vectors
from rtmart.llm.oracle import ORACLES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, mask int"
LABELS = "doc_id long, quality int, toxic int"
VECTORS = "vec_id long, embedding array<float>, label int, codes string, error string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0, "p", 1) for i, t, lang in rows], DOCS)


# -- filter audit ------------------------------------------------------------

def words_of(text):
    out = "".join(" " if c in " \t\n\x0b\f\r" else c for c in text)
    return [w for w in out.split(" ") if w]


def failed(text):
    w = words_of(text)
    return {k for k, bad in zip("ABCD", (
        len(w) < 100, 100 * len(set(w)) < 80 * len(w),
        100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), bool(set(text) & set("#$%&*|")))) if bad}


def brute_audit(rows, labels):
    marks = {}
    for i, q, t in labels:
        old = marks.get(i, (0, 0))
        marks[i] = (max(old[0], int(q == 1)), max(old[1], int(t == 1)))
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    docs = []
    for i, t, lang in rows:
        bad = failed(t or "") | ({"E"} if i is not None and i > least[t or ""] else set())
        docs.append((lang or "", bad, *marks.get(i, (0, 0))))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        sums = Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                sums[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in d[1] for d in mine) - len(gone), sum(d[1] == {f} for d in mine),
                    sum(d[2] for d in gone), sum(d[3] for d in gone), f]
        for key, row in out.items():
            if key[0] == part and isinstance(row[-1], str):
                row[-1] = sums[row[-1]]
    return out


COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit_rows():
    rng = random.Random(3)
    long = " ".join(f"word{k}" for k in range(120))
    texts = [None, "", "short", long, long + " #", "A" * 50, " ".join(["same"] * 150), long.upper(),
             "é è " * 60, "x\x0by\fz\n" * 70, "a\x00b | c", "Ünï " * 3000 + "B"]
    rows = [(k, rng.choice(texts), rng.choice(["en", "fr", None, ""])) for k in range(150)]
    rows += [(7, long, "en"), (7, long, "fr"), (7, long, "en"), (None, long, "en"), (None, long, None)]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 150, 2)] + [
        (4, 1, 0), (4, 0, 1), (None, 1, 1)]
    return rows, labels


def test_audit_equals_brute_force(spark):
    rows, labels = audit_rows()
    got = audit.audit(docs_of(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    want = brute_audit(rows, labels)
    assert len(got) == len(want) == 3 * 600
    for r in got:
        assert [r[c] for c in COLUMNS] == want[r.part, r.filter_order, r.step], r


def test_audit_oracle_on_hard_rows(spark):
    """The SQL agrees with the operator beyond the given tables (its ids are not null)."""
    rows, labels = audit_rows()
    rows = [r for r in rows if r[0] is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    res = con.execute(ORACLES["op12_filter_interaction_audit"])
    names = [d[0] for d in res.description]
    want = brute_audit(rows, labels)
    found = [dict(zip(names, r)) for r in res.fetchall()]
    assert len(found) == len(want)
    for r in found:
        assert [r[c] for c in COLUMNS] == want[r["part"], r["filter_order"], r["step"]]


@pytest.mark.parametrize("players", [2, 3, 5])
def test_least_squares_solution_is_the_mean_over_orders(players):
    rng = random.Random(players)
    values = [0] + [rng.randint(0, 1000) for _ in range((1 << players) - 1)]
    solved = [sum(w * v for w, v in zip(row, values)) for row in audit.shapley_operator(players)]
    mean = [Fraction(0)] * players
    for order in itertools.permutations(range(players)):
        s = 0
        for i in order:
            mean[i] += Fraction(values[s | 1 << i] - values[s], factorial(players))
            s |= 1 << i
    assert solved == mean


def test_audit_of_an_empty_table(spark):
    labels = spark.createDataFrame([], LABELS)
    assert audit.audit(docs_of(spark, []), labels).collect() == []
    assert audit.audit(docs_of(spark, [(None, None, None)]), labels).count() == 600


# -- vector codes ------------------------------------------------------------

def brute_codes(rows):
    """The contract in Python integers."""
    kept = [(i, [int(np.floor(256 * float(x))) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = len(kept[0][1]) // 16
    cut = lambda v: [v[p * width:(p + 1) * width] for p in range(16)]
    kept = [(i, cut(v), lab) for i, v, lab in kept]
    books = [[v[p] for _, v, _ in sorted(kept, key=lambda r: r[0])[:64]] for p in range(16)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(2):
        new = []
        for p in range(16):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(near(p, v[p])[1], []).append(v[p])
            new.append([[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e
                        for k, e in enumerate(books[p])])
        books = new
    out, by_label = {}, Counter()
    for i, v, lab in kept:
        found = [near(p, v[p]) for p in range(16)]
        out[i] = ["".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), lab]
        by_label[lab] += out[i][1]
    text = ",".join(str(x) for p in books for e in p for x in e)
    return {i: (c, e, by_label[lab], hashlib.sha256(text.encode()).hexdigest()) for i, (c, e, lab) in out.items()}


def vectors_written(spark, tmp_path, rows):
    spark.createDataFrame([(i, v, lab, "c", "e") for i, v, lab in rows], VECTORS).write.parquet(
        f"{tmp_path}/embeddings.parquet")
    return {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256)
            for r in vectors.op13_vector_code_compression(spark, str(tmp_path)).collect()}


@pytest.mark.parametrize("n", [3, 200])
def test_codes_equal_brute_force(spark, tmp_path, n):
    rng = np.random.default_rng(n)
    rows = [(int(i), (rng.normal(size=32) * rng.choice([0.01, 1, 1000])).astype("float32").tolist(),
             None if k % 7 == 0 else k % 3) for k, i in enumerate(rng.permutation(n))]
    rows += [(9000, rows[0][1], 1), (9001, [0.0] * 32, None), (-5, [-0.001] * 32, 2)]        # copies, ties
    bad = [(9002, None, 1), (9003, [None] + [1.0] * 31, 1), (9004, [float("nan")] + [1.0] * 31, 1),
           (9005, [float("-inf")] + [1.0] * 31, None)]
    assert vectors_written(spark, tmp_path, rows + bad) == brute_codes(rows)


def test_no_vectors_and_odd_ones(spark, tmp_path):
    assert vectors_written(spark, tmp_path / "a", [(1, None, 1), (2, [None], 1)]) == {}
    out = vectors_written(spark, tmp_path / "b", [(1, [], 1), (None, [1.0], 1), (3, [3e38, -3e38, 1.0], None)])
    assert set(out) == {1, None, 3} and all(e == 0 for _, e, _, _ in out.values())


def test_products_are_exact_up_to_the_bound():
    rng = np.random.default_rng(5)
    for width in (1, 4, 64):
        most = vectors.largest(16 * width)
        for top in (2, 1000, most):
            a, b = (rng.integers(-top, top + 1, (2, 7, width)) for _ in range(2))
            a[0, 0], b[0, 0] = top, -top
            got = vectors.exact_dot(a, b.transpose(0, 2, 1))
            for p, i, j in itertools.product(range(2), range(7), range(7)):
                assert got[p, i, j] == sum(int(x) * int(y) for x, y in zip(a[p, i], b[p, j]))
            parts = a[:1].repeat(16, axis=0)
            _, gap = vectors.nearest(parts, b[:1].repeat(16, axis=0))
            assert (gap >= 0).all() and gap.sum(axis=0).min() >= 0
    limbs = vectors.limbs(np.array([-(1 << 40) - 3, 5, (1 << 40) + 9]), 11)
    assert all(np.abs(x).max() <= 1 << 11 for x in limbs)
    assert sum(x.astype(int) << 11 * k for k, x in enumerate(limbs)).tolist() == [-(1 << 40) - 3, 5, (1 << 40) + 9]


def test_decoding_the_codes_gives_the_error(spark, sf_small):
    coded, books = vectors.compressed(spark.read.parquet(f"{sf_small}/embeddings.parquet"))
    rows = {r.vec_id: r for r in coded.collect()}
    for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect():
        own = np.floor(256 * np.array(r.embedding, float)).astype(int)
        back = vectors.decoded(np.array([rows[r.vec_id].codes]), books)[0]
        assert ((own - back) ** 2).sum() == rows[r.vec_id].error


# -- toxicity ----------------------------------------------------------------

def brute_kernel(u, v):
    def features(w):
        f, own, sym = Counter(), 0.0, S.symbols(w)
        for i, j, k in itertools.combinations(range(len(w)), 3):
            if k - i <= S.REACH and sym[i] and sym[j] and sym[k]:
                f[sym[i], sym[j], sym[k]] += S.DECAY ** (k - i + 1)
                own += S.DECAY ** (2 * (k - i + 1))
        return f, own
    (f, a), (g, b) = features(u), features(v)
    return (sum(x * g[c] for c, x in f.items()) / np.sqrt(a * b)) ** S.SHARPEN if a and b else 0.0


def test_kernel_equals_brute_force():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdé.-1漢") for _ in range(rng.randint(0, 24))) for _ in range(60)]
    marks = ["abcd", "dcba", "a.b-cd", "aaaa", "éé1漢a"]
    got = S.kernel(words, S.landmark_table(marks))
    assert np.allclose(got, [[brute_kernel(u, v) for v in marks] for u in words])


def test_kernel_matrix_has_no_negative_direction():
    marks = ["moron", "morons", "trash", "brash", "crash", "xyzzy", "m.o.r.o.n"]
    table = S.landmark_table(marks)
    k = S.kernel(marks, table)
    assert np.allclose(k, k.T) and np.linalg.eigvalsh(k).min() > -1e-9
    root = S.inverse_root(table)
    features = k @ root
    assert np.allclose(features @ features.T, k, atol=1e-3)


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = np.where(x @ [1, -2, 0.5] + 0.3 + rng.normal(size=200) * 0.5 > 0, 1.0, -1.0)
    w, b = S.fit_svm(x, y, rounds=500)

    def loss(w, b):
        return (w @ w + b * b) / 2 + (np.maximum(0, 1 - y * (x @ w + b)) ** 2).sum()

    best = loss(w, b)
    for _ in range(200):
        assert loss(w + rng.normal(size=3) * 0.01, b + rng.normal() * 0.01) > best - 1e-6


INSULTS = ["blockhead", "nitwit", "dunce"]


def spoken(rng, insult=None, words=60):
    out = ["".join(rng.choice(["ra", "lo", "mi", "ten", "sha", "un"]) for _ in range(rng.randint(1, 4)))
           + rng.choice(["", "", "", "."]) for _ in range(words)]
    if insult:
        out.insert(rng.randrange(len(out)), insult)
    return " ".join(out)


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(600):
        bad = k % 4 == 0
        rows.append((k, spoken(rng, rng.choice(INSULTS) if bad else None), "en"))
        labels.append((k, 1, int(bad)))
    planted = {1000: "You utter block-head!", 1001: "n i t w i t", 1002: "so d.u.n.c.e like", 1003: "DUNCE",
               1004: spoken(rng, "blockh*ead", 4000)}
    clean = {2000: "", 2001: None, 2002: spoken(rng, None, 4000), 2003: "a b c d e f", 2004: "漢" * 500}
    more = [(i, t, None) for i, t in (planted | clean).items()] + [rows[0], (None, rows[0][1], None)]
    out = toxicity.toxicity(docs_of(spark, rows + more), spark.createDataFrame(
        labels + [(0, 1, 0), (None, 1, 1), (2, 1, None)], LABELS)).collect()
    return rows, labels, planted, clean, out


def test_held_out_documents_are_told_apart(judged):
    _, labels, _, _, out = judged
    truth = {i: t for i, _, t in labels}
    held = [r for r in out if r.doc_id in truth and r.held_out]
    assert len(held) > 50 and all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out
                                  for r in out if r.doc_id is not None)
    assert np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_gapped_and_spelled_insults_are_caught_and_clean_texts_left(judged):
    rows, _, planted, clean, out = judged
    score = {r.doc_id: r.score for r in out}
    assert len(out) == len(rows) + len(planted) + len(clean) + 2
    assert {i for i in planted if score[i] < 0.5} == set()
    assert {i for i in clean if score[i] >= 0.5} == set()
    assert score[2000] == score[2001]
    assert len({r.score for r in out if r.doc_id in (0, None)}) == 1      # copies score alike


def test_labels_of_held_out_documents_do_not_count(spark, judged):
    rows, labels, _, _, out = judged
    held = {r.doc_id for r in out if r.held_out}
    flipped = [(i, q, 1 - t if i in held else t) for i, q, t in labels]
    again = toxicity.toxicity(docs_of(spark, rows), spark.createDataFrame(flipped, LABELS)).collect()
    plain = toxicity.toxicity(docs_of(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert sorted(map(str, again)) == sorted(map(str, plain))


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 1, 0), (2, 1, 0)], [(None, 1, 1)]])
def test_without_both_labels_nothing_is_toxic(spark, labels):
    docs = docs_of(spark, [(1, "a nitwit", "en"), (2, None, None), (None, "x", None)])
    out = toxicity.toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert [r.score for r in out] == [0.0] * 3


def test_no_documents_no_scores(spark):
    assert toxicity.toxicity(docs_of(spark, []), spark.createDataFrame([(1, 1, 1)], LABELS)).collect() == []


def test_texts_are_scored_whole(monkeypatch):
    """Bounded chunks, windows and sentences change nothing about where an insult is found."""
    marks = ["nitwit"]
    table = S.landmark_table(marks)
    model = {"table": table, "by_landmark": np.array([2.0]), "shift": -1.0}
    texts = ["ra lo " * 30000 + "nitwit", "x" * 500 + "nitwit" + "x" * 500, "n i t w i t", "ra " * 31 + "nitwit lo"]
    whole = toxicity.document_margins(texts, model)
    assert whole[0] > 0.9 and whole[1] > -0.9 and whole[2] > 0.9 and whole[3] > 0.9
    monkeypatch.setattr(toxicity, "CHARS_AT_ONCE", 64)
    monkeypatch.setattr(toxicity, "UNITS_AT_ONCE", 3)
    assert np.allclose(toxicity.document_margins(texts, model), whole)
    # the same margins one by one
    assert np.allclose([toxicity.document_margins([t], model)[0] for t in texts], whole)
