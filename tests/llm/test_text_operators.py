"""Quality rules, line dedup, SimHash, packing, mixing: brute force and edge cases."""

import hashlib
import itertools
import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute as B  # noqa: E402

from rtmart.llm import graph, lines, mixing, packing, quality, simhash  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], schema)


def clashing(spark, rows):
    """Extra columns that have the names of working columns."""
    docs = frame(spark, rows)
    for c in ("key", "row", "src", "block", "words", "n", "size", "part", "removed", "line_hash",
              "shard", "slot", "n_removed", "root"):
        docs = docs.selectExpr("*", f"'x' AS {c}")
    return docs


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=1):
    rng = random.Random(seed)
    rows = [(k, prose(rng, rng.randrange(12, 90)), f"s{k % 13}") for k in range(120)]
    base = prose(rng, 120)
    rows += [(200 + k, base, f"s{k % 13}") for k in range(30)]                  # exact copies
    rows += [(300 + k, base + f" tail{k}", f"s{k % 5}") for k in range(20)]      # near copies
    footer = "Subscribe to our  NEWS letter"
    rows += [(400 + k, prose(rng, 40) + "\n" + footer, f"s{k % 13}") for k in range(26)]
    rows += [(500 + k, footer.lower() + "\n" + footer, "hot") for k in range(40)]
    rows += [(600, "a b c d e a b c d e f g h i j k", "s1"), (601, "x " * 40, "s1"),
             (602, None, "s1"), (603, "", None), (604, " \n\t\n ", "s2"), (605, "one", None),
             (606, "# $ % | < > ***", "s1"), (None, prose(rng, 30), "s1"),
             (700, prose(rng, 25), None), (700, prose(rng, 25), "s9")]
    rows += [(800, "same words here again and again for all of them to see", "s3")] * 3
    long = prose(rng, 5000, 4000)
    return rows + [(900, long, "hot"), (901, long + " end", "hot")]


EMPTY = []


# -- quality rules ---------------------------------------------------------

def test_quality_rules_equal_brute_force(spark):
    rows = corpus()
    want = B.quality([{"doc_id": i, "text": t, "source": s} for i, t, s in rows])
    got = quality.quality_rules(clashing(spark, rows), max_docs=20, min_left_percent=30).collect()
    assert len(got) == len(rows)
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(i, []).append(t)
    for r in got:
        options = [want[r.doc_id, t] for t in texts[r.doc_id]]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed, r.kept) in options, r
    depleted = [r.doc_id for r in got if not r.kept and not r.base_failed]
    assert 201 not in [r.doc_id for r in got if r.base_failed]
    assert isinstance(depleted, list)


def test_depleted_documents_go_and_the_first_stays(spark):
    rng = random.Random(3)
    notice = prose(rng, 60)
    rows = [(k, notice + "\n" + prose(rng, 10), "h") for k in range(30)]
    rows += [(100 + k, notice, f"h{k}") for k in range(30)]         # one per host: no line is frequent
    limits = {"max_docs": 20, "min_left_percent": 30}
    kept = {r.doc_id: r.kept for r in quality.quality_rules(frame(spark, rows), **limits).collect()}
    assert kept[0] and not any(kept[k] for k in range(1, 30))
    assert all(kept[100 + k] for k in range(30))
    left = quality.keep_good(clashing(spark, rows), **limits)
    assert left.columns == clashing(spark, rows).columns
    assert {r.doc_id for r in left.collect()} == {k for k, v in kept.items() if v}


def test_a_frequent_line_of_one_host_stands_in_its_first_document_only(spark):
    rng = random.Random(4)
    notice, own = "Terms of  THIS host apply", [prose(rng, 30) for _ in range(61)]
    rows = [(k, f"{own[k]}\n\n{notice}\nend {k}", "h") for k in range(60)] + [(60, own[60], "other")]
    docs = clashing(spark, rows + rows[5:6])                        # a repeated row
    want = {k: f"{own[k]}\n\nend {k}" for k in range(1, 60)} | {0: rows[0][1], 60: own[60]}
    out = quality.keep_good(docs).collect()
    assert len(out) == 62
    for r in out:
        assert r.text == want[r.doc_id] and r.n_chars == len(r.text)
    for r in quality.quality_rules(docs).collect():
        assert r.text == want[r.doc_id] and r.n_chars == len(r.text)
        assert r.removed_words == (5 if 0 < r.doc_id < 60 else 0)


def test_the_default_limits_reject_a_depleted_document(spark):
    rng = random.Random(5)
    notice = "\n".join(prose(rng, 19) for _ in range(10))             # 190 words
    rows = [(k, f"{notice}\n{prose(rng, 12)}", "h") for k in range(52)]      # 12 of 202 words are left
    rows += [(100 + k, f"{notice}\n{prose(rng, 24)}", "h") for k in range(4)]  # 24 of 214
    rows += [(200 + k, f"{notice}\n{prose(rng, 12)}", "other") for k in range(50)]
    got = {r.doc_id: r for r in quality.quality_rules(frame(spark, rows)).collect()}
    assert got[0].kept and not any(got[k].kept for k in range(1, 52))
    assert not any(got[k].base_failed for k in got)
    assert all(got[100 + k].kept and len(B.words(got[100 + k].text)) == 24 for k in range(4))
    assert all(got[200 + k].kept and got[200 + k].removed_words == 0 for k in range(50))


# -- line dedup ------------------------------------------------------------

def test_line_dedup_by_distinct_sites(spark):
    rng = random.Random(5)
    rows = []
    for sites in (8, 9, 10, 11, 30):
        for k in range(sites):
            rows.append((len(rows), prose(rng, 12) + f"\nboiler  Plate {sites}\n" + prose(rng, 9),
                         f"site{k}"))
    rows += [(1000 + k, "only here\n" * 3 + prose(rng, 5), "one site") for k in range(40)]
    rows += [(2000, None, "site1"), (2001, "", "site2"), (2002, " \n\n ", None)]
    out = {r.doc_id: r for r in lines.removed_lines(frame(spark, rows)).collect()}
    given = {i: t for i, t, _ in rows}
    for i, text, _ in rows:
        if text and "Plate" in text:
            sites = int(text.split("Plate ")[1].split("\n")[0])
            first = min(j for j, t in given.items() if t and f"Plate {sites}\n" in t)
            gone = sites >= 10 and i != first
            assert out[i].n_removed == gone
            parts = text.split("\n")
            assert out[i].text == ("\n".join([parts[0], parts[2]]) if gone else text)
        else:
            assert out[i].text == text and out[i].n_removed == 0
    again = lines.without_boilerplate(clashing(spark, rows))
    assert again.columns == clashing(spark, rows).columns
    for r in again.collect():
        assert r.text == out[r.doc_id].text
        assert r.n_chars == len(r.text or "")


def test_all_lines_of_a_copied_text_go_but_the_first_ones(spark):
    rows = [(k, "first line\nsecond line", f"s{k}") for k in range(12)] * 2
    out = lines.removed_lines(frame(spark, rows)).collect()
    assert len(out) == 24
    assert sorted((r.doc_id, r.text) for r in out) == sorted(
        (k, "first line\nsecond line" if k == 0 else "") for k in range(12) for _ in range(2))


# -- SimHash ---------------------------------------------------------------

def test_simhash_equals_brute_force(spark):
    rows = corpus(2)
    got = simhash.near_groups(clashing(spark, rows), 3, 3).collect()
    assert len(got) == len(rows)
    fps = [B.fingerprint(t) for _, t, _ in rows]
    least = B.components(len(rows), lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 3)
    groups = {}
    for k, r in enumerate(least):
        groups.setdefault(r, []).append(rows[k][0])
    want = sorted((str(rows[k][0]), fps[k], min(x for x in groups[least[k]] if x is not None))
                  if any(x is not None for x in groups[least[k]]) else (str(rows[k][0]), fps[k], None)
                  for k in range(len(rows)))
    assert sorted((str(r.doc_id), r.fp % 2 ** 64, r.component_id) for r in got) == want


def test_one_document_of_each_group_stays(spark):
    rows = corpus(2)
    docs = clashing(spark, rows)
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    fps = [B.fingerprint(t) for _, t, _ in rows]
    least = B.components(len(rows), lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 3)
    assert kept.count() == len(set(least))


def test_bit_sliced_distances():
    rng = np.random.default_rng(0)
    fps = rng.integers(0, 2 ** 64, 300, dtype=np.uint64)
    fps[50:90] = fps[0] ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64))
    planes = simhash.bit_planes(fps)
    for radius in (0, 1, 2, 3, 5, 8):
        near = simhash.within_radius(fps, planes, radius)
        bits = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, :300]
        want = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
        assert (bits.astype(bool) == want).all()


def test_every_pair_within_the_radius_shares_a_place(spark):
    rng = random.Random(7)
    base = rng.getrandbits(64)
    close = [base ^ sum(1 << b for b in rng.sample(range(64), 3)) for _ in range(60)]
    signed = [x - 2 ** 64 if x >= 2 ** 63 else x for x in [base, *close]]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    places = {}
    for r in simhash.meeting_places(nodes, 3).collect():
        places.setdefault(r.fp, set()).add(r.place)
    assert all(places[signed[0]] & places[x] for x in signed[1:])


def test_a_large_meeting_place_is_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 8)
    rng = random.Random(9)
    fps = set()
    while len(fps) < 120:        # one chain of neighbours, 2 bits apart, in the low bits
        fps.add(sum(1 << b for b in rng.sample(range(12), 4)))
    nodes = spark.createDataFrame([(x,) for x in fps], "fp long")
    roots = {r.node: r.root for r in
             graph.connected_components(simhash.near_links(nodes, 3)).collect()}
    order = sorted(fps)
    want = B.components(len(order), lambda i, j: bin(order[i] ^ order[j]).count("1") <= 3)
    for k, x in enumerate(order):
        assert roots.get(x, x) == order[want[k]]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(6, 40)] + [(70, 70), (80, 81),
                                                                                     (81, 80)]
    got = {r.node: r.root for r in graph.connected_components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 5 for k in range(5, 40)}, 80: 80, 81: 80}
    assert graph.connected_components(spark.createDataFrame(EMPTY, "u long, v long")).count() == 0


# -- packing ---------------------------------------------------------------

def padding(lengths, counts, bounds):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in zip(lengths, counts))


def test_boundaries_are_optimal():
    rng = random.Random(4)
    for _ in range(40):
        lengths = rng.sample(range(1, 40), rng.randrange(1, 9))
        counts = [rng.randrange(1, 20) for _ in lengths]
        k = rng.randrange(1, 5)
        got = packing.optimal_boundaries(lengths, counts, k)
        best = min(padding(lengths, counts, [*c, max(lengths)])
                   for size in range(k) for c in itertools.combinations(sorted(lengths)[:-1], size))
        assert len(got) <= k and padding(lengths, counts, got) == best
    assert packing.optimal_boundaries([], [], 3) == []


def test_packing_keeps_every_word_and_the_budget(spark):
    rows = corpus(6)
    out = packing.pack(clashing(spark, rows), max_len=64, buckets=4, budget=256).collect()
    got, want = {}, {}
    for i, t, _ in rows:
        w = B.words(t)
        for p in range(0, len(w), 64):
            want.setdefault((i, p // 64), []).append(" ".join(w[p:p + 64]))
    batches = {}
    for r in out:
        got.setdefault((r.doc_id, r.piece), []).append(r.text)
        batches.setdefault((r.bucket_len, r.shard, r.batch), []).append(r.slot)
        assert r.n_tokens == len(r.text.split(" ")) <= r.bucket_len
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for (length, _, _), slots in batches.items():
        assert length * len(slots) <= 256 and sorted(slots) == list(range(len(slots)))
    histogram = {r.n_tokens: r.n for r in packing.length_histogram(frame(spark, rows), 64).collect()}
    seen = {}
    for r in out:
        seen[r.n_tokens] = seen.get(r.n_tokens, 0) + 1
    assert histogram == seen


def test_the_packing_query_gives_the_texts(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    out = packing.op7_packing(spark, sf_small).collect()
    assert all(len(r.text.split(" ")) == r.n_tokens for r in out)
    got, want = {}, {}
    for r in sorted(out, key=lambda r: r.piece):
        got.setdefault(r.doc_id, []).extend(r.text.split(" "))
    for r in docs:
        if B.words(r.text):
            want[r.doc_id] = B.words(r.text)
    assert len({r.doc_id for r in docs}) == len(docs) and got == want


# -- mixing ----------------------------------------------------------------

def targets(sizes):
    """Sources in order: weights 1, 2, 3; excess reshared until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {s: 3 * sizes[s] if s in capped else share[s] for s in order}
        capped |= set(over)


def test_mixing_meets_targets(spark):
    rng = random.Random(8)
    rows = [(k, prose(rng, rng.randrange(0, 400)), f"s{k % 5}") for k in range(200)]
    rows += [(300, prose(rng, 3), "tiny"), (301, "", "none"), (302, None, None), (303, prose(rng, 50), None)]
    rows += [(304, prose(rng, 9), "tiny")] * 2 + [(None, prose(rng, 20), "s1")]
    docs = clashing(spark, rows)
    out = mixing.taken_words(docs, block=16).collect()
    assert len(out) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(B.words(t))
    want = targets(sizes)
    source = {}
    for i, t, s in rows:
        source.setdefault((i, len(B.words(t))), s)
    taken = {}
    for r in out:
        s = source[r.doc_id, r.size]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 3 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s, n in taken.items():
        assert abs(n - want[s]) <= 1
    again = sorted(map(str, mixing.taken_words(docs, block=16).collect()))
    assert again == sorted(map(str, out))


def test_mixed_documents_are_pieces_of_the_documents(spark):
    rng = random.Random(11)
    rows = [(k, prose(rng, rng.randrange(1, 90)), f"s{k % 4}") for k in range(60)]
    docs = clashing(spark, rows)
    mixed = mixing.mixed_documents(docs, block=16)
    assert mixed.columns == docs.columns
    text = {i: " ".join(B.words(t)) for i, t, _ in rows}
    words = {}
    for r in mixed.collect():
        assert r.text and f" {r.text} " in f" {text[r.doc_id]} " and r.n_chars == len(r.text)
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split(" "))
    counted = {r.doc_id: r.taken for r in mixing.taken_words(docs, block=16).collect()}
    assert words == {k: v for k, v in counted.items() if v}


def test_the_mix_is_blocks_of_text_dealt_to_shards(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(k, prose(rng, rng.randrange(1, 90)), f"s{k % 3}") for k in range(60)] + [(90, "a b c", None)]
    docs = clashing(spark, rows)
    monkeypatch.setattr(mixing, "SLOTS_PER_SHARD", 8)
    mix = mixing.mixed_blocks(docs, block=16).collect()
    _, sources = mixing.layout(docs.select("doc_id", "source", "text"))
    shards = mixing.n_shards(sources, 16)
    sizes, slots, dealt, texts = {}, {}, {}, {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(B.words(t))
    for r in mix:
        assert len(r.text.split(" ")) == r.words <= 16
        slots.setdefault(r.source, []).append(r.slot)
        dealt.setdefault(r.source, {}).setdefault(r.shard, 0)
        dealt[r.source][r.shard] += 1
        texts.setdefault((r.source, r.block), set()).add(r.text)
    want = targets(sizes)
    seeds = {r.src[1:] or None: r.seed for r in sources.select(
        "src", mixing.F.xxhash64("src", mixing.F.lit(mixing.SEED)).alias("seed")).collect()}
    for s in sizes:
        assert sorted(slots[s]) == list(range(len(slots[s])))
        assert abs(sum(r.words for r in mix if r.source == s) - want[s]) <= 1
        found, n = mixing.shard_counts(len(slots[s]), shards, seeds[s] & (2 ** 63 - 1))
        assert dealt[s] == dict(zip(found.tolist(), n.tolist()))
    assert shards > 2 and len({r.shard for r in mix}) > 2
    # a block drawn again has the same text, but for the cut one
    assert all(max(x, key=len).startswith(y) for x in texts.values() for y in x)
    drawn = mixing.mixed_documents(docs, block=16).collect()
    assert sorted(w for r in drawn for w in r.text.split(" ")) == sorted(
        w for r in mix for w in r.text.split(" "))
    few = {r.doc_id: r.mix_digest for r in mixing.taken_words(docs, block=16).collect()}
    monkeypatch.setattr(mixing, "SLOTS_PER_SHARD", 1024)
    one = {r.doc_id: r.mix_digest for r in mixing.taken_words(docs, block=16).collect()}
    assert few != one


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(n):
    for seed in (0, 5, 2 ** 63):
        out = mixing.permuted(np.arange(n), n, np.full(n, seed, np.uint64))
        assert sorted(out.tolist()) == list(range(n))


def test_shard_counts_add_up():
    for slots, shards in ((0, 3), (5, 100), (1000, 7), (1, 1)):
        found, counts = mixing.shard_counts(slots, shards, 3)
        assert counts.sum() == slots and len(set(found.tolist())) == len(found)


# -- all of them -----------------------------------------------------------

@pytest.mark.parametrize("run", [
    lambda d: quality.quality_rules(d), lambda d: quality.keep_good(d),
    lambda d: lines.removed_lines(d), lambda d: lines.without_boilerplate(d),
    lambda d: simhash.near_groups(d, 3, 3), lambda d: simhash.one_of_each_group(d),
    lambda d: mixing.taken_words(d), lambda d: mixing.mixed_documents(d),
    lambda d: packing.pack(d)])
def test_empty_and_all_null_tables(spark, run):
    assert run(spark.createDataFrame(EMPTY, SCHEMA)).count() == 0
    nulls = spark.createDataFrame([(None,) * 5] * 3, SCHEMA)
    assert run(nulls).count() in (0, 1, 3)


def test_line_text_digest(spark, sf_small):
    out = lines.op2_line_dedup(spark, sf_small).collect()
    assert all(r.text_md5 is None or len(r.text_md5) == len(hashlib.md5().hexdigest()) for r in out)
