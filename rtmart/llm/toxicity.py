"""Toxicity by a subsequence string-kernel machine (``string_svm``) over sentences.

A text is scored whole: its words are units, a run of three or more single
characters ("i d i o t") is one more unit, a unit of more than 24 characters
is cut into overlapping windows. A sentence ends with a word that ends in
``.``, ``!`` or ``?``, and after SENTENCE words at most. Each distinct unit of
a batch is compared with the landmarks once; a sentence's margin is the sum
over its units, a document's the largest of its sentences, and a logistic fit
on documents turns it into the score.

Learned from labelled documents that are not held out, bounded by parameters:
the ``texts`` distinct texts of each label with the smallest hashes are cut
into sentences, each labelled as its document; the ``sentences`` of each label
with the smallest hashes are fitted, and again twice with only the sentence of
each toxic text that the machine before finds worst as a toxic one. Landmarks are the units of the sampled
texts whose presence tells the labels apart best (by the likelihood ratio),
and as many others drawn from clean sentences by hash. Margins are computed for all
documents first and calibrated on at most ``calibration`` documents of each label.

Defined cases: a null text is empty; an empty text has the margin of an empty
sentence; without labelled documents of both labels every score is 0; a null
doc_id is not held out and has no label; of repeated labels of a doc_id the
largest holds, null ones are left out; texts with both labels among their
copies are toxic; ties in hashes go by text; repeated rows get the same score; an empty
table gives no rows; other columns of the caller are not read.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rtmart.llm import string_svm as S, text as T
from rtmart.operators.lineage import cut_lineage

#: Distinct texts of each label that are sampled at most.
TEXTS = 2000
#: Sentences of each label that are fitted at most.
SENTENCES = 8000
#: Documents of each label that the score is calibrated on at most.
CALIBRATION = 20000
#: Landmarks of each kind.
LANDMARKS = 24
#: Fits of the machine, all but the first on the worst sentence of each toxic text.
ROUNDS = 3
#: Words of a sentence.
SENTENCE = 32
#: Characters of a text that are split into words at once.
CHARS_AT_ONCE = 1 << 20
#: Units compared with the landmarks at once.
UNITS_AT_ONCE = 1 << 14
EDGES = ".,;:!?\"'()[]{}<>*_~`|-"
_SPACE = re.compile(r"\s")


# -- texts to units ----------------------------------------------------------

def text_words(text: str):
    """The text's words in lower case, in lists of bounded size."""
    at = 0
    while at < len(text):
        end = min(len(text), at + CHARS_AT_ONCE)
        if end < len(text):
            stop = _SPACE.search(text, end)
            end = stop.end() if stop else len(text)
        yield text[at:end].lower().split()
        at = end


def windows(word: str) -> list[str]:
    """The units of a word: itself without the marks around it, or windows of LONGEST."""
    word = word.strip(EDGES).replace("\0", "")
    if len(word) <= S.LONGEST:
        return [word]
    half = S.LONGEST // 2
    return [word[a:a + S.LONGEST] for a in range(0, len(word) - half, half)]


def unit_margins(words: list[str], model: dict) -> np.ndarray:
    """Each word's share of the margin; one in windows has the sum of theirs."""
    out = np.zeros(len(words))
    owner, units = array("q"), []

    def flush():
        if units:
            np.add.at(out, np.frombuffer(owner, np.int64), S.kernel(units, model["table"]) @ model["by_landmark"])
            del owner[:], units[:]

    for i, word in enumerate(words):
        cut = windows(word)
        units.extend(cut)
        owner.extend([i] * len(cut))
        if len(units) >= UNITS_AT_ONCE:
            flush()
    flush()
    return out


class Words:
    """The words of many texts as numbers, with the text that each stands in."""

    def __init__(self):
        self.seen: dict[str, int] = {}
        self.tokens, self.ends = array("i"), []

    def add(self, text: str | None) -> None:
        number = self.seen
        for words in text_words(text or ""):
            self.tokens.extend([number.setdefault(w, len(number)) for w in words])
        self.ends.append(len(self.tokens))

    def sentences(self) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
        """(token numbers, first token of each sentence, words, texts' ends)."""
        tokens, words = np.frombuffer(self.tokens, np.int32), list(self.seen)
        ends = np.asarray(self.ends, np.int64)
        closing = np.fromiter((w[-1] in ".!?" for w in words), bool, len(words))
        first = np.zeros(len(tokens), bool)
        if len(tokens):
            first[0] = True
            first[1:] = closing[tokens[:-1]]
            first[ends[:-1][ends[:-1] < len(tokens)]] = True
            start = np.flatnonzero(first)
            place = np.arange(len(tokens)) - np.repeat(start, np.diff(np.r_[start, len(tokens)]))
            first |= place % SENTENCE == 0
        return tokens, np.flatnonzero(first), words, ends

    def spelled(self, tokens: np.ndarray, words: list[str]) -> list[tuple[int, str]]:
        """(last token, unit) of the runs of single characters."""
        short = [w.strip(EDGES) for w in words]
        single = np.fromiter((len(w) == 1 for w in short), bool, len(words))[tokens]
        edge = np.flatnonzero(np.diff(np.r_[False, single, False].astype(np.int8)))
        ends = np.asarray(self.ends)
        out = []
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            while a < b:                     # a run ends with its text
                to = min(b, int(ends[np.searchsorted(ends, a, "right")]))
                if to - a >= 3:
                    out.append((to - 1, "".join(short[tokens[k]] for k in range(a, to))))
                a = to
        return out


def document_margins(texts, model: dict) -> np.ndarray:
    """The largest margin of each text's sentences."""
    words = Words()
    for text in texts:
        words.add(text)
    tokens, starts, names, ends = words.sentences()
    out = np.full(len(ends), model["shift"])
    if not len(tokens):
        return out
    share = unit_margins(names, model)[tokens]
    spelled = words.spelled(tokens, names)
    if spelled:
        distinct = {u: i for i, u in enumerate(dict.fromkeys(u for _, u in spelled))}
        more = unit_margins(list(distinct), model)
        np.add.at(share, [k for k, _ in spelled], more[[distinct[u] for _, u in spelled]])
    margins = np.add.reduceat(share, starts) + model["shift"]
    begins = np.r_[0, ends[:-1]]
    filled = np.flatnonzero(ends > begins)       # sentences start with their texts
    out[filled] = np.maximum.reduceat(margins, np.searchsorted(starts, begins[filled]))
    return out


# -- learning ----------------------------------------------------------------

def labelled_texts(rows: DataFrame, labels: DataFrame, texts: int) -> DataFrame:
    """rank, toxic, text: at most ``texts`` distinct texts of each label."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("l_id")).agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    ranked = rows.where(~F.col("held_out") & F.col("doc_id").isNotNull()).withColumn(
        "rank", F.xxhash64(F.md5(T.whole_text()), F.lit(7)))
    # ids and hashes only, until the sample is known
    known = ranked.select("doc_id", "rank").join(marks, F.col("doc_id") == F.col("l_id")).groupBy("rank").agg(
        F.max("toxic").alias("toxic"))
    known = cut_lineage(known, "toxicity-ranks")
    chosen = [(r["rank"], r["toxic"]) for toxic in (0, 1) for r in
              known.where(F.col("toxic") == toxic).orderBy("rank").limit(texts).collect()]
    if len({toxic for _, toxic in chosen}) < 2:
        return known.limit(0).select("rank", "toxic", F.lit("").alias("text"))
    sample = rows.sparkSession.createDataFrame(chosen, "rank long, toxic int")       # bounded
    found = ranked.where(F.col("rank").isin([rank for rank, _ in chosen])).select("rank", T.whole_text().alias("text"))
    return cut_lineage(found.groupBy("rank").agg(F.min("text").alias("text")).join(F.broadcast(sample), "rank"),
                       "toxicity-texts")


def sentence_rows(texts: DataFrame) -> DataFrame:
    """toxic, rank, words: the units of every sentence of the sampled texts."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                words = Words()
                words.add(batch.column("text")[i].as_py())
                tokens, starts, names, _ = words.sentences()
                extra: dict[int, list[str]] = {}
                for k, unit in words.spelled(tokens, names):
                    extra.setdefault(k, []).append(unit)
                units = [[u for u in windows(w) if len(u) > 2] for w in names]
                stops = np.r_[starts[1:], len(tokens)].astype(int)
                for s in range(0, len(starts), 1024):
                    lists = [[u for k in range(a, b) for u in (units[tokens[k]] + [
                        v for e in extra.get(k, ()) for v in windows(e)])]
                        for a, b in zip(starts[s:s + 1024].tolist(), stops[s:s + 1024].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.column("toxic")[i].as_py()] * len(lists), pa.int32()),
                         pa.array([batch.column("rank")[i].as_py()] * len(lists), pa.int64()),
                         pa.array(lists, pa.list_(pa.string()))], ["toxic", "rank", "words"])

    return texts.select("toxic", "rank", "text").mapInArrow(run, "toxic int, rank long, words array<string>")


def landmark_words(sentences: DataFrame, number: int = LANDMARKS) -> list[str]:
    """Units that tell the labels apart best, by the texts they stand in, and as many clean ones by hash."""
    size = sentences.groupBy("toxic").agg(F.count_distinct("rank").alias("n"))
    of = {r["toxic"]: r["n"] for r in size.collect()}
    units = sentences.select("toxic", "rank", F.explode("words").alias("unit")).distinct()
    counts = units.groupBy("unit").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    # likelihood ratio of two binomials against one, for units more frequent in toxic texts
    t, c, nt, nc = F.col("t"), F.col("c"), float(of[1]), float(of[0])
    both = (t + c) / (nt + nc)

    def part(k, n, p):
        return F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0) + F.when(
            n - k > 0, (n - k) * F.log((n - k) / (n * (1 - p)))).otherwise(0.0)

    ratio = F.when((t / nt > c / nc) & (both < 1), part(t, F.lit(nt), both) + part(c, F.lit(nc), both)).otherwise(0.0)
    best = counts.select("unit", ratio.alias("ratio")).where(F.col("ratio") > 0).orderBy(
        F.desc("ratio"), "unit").limit(number)
    clean = counts.where((t == 0) & (c > 1)).orderBy(F.xxhash64("unit", F.lit(13)), "unit").limit(number)
    return [r["unit"] for r in [*best.select("unit").collect(), *clean.select("unit").collect()]]


def fitted(texts: DataFrame, sentences: int = SENTENCES, landmarks: int = LANDMARKS) -> dict | None:
    """The machine; None without sentences of both labels."""
    rows = cut_lineage(sentence_rows(texts), "toxicity-sentences")
    order = F.xxhash64("rank", F.array_join("words", " "), F.lit(3))
    chosen = [(r["toxic"], r["words"], r["rank"]) for toxic in (0, 1) for r in
              rows.where(F.col("toxic") == toxic).where(F.size("words") > 0)
              .select("toxic", "words", "rank", order.alias("o")).orderBy("o", "words").limit(sentences).collect()]
    if len({toxic for toxic, *_ in chosen}) < 2:
        return None
    marks = landmark_words(rows, landmarks)
    if not marks:
        return None
    table = S.landmark_table(marks)
    root = S.inverse_root(table)
    number: dict[str, int] = {}
    tokens = np.array([number.setdefault(w, len(number)) for _, words, _ in chosen for w in words])
    lengths = np.array([len(words) for _, words, _ in chosen])
    features = np.zeros((len(chosen), root.shape[1]))
    names = list(number)
    each = np.concatenate([S.kernel(names[k:k + UNITS_AT_ONCE], table) for k in range(0, len(names), UNITS_AT_ONCE)])
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    for k in range(0, len(chosen), 1024):          # sums over each sentence's words
        some = slice(starts[k], starts[k] + lengths[k:k + 1024].sum())
        features[k:k + 1024] = np.add.reduceat(each[tokens[some]], starts[k:k + 1024] - starts[k], axis=0) @ root
    y = np.array([1.0 if toxic else -1.0 for toxic, *_ in chosen])
    text = np.array([rank for *_, rank in chosen])
    fit = np.arange(len(y))
    for _ in range(ROUNDS):
        w, shift = S.fit_svm(features[fit], y[fit])
        margin = features @ w + shift
        by_text = np.lexsort((margin, text))                 # the worst of a text last
        last = by_text[np.r_[text[by_text][1:] != text[by_text][:-1], True]]
        fit = np.sort(np.r_[np.flatnonzero(y < 0), last[y[last] > 0]])
    return {"table": table, "by_landmark": S.word_weights(table, root, w), "shift": shift}


# -- scores ------------------------------------------------------------------

def margins(rows: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, margin of each row; the model has a fixed size."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            out = document_margins((v.as_py() for v in batch.column("text")), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(out, pa.float64())],
                ["doc_id", "held_out", "margin"])

    return rows.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, margin double")


def calibrated(scored: DataFrame, labels: DataFrame, most: int = CALIBRATION) -> tuple[float, float]:
    """Slope and offset of the score, from at most ``most`` labelled documents of each label, in their shares."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("l_id")).agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = scored.where(~F.col("held_out") & F.col("doc_id").isNotNull()).join(
        marks, F.col("doc_id") == F.col("l_id")).select("doc_id", "margin", "toxic")
    found = [r for toxic in (0, 1) for r in known.where(F.col("toxic") == toxic).orderBy(
        F.xxhash64("doc_id", F.lit(5)), "margin").limit(most).collect()]
    return S.probability(np.array([r["margin"] for r in found]), np.array([float(r["toxic"]) for r in found]))


def toxicity(docs: DataFrame, labels: DataFrame, texts: int = TEXTS, sentences: int = SENTENCES) -> DataFrame:
    """doc_id, held_out, margin, score of each row."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    model = fitted(labelled_texts(rows, labels, texts), sentences)
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("margin"), F.lit(0.0).alias("score"))
    scored = cut_lineage(margins(rows, model), "toxicity-margins")
    slope, offset = calibrated(scored, labels)
    score = 1 / (1 + F.exp(-(F.lit(slope) * F.col("margin") + F.lit(offset))))
    return scored.withColumn("score", score)


def op11_toxicity(spark, sf_dir: str) -> DataFrame:
    scored = toxicity(T.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
