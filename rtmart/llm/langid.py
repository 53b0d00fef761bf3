"""Language ID by segmentation-marginalised unigrams.

A language gives each piece of a fixed public vocabulary a probability. The
likelihood of a word is the sum over all its segmentations into pieces, by the
forward algorithm; a text's is the product over its words. Probabilities are
learned by expectation maximisation (forward and backward) on the words of a
sample of labelled texts, bounded for each language. Every text and every word
is scored whole: the distinct words of a batch are scored together, and each
text adds up its words.

Letters are lower-cased; other characters only separate words. A character
that no piece covers is an unknown piece of its own. A language is learned
however rare it is; one whose sampled texts hold no letter is not.

Defined cases: null text or one without a letter is ``und`` with score 0, as
is every text when no labelled text is to be learned from; ties go to the
language first in order; repeated rows get the same answer; an empty table
gives no rows.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from rtmart.llm import text as T
from rtmart.operators.joins import broadcast_if_small
from rtmart.operators.lineage import cut_lineage

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
WORD_START = "▁"
#: Distinct labelled texts of a language that are learned from at most, and its distinct words.
SAMPLE_TEXTS = 1500
SAMPLE_WORDS = 30000
#: Letters of a word that are learned together; longer ones are learned in parts.
LEARNED = 1000
ROUNDS = 4
#: The longest piece that is used, in letters.
LETTERS = 24
#: Places of words whose pieces are looked up together, and between which sums are scaled.
PLACES = 512
RESCALE = 16
#: Characters of a text that are split into words at once.
CHARS_AT_ONCE = 1 << 20
#: Sums (words x places x languages) that are held together, but for a longer single word.
CELLS = 1 << 20
#: Occurrences that the pooled distribution counts for in each language's.
POOLED = 2000.0

_WORDS = re.compile(r"[^\W\d_]+")
_BREAK = re.compile(r"[\W\d_]")


# -- vocabulary -----------------------------------------------------------

def vocabulary(path: str = VOCABULARY) -> list[str]:
    """Lower-case letter pieces of a sentencepiece model, at most LETTERS + 1 long."""
    import sentencepiece

    if not os.path.exists(path):
        raise FileNotFoundError(f"language ID needs the sentencepiece model of a public tokenizer at {path}")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p for p in pieces if p == p.lower() and len(p) <= LETTERS + 1
                   and (p.strip(WORD_START) or p == WORD_START)
                   and all(c.isalpha() for c in p.strip(WORD_START))})


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _chars(words: list[str], width: int) -> np.ndarray:
    """(words, width) code points plus one, 0 beyond the end."""
    flat = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), np.uint32)
    out = flat.reshape(len(words), width).astype(np.uint64) + np.uint64(1)
    out[out == 1] = 0
    return out


def piece_index(pieces: list[str]) -> dict:
    """Pieces by length, as sorted hashes with their numbers; number 0 is unknown."""
    index = {}
    for length in sorted({len(p) for p in pieces}):
        numbers = [i + 1 for i, p in enumerate(pieces) if len(p) == length]
        hashes = _window_hashes(_chars([pieces[i - 1] for i in numbers], length), length)[:, 0]
        order = np.argsort(hashes)
        index[length] = (hashes[order], np.asarray(numbers, np.int32)[order])
    return index


def _window_hashes(chars: np.ndarray, length: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        n = chars.shape[1] - length + 1
        h = np.zeros((len(chars), n), np.uint64)
        for k in range(length):
            h = (h ^ chars[:, k:k + n]) * _STEP
            h ^= h >> np.uint64(31)
        return h


def segment_ids(words: list[str], index: dict) -> tuple[np.ndarray, dict]:
    """(lengths, {piece length: (words, starts) piece numbers, -1 where there is none})."""
    lengths = np.array([len(w) for w in words])
    width = int(lengths.max())
    chars = _chars(words, width)
    ids = {}
    for length, (hashes, numbers) in index.items():
        if length > width:
            break
        h = _window_hashes(chars, length)
        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        found = np.where(hashes[at] == h, numbers[at], -1)
        inside = np.arange(h.shape[1])[None, :] + length <= lengths[:, None]
        found[~inside] = -1
        if length == 1:
            found[(found < 0) & inside] = 0          # an unknown character
        if (found >= 0).any():
            ids[length] = found
    if 1 not in ids:
        ids[1] = np.where(np.arange(width)[None, :] < lengths[:, None], 0, -1)
    return lengths, ids


# -- forward and backward -------------------------------------------------

def _blocks(words: list[str], langs: int):
    """Runs of word numbers of similar length whose cells are bounded; a word beyond that is alone."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    part: list[int] = []
    for i in order:
        if part and (len(part) + 1) * (len(words[i]) + 1) * langs > CELLS:
            yield part
            part = []
        part.append(i)
    if part:
        yield part


class Segments:
    """The pieces that start at each place of some words, found a run of places at a time."""

    def __init__(self, words: list[str], index: dict):
        self.lengths, self.index = np.array([len(w) for w in words]), index
        self.width, self.words, self.at, self.ids = int(self.lengths.max()), words, -PLACES, {}

    def starting(self, place: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(piece length, rows, piece numbers) of the pieces that start at the place."""
        at = place - place % PLACES
        if at != self.at:
            reach = PLACES + max(self.index, default=1)
            self.rows = np.flatnonzero(self.lengths > at)
            some = [self.words[i][at:at + reach] for i in self.rows]
            self.at, (_, self.ids) = at, segment_ids(some, self.index)
        out = []
        for length, found in self.ids.items():
            if place - at < found.shape[1]:
                piece = found[:, place - at]
                on = np.flatnonzero(piece >= 0)
                if len(on):
                    out.append((length, self.rows[on], piece[on]))
        return out


def forward(words: list[str], index: dict, prob: np.ndarray, every: bool = False):
    """(words, languages) log of the summed probability of all segmentations.

    The sums of the last places roll through a window as long as the longest
    piece, so a word of any length is summed whole. With ``every``, also the
    log sums of all places, (places, words, languages).
    """
    segments = Segments(words, index)
    room = max(index, default=1) + 1
    ahead = np.zeros((room, len(words), prob.shape[1]))
    ahead[0] = 1.0
    scale, out = np.zeros(ahead.shape[1:]), np.zeros(ahead.shape[1:])
    kept = np.full((segments.width + 1, *scale.shape), -np.inf) if every else None
    for place in range(segments.width + 1):
        here = ahead[place % room]
        done = np.flatnonzero(segments.lengths == place)
        if len(done):
            out[done] = np.log(here[done]) + scale[done]
        if every:
            with np.errstate(divide="ignore"):
                kept[place] = np.log(here) + scale
        if place == segments.width:
            break
        for length, rows, piece in segments.starting(place):
            ahead[(place + length) % room, rows] += here[rows] * prob[piece]
        ahead[place % room] = 0
        if place % RESCALE == RESCALE - 1:
            most = ahead.max(axis=0)
            most[most == 0] = 1
            ahead /= most
            scale += np.log(most)
    return (out, kept) if every else out


def word_scores(words: list[str], index: dict, prob: np.ndarray) -> np.ndarray:
    """(words, languages): log of the summed probability of all segmentations."""
    out = np.zeros((len(words), prob.shape[1]))
    for part in _blocks(words, prob.shape[1]):
        out[part] = forward([WORD_START + words[i] for i in part], index, prob)
    return out


def expected_counts(words: list[str], weights: np.ndarray, index: dict, prob: np.ndarray) -> np.ndarray:
    """(pieces, languages): expected uses of each piece, by language."""
    total, logs = np.zeros_like(prob), np.log(prob)
    for part in _blocks(words, prob.shape[1]):
        marked = [WORD_START + words[i] for i in part]
        whole, alpha = forward(marked, index, prob, every=True)
        segments = Segments(marked, index)
        beta = np.full_like(alpha, -np.inf)
        beta[segments.lengths, np.arange(len(part))] = 0.0
        for place in range(segments.width - 1, -1, -1):
            for length, rows, piece in segments.starting(place):
                way = logs[piece] + beta[place + length, rows]
                beta[place, rows] = np.logaddexp(beta[place, rows], way)
                share = np.exp(alpha[place, rows] + way - whole[rows])
                np.add.at(total, piece, share * weights[part][rows])
    return total


def fit(counts: dict[str, dict[str, int]], texts: dict[str, int], pieces: list[str]) -> dict:
    """A model from each language's word counts and number of texts."""
    langs, index = sorted(counts), piece_index(pieces)
    prob = np.full((len(pieces) + 1, len(langs)), 1.0 / (len(pieces) + 1))
    for _ in range(ROUNDS):
        used = np.zeros_like(prob)
        for k, lang in enumerate(langs):             # a language learns from its own words only
            words = sorted(counts[lang])
            weights = np.array([[float(counts[lang][w])] for w in words])
            used[:, k:k + 1] = expected_counts(words, weights, index, prob[:, k:k + 1])
        pooled = used.sum(axis=1) + 0.1
        used = used + POOLED * (pooled / pooled.sum())[:, None]
        prob = used / used.sum(axis=0)
    total = sum(texts.values())
    return {"langs": langs, "pieces": pieces, "prob": prob,
            "prior": np.log([texts[lang] / total for lang in langs])}


# -- texts ----------------------------------------------------------------

def text_words(text: str):
    """The text's words in lower case, in lists of bounded size."""
    at = 0
    while at < len(text):
        end = min(len(text), at + CHARS_AT_ONCE)
        if end < len(text):
            stop = _BREAK.search(text, end)
            end = stop.end() if stop else len(text)
        words = _WORDS.findall(text[at:end].lower())
        yield [w for w in words if w.isalpha() or any(map(str.isalpha, w))]
        at = end


def labelled_sample(docs: DataFrame, texts: int = SAMPLE_TEXTS, words: int = SAMPLE_WORDS):
    """(word counts, text counts) by language of a sample of the labelled training texts.

    A language's distinct texts are counted approximately and sampled at the
    rate that gives ``texts`` of them, by a hash of the text; of the sample the
    ``texts`` smallest hashes are taken, so copies count once and a rare
    language has all its texts. Words longer than LEARNED letters are learned
    in parts.
    """
    rank = F.xxhash64(F.md5(T.whole_text()), F.lit(5))
    training = docs.where(F.col("lang").isNotNull() & ~F.col("held_out") & F.col("text").isNotNull())
    number = cut_lineage(training.groupBy("lang").agg(F.approx_count_distinct(rank, 0.02).alias("n")),
                         "language-texts")
    # the hash is uniform in 64 bits; an eighth more than wanted, so that hardly a sample falls short
    rate = F.lit(1.125 * texts) / F.col("n")
    known = broadcast_if_small(number.select(F.col("lang").alias("of"), rate.alias("rate")))
    # hashes first, and the texts of the chosen rows only: one row of each text, however many copies it has
    hashed = training.select("lang", "text", rank.alias("rank"),
                             F.xxhash64(F.col("doc_id"), F.lit(9)).alias("key"))
    near = hashed.drop("text").join(known, F.col("lang") == F.col("of")).where(
        (F.col("rank") / F.lit(2.0 ** 63) + 1) / 2 < F.col("rate"))
    near = near.groupBy("lang", "rank").agg(F.min("key").alias("key"))
    first = W.partitionBy("lang").orderBy("rank")                        # within the bounded sample
    chosen = near.withColumn("at", F.row_number().over(first)).where(F.col("at") <= texts).drop("at")
    chosen = broadcast_if_small(cut_lineage(chosen, "language-ranks"))
    sample = cut_lineage(hashed.join(chosen, ["lang", "rank", "key"], "left_semi").groupBy("lang", "rank")
                         .agg(F.min("text").alias("text")).select("lang", "text"), "language-sample")
    part = F.regexp_extract_all(F.lower("text"), F.lit("\\p{L}{1,%d}" % LEARNED), F.lit(0))
    each = sample.select("lang", F.explode(part).alias("word")).groupBy("lang", "word").agg(
        F.count(F.lit(1)).alias("n"))
    most = W.partitionBy("lang").orderBy(F.desc("n"), "word")
    each = each.withColumn("at", F.row_number().over(most)).where(F.col("at") <= words)
    counts: dict[str, dict[str, int]] = {}
    for r in each.select("lang", "word", "n").collect():
        counts.setdefault(r["lang"], {})[r["word"]] = r["n"]
    return counts, {r["lang"]: max(1, r["n"]) for r in number.collect() if r["lang"] in counts}


def identify(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row; the model has a fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        index = piece_index(model["pieces"]) if model else None
        for batch in batches:
            seen: dict[str, int] = {}
            tokens, ends = array("i"), []
            for value in batch.column("text"):
                text = value.as_py()
                for words in text_words(text) if text is not None and model else ():
                    tokens.extend([seen.setdefault(w, len(seen)) for w in words])
                ends.append(len(tokens))
            lang, score = ["und"] * len(ends), np.zeros(len(ends))
            if seen:
                by_word = word_scores(list(seen), index, model["prob"])
                tokens = np.frombuffer(tokens, np.int32)
                start = 0
                for i, end in enumerate(ends):
                    if end > start:
                        z = model["prior"] + sum(by_word[tokens[k:min(end, k + (1 << 18))]].sum(axis=0)
                                                 for k in range(start, end, 1 << 18))
                        p = np.exp(z - z.max())
                        best = int(p.argmax())
                        lang[i], score[i] = model["langs"][best], p[best] / p.sum()
                    start = end
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()),
                 pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")


def language_of(docs: DataFrame, vocabulary_path: str = VOCABULARY) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang",
                       held_out.alias("held_out"))
    counts, texts = labelled_sample(rows)
    return identify(rows, fit(counts, texts, vocabulary(vocabulary_path)) if counts else None)


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    return language_of(T.documents(spark, sf_dir))
