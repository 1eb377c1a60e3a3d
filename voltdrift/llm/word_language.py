"""Language of words and documents: a conditional random field over the words of a text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltdrift.llm.chain import chains, marginals
from voltdrift.llm.common import fold, read
from voltdrift.llm.fitting import minimised

SAMPLE = 200  # documents learned from in each language, at most
RIDGE = 1e-6
FOLDS, HELD_OUT = 4, 2
NONE = "und"
BATCH_CHARS = 2_000_000  # texts handled together, unless one is longer
GRAMS, AFFIXES, LEXICON = 1 << 15, 1 << 14, 1 << 17  # columns of hashed features
WIDTH = GRAMS + 2 * AFFIXES + LEXICON
_ASCII_LETTER = re.compile("[A-Za-z]")
_LETTER = np.zeros(256, bool)
_LETTER[list(b"abcdefghijklmnopqrstuvwxyz")] = True
_LETTER[128:] = True
_MIX = np.random.default_rng(7).integers(1, 1 << 32, (64, 256), dtype=np.uint32) | np.uint32(1)


class Words(NamedTuple):
    """The words of some texts, one after another: runs of letters, lower-cased, as UTF-8."""

    grams: np.ndarray  # a hashed column for each byte of each word: it and its neighbours
    starts: np.ndarray  # of each word in ``grams``
    fixed: np.ndarray  # words x 3: columns of prefix, suffix and the word itself
    per_doc: np.ndarray


def _fold(hashed: np.ndarray, size: int) -> np.ndarray:
    return ((hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x9E3779B1) >> np.uint32(33 - size.bit_length())).astype(np.int32)


def words_in(texts: list[str]) -> Words:
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    whole = np.frombuffer(b"  " + b"  ".join(raw) + b"  ", np.uint8)
    letter = _LETTER[whole]
    plain = np.where(letter, whole, 0).astype(np.uint8)
    place = np.nonzero(letter)[0]
    begins = ~letter[place - 1]
    starts = np.nonzero(begins)[0]
    first = place[starts]
    sizes = np.diff(np.concatenate([starts, [len(place)]]))
    last = first + sizes - 1
    grams = _MIX[0][plain[place - 1]] + _MIX[1][plain[place]] * np.uint32(3) + _MIX[2][plain[place + 1]] * np.uint32(5)
    second, third = np.where(sizes > 1, plain[np.minimum(first + 1, last)], 0), np.where(sizes > 2, plain[np.minimum(first + 2, last)], 0)
    prefix = _MIX[3][plain[first]] + _MIX[4][second] + _MIX[5][third]
    second, third = np.where(sizes > 1, plain[np.maximum(last - 1, first)], 0), np.where(sizes > 2, plain[np.maximum(last - 2, first)], 0)
    suffix = _MIX[6][plain[last]] + _MIX[7][second] + _MIX[8][third]
    within = np.arange(len(place)) - np.repeat(starts, sizes)
    each = _MIX[8 + within % 55, plain[place]] * (within.astype(np.uint32) * np.uint32(2) + np.uint32(1))
    word = np.add.reduceat(each, starts, dtype=np.uint32) if len(starts) else each
    fixed = np.stack(
        [
            GRAMS + _fold(prefix, AFFIXES),
            GRAMS + AFFIXES + _fold(suffix, AFFIXES),
            GRAMS + 2 * AFFIXES + _fold(word, LEXICON),
        ],
        axis=1,
    )
    bounds = np.cumsum([2, *(len(x) + 2 for x in raw)])
    per_doc = np.diff(np.searchsorted(first, bounds))
    return Words(_fold(grams, GRAMS), starts, fixed, per_doc)


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # columns x languages
    transitions: np.ndarray

    def emissions(self, words: Words) -> np.ndarray:
        sizes = np.diff(np.concatenate([words.starts, [len(words.grams)]]))
        scores = np.add.reduceat(self.weights[words.grams], words.starts) if len(words.starts) else self.weights[:0]
        scores = scores / np.sqrt(np.maximum(sizes, 1)).astype(scores.dtype)[:, None]
        for column in words.fixed.T:
            scores += self.weights[column]
        return scores

    def posteriors(self, words: Words) -> np.ndarray:
        """The chance of each language (columns) for each word."""
        full = words.per_doc[words.per_doc > 0]
        return marginals(self.emissions(words), self.transitions, chains(full))

    def shares(self, texts: list[str]) -> np.ndarray:
        """Documents x languages: the mean of the words' posteriors; zero without words."""
        words = words_in(texts)
        doc = np.repeat(np.arange(len(texts)), words.per_doc)
        found = self.posteriors(words) if len(doc) else np.zeros((0, len(self.languages)))
        sums = np.stack([np.bincount(doc, found[:, k], len(texts)) for k in range(len(self.languages))], axis=1)
        return sums / np.maximum(words.per_doc, 1)[:, None]


def fitted(texts: list[str], langs: list[str], ridge: float = RIDGE) -> Model:
    """Weights by maximum likelihood, in two rounds.

    In the first every word has its document's language. Texts switch languages,
    so words are then labelled by the first model's posteriors under a firm
    preference for staying, and the second round learns weights and transitions
    from these sequences.
    """
    languages = sorted(set(langs))
    k = len(languages)
    words = words_in(texts)
    full = words.per_doc > 0
    at = chains(words.per_doc[full])
    sizes = np.diff(np.concatenate([words.starts, [len(words.grams)]]))
    spread = 1 / np.sqrt(np.maximum(sizes, 1))
    n = max(1, len(sizes))
    gold = np.repeat(np.searchsorted(languages, langs), words.per_doc) if k else np.zeros(0, np.int64)
    inner = np.ones(len(gold), bool)
    inner[(np.cumsum(words.per_doc) - words.per_doc)[full]] = False

    def loss_for(gold: np.ndarray, chained: bool):
        after = np.nonzero(inner)[0]
        moves = np.zeros((k, k))
        np.add.at(moves, (gold[after - 1], gold[after]), 1)
        one = np.eye(k)[gold]

        def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
            weights, between = x[: WIDTH * k].reshape(WIDTH, k), x[WIDTH * k :].reshape(k, k)
            scores = Model(languages, weights, between).emissions(words)
            if chained:
                found, pairs, normal = marginals(scores, between, at, pairs=True)
                value, slope_moves = normal - (moves * between).sum(), pairs - moves
            else:
                top = scores.max(axis=1, keepdims=True)
                found = np.exp(scores - top)
                total = found.sum(axis=1, keepdims=True)
                found /= total
                value, slope_moves = float((np.log(total) + top).sum()), np.zeros((k, k))
            value -= scores[np.arange(len(gold)), gold].sum()
            off = found - one
            slope = np.empty((WIDTH, k))
            for j in range(k):
                slope[:, j] = np.bincount(words.grams, np.repeat(off[:, j] * spread, sizes), WIDTH)
                for column in words.fixed.T:
                    slope[:, j] += np.bincount(column, off[:, j], WIDTH)
            slope = np.concatenate([slope.ravel(), slope_moves.ravel()]) / n
            return float(value) / n + ridge * float(x @ x), slope + 2 * ridge * x

        return loss

    start = np.zeros(WIDTH * k + k * k)
    if k < 2 or not len(gold):
        return Model(languages, np.zeros((WIDTH, k), np.float32), np.zeros((k, k)))
    x = minimised(loss_for(gold, chained=False), start, steps=15, memory=4)
    firm = Model(languages, x[: WIDTH * k].reshape(WIDTH, k), np.where(np.eye(k) > 0, 0.0, -5.0))
    gold = firm.posteriors(words).argmax(axis=1)
    x[WIDTH * k :] = firm.transitions.ravel()
    x = minimised(loss_for(gold, chained=True), x, steps=15, memory=4)
    return Model(languages, x[: WIDTH * k].reshape(WIDTH, k).astype(np.float32), x[WIDTH * k :].reshape(k, k).astype(np.float32))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of the languages in ``docs`` (doc_id, text, lang), learned outside the held-out fold.

    At most ``sample`` documents of each language are learned from, whole; which
    ones depends on a hash of their ids.
    """
    ids = docs.where((fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("lang").isNotNull()).select("doc_id", "lang")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = ids.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample).select("doc_id").distinct()
    rows = docs.select("doc_id", "text", "lang").join(F.broadcast(chosen), "doc_id").where(F.col("lang").isNotNull())
    rows = rows.orderBy("doc_id", "lang").collect()
    return fitted([r["text"] or "" for r in rows], [r["lang"] for r in rows])


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def labelled(texts: list[str]) -> tuple[list[str], list[float]]:
            if not model.languages:
                return [NONE] * len(texts), [0.0] * len(texts)
            shares = model.shares(texts)
            best = shares.argmax(axis=1)
            some = shares.sum(axis=1) > 0
            for i in np.nonzero(some)[0]:
                if not (_ASCII_LETTER.search(texts[i]) or any(map(str.isalpha, texts[i]))):
                    some[i] = False
            score = np.clip(shares[np.arange(len(texts)), best], 0, 1) * some
            return [model.languages[b] if s else NONE for b, s in zip(best, some, strict=True)], score.tolist()

        for batch in batches:
            names, scores, texts, size = [], [], [], 0
            for x in batch.column(1):
                texts.append(x.as_py() or "")
                size += len(texts[-1])
                if size > BATCH_CHARS:
                    found = labelled(texts)
                    names, scores, texts, size = names + found[0], scores + found[1], [], 0
            if texts:
                found = labelled(texts)
                names, scores = names + found[0], scores + found[1]
            arrays = [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang_pred", "score"])

    return run


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs``: the language with the largest share of its words.

    The score is that share, the mean of the words' posteriors. Whole texts count.
    A NULL text, and one without a letter, is ``und`` with score 0, as every text
    is where nothing could be learned; repeated rows and rows without an id are
    labelled like others.
    """
    return docs.select("doc_id", "text").mapInArrow(_predict(model), "doc_id long, lang_pred string, score double")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return predicted(docs, train(docs)).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score"
    )
