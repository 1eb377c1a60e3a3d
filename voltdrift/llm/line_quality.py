"""Document quality from a conditional random field that labels every line good or bad."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltdrift.llm.chain import chains, marginals
from voltdrift.llm.common import bounded_sample, fold, read
from voltdrift.llm.fitting import log_loss, minimised, sigmoid

SAMPLE = 4_000  # labelled documents learned from, at most
RIDGE = 1e-3
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
BATCH_CHARS = 4_000_000  # texts whose lines are handled together, unless one is longer

_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _QUIET, _SYMBOL, _BEYOND = range(8)
_CLASS = np.full(256, _SYMBOL, np.uint8)
for _chars, _kind in (
    (b"abcdefghijklmnopqrstuvwxyz", _LOWER),
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER),
    (b"0123456789", _DIGIT),
    (b" \t\r\n\x0b\x0c", _SPACE),
    (b".?!", _STOP),
    (b",;:'\"()-", _QUIET),
    (bytes(range(128, 256)), _BEYOND),
):
    _CLASS[list(_chars)] = _kind
_SHARES = np.array([0.005, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.45, 0.6, 0.8, 0.95])
_LENGTHS = np.array([1, 2, 4, 8, 16, 32, 64, 128, 256, 512, 1024, 4096])
_WIDTHS = np.array([1.5, 2.5, 3.5, 4.5, 5.5, 6.5, 8, 10, 14, 20])
_MARKED = (ord(".") | ord("!") << 8, ord("?"))


class Lines(NamedTuple):
    """Lines of some documents, one after another."""

    columns: np.ndarray  # lines x features: the column that each feature sets
    weights: np.ndarray  # characters (bytes) of each line, 1 at least
    per_doc: np.ndarray  # lines of each document


_BINS = [len(_LENGTHS) + 1, len(_LENGTHS) + 1, len(_WIDTHS) + 1, *[len(_SHARES) + 1] * 8, 2, 4]
_OFFSETS = np.cumsum([0, *_BINS])
_PAD = int(_OFFSETS[-1])  # stands for the line before the first and after the last
OWN = len(_BINS)
WIDTH = 3 * (_PAD + 1)


def lines_of(texts: list[str]) -> Lines:
    """Features of every line (between \\n) of every text, with those of the lines around it.

    An empty text is one empty line. All are counts and shares over the whole
    line: its length, words, letters by case, digits, marks and symbols, how many
    of its words are distinct, whether it occurred earlier in the document and how
    it ends.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    per_doc = np.array([x.count(b"\n") + 1 for x in raw], np.int64)
    whole = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    ends = np.nonzero(whole == 10)[0]
    starts = np.concatenate([[0], ends[:-1] + 1])
    sizes = ends - starts
    kinds = _CLASS[whole]

    def counted(of: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(of, dtype=np.int64)])
        return sums[ends] - sums[starts]

    counts = [counted(kinds == k) for k in range(8)]
    blank = kinds == _SPACE
    words = counted(~blank & np.concatenate([[True], blank[:-1]]))
    letters = counts[_LOWER] + counts[_UPPER] + counts[_BEYOND]
    some = np.maximum(sizes, 1)
    distinct, again = np.ones(len(ends)), np.zeros(len(ends), np.int64)
    at = 0
    for text in raw:
        seen = set()
        for line in text.split(b"\n"):
            if line:
                found = line.split()
                if found:
                    distinct[at] = len(set(found)) / len(found)
                if line in seen:
                    again[at] = 1
                seen.add(line)
            at += 1
    last = np.where(sizes > 0, whole[np.maximum(ends - 1, 0)], 10)
    ending = np.select([sizes == 0, np.isin(last, list(b".")), np.isin(last, list(b"?!"))], [0, 1, 2], 3)
    shares = [
        counts[_UPPER] / np.maximum(letters, 1),
        letters / some,
        counts[_DIGIT] / some,
        counts[_SPACE] / some,
        counts[_STOP] / np.maximum(words, 1),
        counts[_QUIET] / some,
        counts[_SYMBOL] / some,
        1 - distinct,
    ]
    own = np.stack(
        [
            np.digitize(sizes, _LENGTHS),
            np.digitize(words, _LENGTHS),
            np.digitize(letters / np.maximum(words, 1), _WIDTHS),
            *(np.digitize(s, _SHARES) for s in shares),
            again,
            ending,
        ],
        axis=1,
    )
    own += _OFFSETS[:-1]
    first = np.cumsum(per_doc) - per_doc
    previous, following = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    previous[first] = _PAD
    following[first + per_doc - 1] = _PAD
    columns = np.concatenate([own, previous + (_PAD + 1), following + 2 * (_PAD + 1)], axis=1)
    return Lines(columns, np.maximum(sizes, 1), per_doc)


class Model(NamedTuple):
    weights: np.ndarray  # of the columns, for label good
    transitions: np.ndarray  # from x to, bad and good
    slope: float
    bias: float

    def good_share(self, lines: Lines) -> np.ndarray:
        """Of each document: the mean chance of its lines to be good, weighted by their length."""
        score = self.weights[lines.columns].sum(axis=1)
        found = marginals(np.stack([np.zeros_like(score), score], axis=1), self.transitions, chains(lines.per_doc))[:, 1]
        doc = np.repeat(np.arange(len(lines.per_doc)), lines.per_doc)
        return np.bincount(doc, found * lines.weights) / np.bincount(doc, lines.weights)

    def score(self, texts: list[str]) -> np.ndarray:
        return sigmoid(self.slope * _logit(self.good_share(lines_of(texts))) + self.bias)


def _logit(share: np.ndarray) -> np.ndarray:
    share = np.clip(share, 1e-4, 1 - 1e-4)
    return np.log(share / (1 - share))


def fitted(texts: list[str], labels: np.ndarray, ridge: float = RIDGE) -> Model:
    """The field's weights by maximum likelihood of the lines' labels, then its calibration.

    A line has its document's label: documents are what is labelled. The weighted
    share of good lines is put on the scale of the labels by logistic regression.
    Without documents of both labels every score is the base rate.
    """
    share = (labels.sum() + 1) / (len(labels) + 2)
    if not 0 < labels.sum() < len(labels):
        return Model(np.zeros(WIDTH), np.zeros((2, 2)), 0.0, float(np.log(share / (1 - share))))
    lines = lines_of(texts)
    at = chains(lines.per_doc)
    gold = np.repeat(labels, lines.per_doc)
    n = len(gold)
    inner = np.repeat(labels, lines.per_doc - 1)
    kept = np.diag([(inner == 0).sum(), (inner == 1).sum()]).astype(np.float64)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        weights, moves = x[:WIDTH], x[WIDTH:].reshape(2, 2)
        score = weights[lines.columns].sum(axis=1)
        found, between, normal = marginals(np.stack([np.zeros_like(score), score], axis=1), moves, at, pairs=True)
        value = normal - (gold * score).sum() - (kept * moves).sum()
        off = np.repeat(found[:, 1] - gold, lines.columns.shape[1])
        slope = np.concatenate([np.bincount(lines.columns.ravel(), off, WIDTH), (between - kept).ravel()])
        return value / n + ridge * (x @ x), slope / n + 2 * ridge * x

    x = minimised(loss, np.zeros(WIDTH + 4), steps=60)
    model = Model(x[:WIDTH], x[WIDTH:].reshape(2, 2), 1.0, 0.0)
    logit = _logit(model.good_share(lines))

    def scale(x: np.ndarray) -> tuple[float, np.ndarray]:
        margin = x[0] * logit + x[1]
        off = (sigmoid(margin) - labels) / len(labels)
        return float(log_loss(margin, labels).mean() + 1e-4 * x[0] ** 2), np.array([(off * logit).sum() + 2e-4 * x[0], off.sum()])

    slope, bias = minimised(scale, np.array([1.0, 0.0]))
    return model._replace(slope=float(slope), bias=float(bias))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of ``labels`` (doc_id, quality), from at most ``sample`` documents outside the held-out fold."""
    kept = labels.where((fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("quality").isin(0, 1))
    chosen = bounded_sample(kept.select("doc_id", F.col("quality").cast("int").alias("label")), sample, F.col("doc_id"), F.col("label"))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").orderBy("doc_id", "label").select("text", "label").collect()
    return fitted([r["text"] or "" for r in rows], np.array([r["label"] for r in rows], np.float64))


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, texts, size = [], [], 0
            for x in batch.column(1):
                texts.append(x.as_py() or "")
                size += len(texts[-1])
                if size > BATCH_CHARS:
                    scores.append(model.score(texts))
                    texts, size = [], 0
            if texts:
                scores.append(model.score(texts))
            found = pa.array(np.concatenate([np.zeros(0), *scores]))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["doc_id", "score"])

    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs``: the chance that its quality label is 1.

    Whole texts count, line by line. NULL and empty texts are scored as one empty
    line; repeated rows and rows without an id are scored like others; other
    columns are not looked at.
    """
    return docs.select("doc_id", "text").mapInArrow(_score(model), "doc_id long, score double")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return scored(docs, train(docs, read(spark, sf_dir, "labels"))).select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
