"""Toxicity: a word classifier that is held to the same score when identity terms are swapped."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltdrift.llm.common import bounded_sample, checkpointed, fold, read
from voltdrift.llm.fitting import Rows, log_loss, minimised, sigmoid

SAMPLE = 8_000  # labelled documents learned from, at most
WORDS = 2_000  # terms with a weight, besides identity terms
LEAST = 3  # labelled documents that must have a term
STEMS = (4, 5, 6)  # letters of a word's stem
OFTEN = (2, 3)  # occurrences of a stem that count as often
DENSE = 0.008  # share of the words from which a stem counts as dense
CACHE = 300_000  # words whose known stems a task keeps
RIDGE = 1e-4
EVEN = 1.0  # weight of the penalty on score changes
FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7
_WORD = re.compile(r"[^\W\d_]+")

# Identity terms, by what they can be swapped for.
IDENTITIES = [
    ["women", "men", "girls", "boys", "transgender"],
    ["woman", "man", "girl", "boy"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"],
    ["black", "white", "asian", "african", "american", "european", "latino", "arab", "hispanic"],
    ["gay", "straight", "lesbian", "bisexual", "heterosexual", "homosexual", "queer"],
    ["immigrants", "refugees", "foreigners", "natives", "citizens"],
    ["blind", "deaf", "disabled", "elderly", "young", "old"],
]
_IDENTITY = {t for terms in IDENTITIES for t in terms}


def _counts(text: str | None) -> Counter[str]:
    return Counter(_WORD.findall((text or "").lower()))


def _stems_of(word: str) -> list[str]:
    """The stems of a word; none of an identity term, so that a swap changes its full-word weight alone."""
    return [] if word in _IDENTITY else [word[:k] for k in STEMS if len(word) >= k]


def _stem_terms(stem: str, count: int, words: int) -> list[str]:
    """A stem (the start of a word), and how often it occurs: often, and often for so many words."""
    dense = count > DENSE * words
    return [f"{stem}-"] + [f"{stem}-{c}" for c in OFTEN if count >= c] + [f"{stem}-{c}%" for c in (1, *OFTEN) if dense and count >= c]


def terms_of(text: str | None) -> set[str]:
    """What the classifier sees of a whole text: its words, and the stems of words that are no identity terms, with their frequency."""
    counts = _counts(text)
    stems: Counter[str] = Counter()
    for word, count in counts.items():
        for stem in _stems_of(word):
            stems[stem] += count
    total = counts.total()
    return set(counts).union(*(_stem_terms(stem, count, total) for stem, count in stems.items()))


class Model:
    """Weights by term; :meth:`score` looks only at the words and stems that have one."""

    def __init__(self, weights: dict[str, float], bias: float) -> None:
        self.weights, self.bias = weights, bias
        self.stems = {t[: t.index("-")] for t in weights if "-" in t}
        self.cache: dict[str, list[str]] = {}

    def known_stems(self, word: str) -> list[str]:
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) > CACHE:
                self.cache.clear()
            found = self.cache[word] = [stem for stem in _stems_of(word) if stem in self.stems]
        return found

    def score(self, text: str | None) -> float:
        known, counts = self.weights, _counts(text)
        margin = self.bias + sum(known[w] for w in sorted(known.keys() & counts.keys()))
        stems: Counter[str] = Counter()
        for word, count in counts.items():
            for stem in self.known_stems(word):
                stems[stem] += count
        total = counts.total()
        for stem in sorted(stems):
            margin += sum(known.get(t, 0.0) for t in _stem_terms(stem, stems[stem], total))
        return float(sigmoid(np.float64(margin)))


def _distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [sorted(terms_of(x.as_py())) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], ["label", "words"])


def fitted(columns: list[list[int]], labels: np.ndarray, vocabulary: list[str], even: float = EVEN, ridge: float = RIDGE) -> Model:
    """Logistic regression on the presence of terms, with a squared penalty on what a swap changes.

    Every document with an identity term is held against copies of it in which
    that term stands for each other one of its list. Identity terms have no stems,
    so the difference of two weights is all that the score's margin changes by.
    """
    number = {w: i for i, w in enumerate(vocabulary)}
    lists = [[number[w] for w in terms if w in number] for terms in IDENTITIES]
    others = {t: [o for o in terms if o != t] for terms in lists for t in terms}
    rows = Rows([np.array(c, np.int64) for c in columns], len(vocabulary))
    swaps: dict[tuple[int, int], int] = {}
    for c in columns:
        present = set(c)
        for t in present & others.keys():
            for o in others[t]:
                if o not in present:
                    swaps[(t, o)] = swaps.get((t, o), 0) + 1
    pair = np.array(list(swaps), np.int64).reshape(-1, 2)
    often = np.array(list(swaps.values()), np.float64) / max(1, sum(swaps.values()))
    n = max(1, len(labels))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        weights, bias = x[:-1], x[-1]
        margin = rows.dot(weights) + bias
        off = (sigmoid(margin) - labels) / n
        change = weights[pair[:, 0]] - weights[pair[:, 1]]
        value = log_loss(margin, labels).sum() / n + even * (often * change**2).sum() + ridge * (weights @ weights)
        slope = rows.gather(off) + 2 * ridge * weights
        slope += np.bincount(pair[:, 0], 2 * even * often * change, len(weights))
        slope -= np.bincount(pair[:, 1], 2 * even * often * change, len(weights))
        return float(value), np.concatenate([slope, [off.sum()]])

    share = (labels.sum() + 1) / (len(labels) + 2)
    start = np.concatenate([np.zeros(len(vocabulary)), [np.log(share / (1 - share))]])
    x = minimised(loss, start, steps=150, tolerance=1e-7) if 0 < labels.sum() < len(labels) else start
    return Model({w: float(x[i]) for w, i in number.items() if x[i]}, float(x[-1]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, words: int = WORDS, even: float = EVEN) -> Model:
    """A model of ``labels`` (doc_id, toxic), learned outside the held-out fold.

    At most ``sample`` labelled documents are learned from, chosen by a hash of
    their ids. Spark counts their terms; the ``words`` whose presence tells most
    about the label (by the log-likelihood ratio) come to the driver with the
    identity terms, and the documents as lists of these.
    """
    kept = labels.where((fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("toxic").isin(0, 1))
    chosen = bounded_sample(kept.select("doc_id", F.col("toxic").cast("int").alias("label")), sample, F.col("doc_id"), F.col("label"))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text")
    found = checkpointed(texts.mapInArrow(_distinct_terms, "label int, words array<string>"))
    total = {bool(r["label"]): r["count"] for r in found.groupBy("label").count().collect()}
    toxic, clean = total.get(True, 0), total.get(False, 0)

    def told(here, of):  # x log x / expected, summed over presence and absence
        expected = (F.col("a") + F.col("b")) * (of / max(1, toxic + clean))
        missing = of - expected
        return F.when(here > 0, here * F.log(here / expected)).otherwise(0.0) + F.when(
            (here < of) & (missing > 0), (of - here) * F.log((of - here) / missing)
        ).otherwise(0.0)

    counts = (
        found.select("label", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum("label").cast("double").alias("a"), F.sum(1 - F.col("label")).cast("double").alias("b"))
        .where(F.col("a") + F.col("b") >= LEAST)
    )
    best = counts.orderBy(F.desc(told(F.col("a"), toxic) + told(F.col("b"), clean)), "word").limit(words).select("word")
    vocabulary = sorted({r["word"] for r in best.collect()} | {t for terms in IDENTITIES for t in terms})
    known = F.array(*(F.lit(w) for w in vocabulary))
    rows = found.select("label", F.array_intersect("words", known).alias("words")).collect()
    number = {w: i for i, w in enumerate(vocabulary)}
    return fitted([[number[w] for w in r["words"]] for r in rows], np.array([r["label"] for r in rows], np.float64), vocabulary, even)


def _score(model: Model, passing: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            scores = pa.array([model.score(x.as_py()) for x in texts], pa.float64())
            if passing is None:
                yield pa.RecordBatch.from_arrays([batch.column(0), scores], ["doc_id", "score"])
            else:
                yield batch.filter(pa.array([x < passing for x in scores.to_pylist()], pa.bool_()))

    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs``: the chance that its text is toxic.

    Only the words of the whole text count. NULL, empty and wordless texts get the
    model's base rate, as all texts do where no labels of both kinds were given;
    repeated rows and rows without an id are scored like others.
    """
    return docs.select("doc_id", "text").mapInArrow(_score(model, None), "doc_id long, score double")


def clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    return docs.mapInArrow(_score(model, threshold), docs.schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return scored(docs, train(docs, read(spark, sf_dir, "labels"))).select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
