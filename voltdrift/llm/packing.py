"""Packing documents into sequences: first-fit decreasing over a tournament tree."""

from __future__ import annotations

import os
import random
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltdrift.llm.common import checkpointed, read

VOCABULARY = "word_bpe_49k.json"
LENGTH = 4096
END = 2  # id that closes a document
GROUP = 4_000  # pieces packed together, on average
CACHE = 600_000  # words whose ids a worker keeps
TOGETHER = 1_000  # new words encoded in one call
MARK = "\ue000"  # stands between them
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\r", b"abcdefghijklmnopqrstuvwxyz   ")


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordIds:
    """Token ids by space-separated word, as little-endian bytes.

    The vocabulary's pre-tokens never cross white space and are lower-cased, so
    the ids of a text are those of its words one after another, and ASCII letters
    can be lower-cased before. Where a text may hold the name of a special token,
    which counts only as written, it is encoded as it is.
    """

    def __init__(self, path: str, cache: int = CACHE) -> None:
        self.path, self.cache, self.known = path, cache, {b"": b""}
        self.mark = self.encode([MARK])[0]

    def encode(self, texts: list[str]) -> list[bytes]:
        found = _tokenizer(self.path).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def learn(self, words: set[bytes]) -> None:
        new = list(words)
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            self.known.update(zip(some, self._together([x.decode("utf-8", "surrogatepass") for x in some]), strict=True))

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of each word, from one text in which a mark stands between any two.

        Making one result a word takes longer than the ids. Where a word holds the
        mark's own ids, each is encoded by itself.
        """
        ids = np.frombuffer(self.encode([f" {MARK} ".join(words)])[0], "<u4")
        mark = np.frombuffer(self.mark, "<u4")
        n = len(mark)
        here = np.nonzero(ids[: len(ids) - n + 1] == mark[0])[0] if len(ids) >= n else np.empty(0, int)
        for k in range(1, n):
            here = here[ids[here + k] == mark[k]]
        if len(here) != len(words) - 1:
            return self.encode(words)
        raw = ids.tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip([0, *(here + n).tolist()], [*here.tolist(), len(ids)], strict=True)]

    def of(self, text: str) -> bytes:
        raw = text.encode("utf-8", "surrogatepass")
        if b"<|" in raw:
            return self.encode([text])[0]
        words = raw.translate(_FOLD).split(b" ")
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            here = set(words)
            new = here.difference(self.known)
            if len(self.known) + len(new) > self.cache:
                # all words of a text are known at once, however many they are
                self.known = {b"": b""}
                new = here - {b""}
            self.learn(new)
            return b"".join(map(self.known.__getitem__, words))


@lru_cache(maxsize=4)
def _word_ids(path: str, cache: int) -> WordIds:
    """One cache for all tasks of a worker."""
    return WordIds(path, cache)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, place double"


def _cut(path: str, length: int, end: int, cache: int):
    closing = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids = _word_ids(path, cache)
        place = random.Random(TaskContext.get().partitionId())
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = ids.of(text.as_py() or "") + closing
                n = len(tokens) // 4
                for start in range(0, n, length):
                    piece = tokens[4 * start : 4 * (start + length)]
                    rows.append((doc, start, len(piece) // 4, zlib.crc32(piece), n, place.random()))
            columns = zip(*rows, strict=True) if rows else [[] for _ in range(6)]
            kinds = [pa.int64()] * 5 + [pa.float64()]
            arrays = [pa.array(list(x), kind) for x, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "place"])

    return run


class Bins:
    """Bins in opening order under a tournament tree: every inner node holds the largest capacity below it."""

    def __init__(self, most: int, capacity: int) -> None:
        self.size = 1 << max(0, most - 1).bit_length()
        self.tree = [capacity] * (2 * self.size)

    def put(self, length: int) -> int:
        """Place an item in the first bin with room for it; the bin."""
        tree, at = self.tree, 1
        while at < self.size:
            at *= 2
            if tree[at] < length:
                at += 1
        place = at - self.size
        tree[at] -= length
        while at > 1:
            at //= 2
            tree[at] = max(tree[2 * at], tree[2 * at + 1])
        return place


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[int]:
    """The bin of each item; items are placed longest first, ties in the order given."""
    bins = Bins(len(lengths), capacity)
    found = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found[i] = bins.put(lengths[i])
    return found


PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack(capacity: int):
    def run(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["length", "place"], ascending=[False, True], ignore_index=True)
        pieces["sequence_id"] = (int(key[0]) << 32) + np.array(first_fit_decreasing(pieces["length"].tolist(), capacity), np.int64)
        pieces["offset"] = pieces.groupby("sequence_id")["length"].cumsum() - pieces["length"]
        return pieces[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    return run


def packed(
    docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH, end: int = END, group_size: int = GROUP, cache: int = CACHE
) -> DataFrame:
    """Each piece of each row of ``docs`` (doc_id, text), with its sequence and place in it.

    A row is cut every ``length`` ids, so only its last piece can be shorter. The
    pieces, without their ids, are dealt at random over groups of ``group_size`` on
    average, whatever their ids, so no group grows with a hot key; each group is
    packed on its own. A NULL or empty text is the closing id alone; repeated
    rows and rows without an id are packed like others; other columns are not
    looked at; no rows give no sequence. ``vocabulary`` is the tokenizer file's
    path on the executors.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path(VOCABULARY)
    pieces = checkpointed(docs.select("doc_id", "text").mapInArrow(_cut(vocabulary, length, end, cache), PIECES))
    groups = max(1, -(-pieces.count() // group_size))
    return (
        pieces.withColumn("pack", F.floor(F.col("place") * groups))
        .groupBy("pack")
        .applyInPandas(_pack(length), PACKED)
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"))
