"""Benchmark decontamination with suffix arrays over shards of the training documents."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltdrift.llm.common import checkpointed, read

WINDOW = 10
SHARD_WORDS = 1 << 20  # words under one suffix array; a longer document has one to itself
BLOCK_BYTES = 4 << 20  # benchmark text broadcast at once
_CHARS = b"0123456789abcdefghijklmnopqrstuvwxyz"
_WORDS = bytes(x if x >= 128 or x in _CHARS else x + 32 if 65 <= x <= 90 else 32 for x in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def suffix_array(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Positions of all suffixes in the order of their first ``depth`` tokens, at least.

    As many tokens as fit a 64-bit key are sorted at once; then ties, and only
    these, are sorted by the rank of what follows, which doubles the depth.
    """
    n = len(tokens)
    bits = max(1, int(tokens.max(initial=0)).bit_length())
    step = max(1, 64 // bits)
    padded = np.concatenate([tokens, np.zeros(step, tokens.dtype)]).astype(np.uint64)
    key = padded[:n]
    for i in range(1, step):
        key = (key << np.uint64(bits)) | padded[i : i + n]
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]]) if n else np.zeros(0, bool)
    del key, padded
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0)) if n else np.zeros(0, np.int64)
    rank = np.empty(n, np.int64)
    rank[order] = first
    while step < depth:
        alone = new & np.concatenate([new[1:], [True]])
        tied = np.nonzero(~alone)[0]
        if not len(tied):
            break
        suffixes = order[tied]
        after = suffixes + step
        follow = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        group = rank[suffixes]
        key = group * (n + 1) + follow
        sort = np.argsort(key)
        key, suffixes = key[sort], suffixes[sort]
        order[tied] = suffixes
        new[tied] = np.concatenate([[True], key[1:] != key[:-1]])
        rank[suffixes] = np.maximum.accumulate(np.where(new[tied], tied, 0))
        step *= 2
    return order


class Block:
    """Some benchmark items: their words, numbered, one item after another."""

    def __init__(self, items: list[tuple[int | None, str | None]]) -> None:
        vocabulary: dict[bytes, int] = {}
        self.ids: list[int | None] = []
        tokens: list[int] = []
        starts = [0]
        for item, text in items:
            if words := words_of(text):
                self.ids.append(item)
                tokens += [vocabulary.setdefault(w, len(vocabulary)) for w in words]
                starts.append(len(tokens))
        self.vocabulary = list(vocabulary)
        self.tokens = np.array(tokens, np.int64)
        self.starts = np.array(starts, np.int64)
        self.longest = int(np.diff(self.starts).max(initial=0))


def _bound(padded: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, at: int, word: np.ndarray, above: bool) -> np.ndarray:
    """Binary search in each interval [low, high) for the first suffix whose token ``at`` is not below (or is above) ``word``."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        token = padded[order[np.where(open_, middle, 0)] + at]
        right = open_ & ((token <= word) if above else (token < word))
        low = np.where(right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)
    return low


class Shard:
    """Whole documents under one suffix array, and what of a benchmark block occurs in them."""

    def __init__(self, texts: list[list[bytes]], depth: int) -> None:
        numbers = count(1)
        self.vocabulary: dict[bytes, int] = {}
        known = self.vocabulary
        self.lengths = np.array([len(x) for x in texts], np.int64)
        self.starts = np.cumsum(self.lengths + 1) - (self.lengths + 1)
        self.tokens = np.zeros(int((self.lengths + 1).sum()), np.int64)  # 0 closes a document
        for start, words in zip(self.starts.tolist(), texts, strict=True):
            for w in set(words).difference(known):
                known[w] = next(numbers)
            self.tokens[start : start + len(words)] = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        self.order = suffix_array(self.tokens, depth)

    def search(self, block: Block, window: int) -> tuple[np.ndarray, ...]:
        """Follow every suffix of every item down the suffix array.

        Intervals of suffixes that start with a window (its first position in the
        item list, its length, low, high), and each item suffix's longest match
        (its position, the depth, low, high).
        """
        numbers = np.array([self.vocabulary.get(w, -1) for w in block.vocabulary] or [-1], np.int64)
        test = numbers[block.tokens] if len(block.tokens) else block.tokens
        sizes = np.diff(block.starts)
        item = np.repeat(np.arange(len(sizes)), sizes)
        ends = block.starts[1:][item]
        needed = np.minimum(window, sizes[item])
        padded = np.concatenate([self.tokens, np.zeros(block.longest + 1, np.int64)])
        at = np.nonzero(test > 0)[0] if len(self.order) else np.zeros(0, np.int64)
        low, high = np.zeros(len(at), np.int64), np.full(len(at), len(self.order))
        depth, windows, longest = 0, [], []
        while len(at):
            word = test[at + depth]
            start = _bound(padded, self.order, low, high, depth, word, above=False)
            stop = _bound(padded, self.order, start, high, depth, word, above=True)
            found = start < stop
            if depth:
                gone = ~found
                longest.append((at[gone], np.full(gone.sum(), depth), low[gone], high[gone]))
            at, low, high = at[found], start[found], stop[found]
            depth += 1
            whole = needed[at] == depth
            windows.append((at[whole], needed[at][whole], low[whole], high[whole]))
            more = at + depth < ends[at]
            longest.append((at[~more], np.full((~more).sum(), depth), low[~more], high[~more]))
            at, low, high = at[more], low[more], high[more]
            present = test[at + depth] > 0
            longest.append((at[~present], np.full((~present).sum(), depth), low[~present], high[~present]))
            at, low, high = at[present], low[present], high[present]
        empty = [np.zeros(0, np.int64)] * 4
        return tuple(np.concatenate(x) for x in zip(empty, *windows, strict=True)), tuple(
            np.concatenate(x) for x in zip(empty, *longest, strict=True)
        )

    def places(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which interval, position in the shard) of every suffix in the intervals."""
        sizes = high - low
        which = np.repeat(np.arange(len(sizes)), sizes)
        return which, self.order[np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which]]


REPORT = (
    "doc_id long, n_words long, n_hit long, item_ids array<long>, n_items long, longest_words long, longest_start long, longest_item long"
)


def _report(shard: Shard, blocks: list[Block], window: int) -> dict[str, list]:
    docs = len(shard.lengths)
    hit = np.zeros(len(shard.tokens) + 1, np.int64)
    items: list[set] = [set() for _ in range(docs)]
    best = np.zeros((docs, 3), np.int64) - np.array([0, 1, 1])
    names: list[int | None] = []
    for number, block in enumerate(blocks):
        (at, size, low, high), (end_at, depth, end_low, end_high) = shard.search(block, window)
        item = np.searchsorted(block.starts, at, "right") - 1
        which, place = shard.places(low, high)
        hit += np.bincount(place, minlength=len(hit)) - np.bincount(place + size[which], minlength=len(hit))
        doc = np.searchsorted(shard.starts, place, "right") - 1
        for d, i in np.unique(np.stack([doc, item[which]]), axis=1).T.tolist():
            items[d].add((number, i) if block.ids[i] is None else block.ids[i])
        item = np.searchsorted(block.starts, end_at, "right") - 1
        long = depth >= np.minimum(window, np.diff(block.starts)[item])
        which, place = shard.places(end_low[long], end_high[long])
        doc, depth, item = np.searchsorted(shard.starts, place, "right") - 1, depth[long][which], item[long][which]
        order = np.lexsort((item, place, -depth, doc))
        first = order[np.unique(doc[order], return_index=True)[1]]
        better = first[depth[first] > best[doc[first], 0]]
        best[doc[better]] = np.stack([depth[better], place[better] - shard.starts[doc[better]], item[better] + len(names)], axis=1)
        names += block.ids
    inside = np.cumsum(hit)[:-1] > 0
    n_hit = np.concatenate([[0], np.cumsum(inside)])
    n_hit = n_hit[shard.starts + shard.lengths] - n_hit[shard.starts]
    return {
        "n_words": shard.lengths.tolist(),
        "n_hit": n_hit.tolist(),
        "item_ids": [sorted(x for x in found if not isinstance(x, tuple)) for found in items],
        "n_items": [len(found) for found in items],
        "longest_words": best[:, 0].tolist(),
        "longest_start": [x if n else None for n, x in best[:, :2].tolist()],
        "longest_item": [names[x] if n else None for n, x in best[:, [0, 2]].tolist()],
    }


def _scan(blocks: list, window: int, shard_words: int, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [b.value for b in blocks]
        depth = max((b.longest for b in items), default=0)
        schema = pa.schema(
            [(c, pa.list_(pa.int64()) if c == "item_ids" else pa.int64()) for c in (x.split()[0] for x in REPORT.split(", "))]
        )

        def scanned(texts: list[list[bytes]], rows: pa.RecordBatch) -> pa.RecordBatch:
            found = _report(Shard(texts, depth), items, window)
            if keep:
                return rows.filter(pa.array([not x for x in found["n_hit"]], pa.bool_()))
            arrays = [rows.column("doc_id"), *(pa.array(found[f.name], f.type) for f in schema if f.name != "doc_id")]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            texts, size, start = [], 0, 0
            for i, text in enumerate(batch.column(batch.schema.get_field_index("text"))):
                words = words_of(text.as_py())
                if texts and size + len(words) > shard_words:
                    yield scanned(texts, batch.slice(start, i - start))
                    texts, size, start = [], 0, i
                texts.append(words)
                size += len(words)
            if texts:
                yield scanned(texts, batch.slice(start))

    return run


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list]:
    """Broadcast blocks of the benchmark, the stated set of test texts, of at most ``block_bytes`` and one item."""
    context = benchmark.sparkSession.sparkContext
    some, size = [], 0
    for item, text in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        if some and size + len(text or "") > block_bytes:
            yield context.broadcast(Block(some))
            some, size = [], 0
        some.append((item, text))
        size += len(text or "")
    yield context.broadcast(Block(some))


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """What of ``benchmark`` (item_id, text) each row of ``docs`` (doc_id, text) holds verbatim.

    Words are runs of ASCII letters (lower-cased), digits and characters beyond
    ASCII. Tasks put their documents under suffix arrays of ``shard_words`` words
    and binary-search every suffix of every item in each; there is no shuffle,
    and a passage that many documents share is one interval of an array. Hit
    words are those inside an occurrence of ``window`` consecutive item words, or
    of a whole shorter item. longest_words, longest_start and longest_item give
    the longest match (the first, of the item listed first, where several are as
    long) and are 0, NULL, NULL without a hit. item_ids are distinct and sorted;
    an item without an id counts in n_items only. NULL and empty texts have no
    words; repeated rows and rows without an id are reported like others; other
    columns are not looked at; an empty benchmark hits nothing.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _scan(list(_blocks(benchmark, block_bytes)), window, shard_words, keep=False), REPORT
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns; see :func:`contamination`."""
    return docs.mapInArrow(_scan(list(_blocks(benchmark, BLOCK_BYTES)), window, shard_words, keep=True), docs.schema)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("item_ids", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
