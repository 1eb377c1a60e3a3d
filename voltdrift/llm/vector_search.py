"""Exact top-k inner-product search: best-first over M-trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltdrift.llm.common import read

TOP = 5
EVERY = 50
SCALE = 256
PAGE = 96  # entries of a node
SHARD = 8_192  # vectors under one tree
BLOCK = 8_192  # queries broadcast at once
LARGEST = 1 << 24  # vectors with a component beyond go under trees of their own, so that others' bounds stay tight
FARTHEST = 1e300  # squares of distances beyond bound nothing
LONG = (1 << 63) - 1
EXACT = 1 << 62  # sums below are exact in 64 bits; others are taken in Python's integers


class Page(NamedTuple):
    """A node. Entry i is an object with its distance to the parent's routing object; of an inner
    node also a covering radius, which no object below i is further from i than, and a child."""

    objects: np.ndarray
    to_parent: np.ndarray
    radius: np.ndarray | None
    children: list | None


class MTree:
    """Integer vectors in a metric in which the nearest is the one with the largest inner product.

    Every vector gets one more coordinate that makes all norms equal (to the
    largest, R); a query gets 0 there. Then distance² = |q|² + R² - 2 q·x.
    """

    def __init__(self, vectors: np.ndarray, page: int = PAGE) -> None:
        self.vectors = vectors
        self.largest = _largest(vectors)
        norms = (_doubles(vectors) ** 2).sum(axis=1)
        self.square = float(norms.max(initial=0.0))
        if self.square > FARTHEST:  # no distances to go by: one page, and no bounds
            self.points = np.zeros((len(vectors), 1))
            self.root = Page(np.arange(len(vectors)), np.zeros(len(vectors)), None, None)
            return
        extra = np.sqrt(np.maximum(self.square - norms, 0))
        self.points = np.concatenate([_doubles(vectors), extra[:, None]], axis=1)
        self.page = page
        self.root = self._load(np.arange(len(vectors)), None)

    def _distances(self, some: np.ndarray, to: int) -> np.ndarray:
        return np.sqrt(((self.points[some] - self.points[to]) ** 2).sum(axis=1))

    def _load(self, some: np.ndarray, parent: int | None) -> Page:
        """Bulk loading: seeds spread over the objects; each object goes to the nearest seed's child."""
        to_parent = np.zeros(len(some)) if parent is None else self._distances(some, parent)
        if len(some) <= self.page:
            return Page(some, to_parent, None, None)
        count = min(self.page, -(-len(some) // (self.page // 2)))
        seeds = some[np.linspace(0, len(some) - 1, count).astype(np.int64)]
        squares = (self.points[some] ** 2).sum(axis=1)[:, None] - 2 * self.points[some] @ self.points[seeds].T
        nearest = (squares + (self.points[seeds] ** 2).sum(axis=1)).argmin(axis=1)
        members = [some[nearest == i] for i in range(count)]
        if max(map(len, members)) == len(some):  # equal objects: any split will do
            members = np.array_split(some, count)
        kept = [(int(s), m) for s, m in zip(seeds, members, strict=True) if len(m)]
        routes = np.array([s for s, _ in kept])
        radius = np.array([self._distances(m, s).max() for s, m in kept])
        to_parent = np.zeros(len(kept)) if parent is None else self._distances(routes, parent)
        return Page(routes, to_parent, radius, [self._load(m, s) for s, m in kept])

    def nearest(self, query: np.ndarray, k: int, ids: np.ndarray, own: int) -> list[tuple[int, int]]:
        """The k objects (score, id) with the largest inner products, ties to smaller ids, without id ``own``."""
        vectors = self.vectors
        if self.largest * _largest(query) * max(1, len(query)) >= EXACT:
            vectors, query = vectors.astype(object), query.astype(object)
        plain = _doubles(query)
        norm = float((plain * plain).sum())
        bounded = max(norm, self.square) <= FARTHEST
        slack = 1e-7 * (norm + self.square + 1) ** 0.5  # of rounding in distances
        wanted = np.concatenate([plain, [0.0]])
        best: list[tuple[int, int]] = []  # heap of (score, -id)
        limit = np.inf  # objects further than this cannot be among the best
        heap: list[tuple[float, int, Page, float | None]] = [(0.0, 0, self.root, None)]
        pushed = 0
        while heap:
            bound, _, page, above = heapq.heappop(heap)
            if bound > limit:
                break
            objects, radius = page.objects, page.radius
            if above is None or not np.isfinite(limit):
                pick = None
            else:  # the stored distance to the parent bounds the distance that is not known yet
                least = np.abs(above - page.to_parent) - (0 if radius is None else radius)
                pick = np.nonzero(least <= limit + slack)[0]
                objects = objects[pick]
            if not len(objects):
                continue
            if radius is None:
                scores = vectors[objects] @ query
                rows = np.arange(len(scores))
                if len(best) == k:
                    rows = np.nonzero(scores >= best[0][0])[0]
                for score, name in zip(scores[rows].tolist(), ids[objects[rows]].tolist(), strict=True):
                    if name == own:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (score, -name))
                    elif (score, -name) > best[0]:
                        heapq.heapreplace(best, (score, -name))
                if len(best) == k and bounded:
                    limit = max(0.0, norm + self.square - 2 * best[0][0]) ** 0.5 + slack
            else:
                distance = np.sqrt(np.maximum(((self.points[objects] - wanted) ** 2).sum(axis=1), 0))
                reach = np.maximum(distance - (radius if pick is None else radius[pick]) - slack, 0)
                where = range(len(objects)) if pick is None else pick.tolist()
                for i, d, r in zip(where, distance.tolist(), reach.tolist(), strict=True):
                    if r <= limit:
                        pushed += 1
                        heapq.heappush(heap, (r, pushed, page.children[i], d))
        return [(score, -name) for score, name in sorted(best, reverse=True)]


def _doubles(vectors: np.ndarray) -> np.ndarray:
    """The vectors as doubles whose squares can be summed up."""
    if vectors.dtype == object:
        most = int(1e152)
        vectors = np.minimum(np.maximum(vectors, -most), most)
    return vectors.astype(np.float64)


def _largest(vectors: np.ndarray) -> int:
    return max(int(vectors.max(initial=0)), -int(vectors.min(initial=0)))


def _integers(scaled: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles, as 64-bit integers, or Python's where these do not hold them."""
    with np.errstate(over="ignore"):
        large = np.abs(scaled) >= 2.0**53 / scale
    if not large.any():
        return np.floor(scaled * scale).astype(np.int64)
    # doubles this large are whole once they are scaled, so scaling may come after
    exact = [int(x * scale) if abs(x) < 2.0**900 else int(x) * scale for x in scaled[large].tolist()]
    found = np.empty(scaled.shape, object)
    found[~large] = [int(x) for x in np.floor(scaled[~large] * scale)]
    found[large] = exact
    return found


def _vectors(batch: pa.RecordBatch, scale: int) -> dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]]:
    """(ids, integer vectors) of the rows, by length of the vector and whether one of its components is large."""
    rows = batch.column(1)
    sizes = rows.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    names = batch.column(0).to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    found = {}
    for size in np.unique(sizes).tolist():
        which = np.nonzero(sizes == size)[0]
        each = values[starts[which][:, None] + np.arange(size)]
        large = (np.abs(each) > LARGEST / scale).any(axis=1)
        for kind in (False, True):
            if (large == kind).any():
                found[size, kind] = names[which[large == kind]], _integers(each[large == kind], scale)
    return found


def _search(block, k: int, shard: int, page: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: dict[int, tuple[np.ndarray, np.ndarray]] = block.value
        waiting: dict[tuple[int, bool], list[tuple[np.ndarray, np.ndarray]]] = {}

        def answered(key: tuple[int, bool]) -> Iterator[pa.RecordBatch]:
            parts, size = waiting.pop(key), key[0]
            ids, vectors = np.concatenate([i for i, _ in parts]), np.concatenate([v for _, v in parts])
            if size not in queries:
                return
            for at in range(0, len(ids), shard):
                names = ids[at : at + shard]
                tree = MTree(vectors[at : at + shard], page)
                rows = [
                    (int(q), name, max(-LONG - 1, min(LONG, score)))
                    for q, vector in zip(*queries[size], strict=True)
                    for score, name in tree.nearest(vector, k, names, int(q))
                ]
                columns = zip(*rows, strict=True) if rows else [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

        for batch in batches:
            for key, part in _vectors(batch, scale).items():
                waiting.setdefault(key, []).append(part)
                if sum(len(i) for i, _ in waiting[key]) >= shard:
                    yield from answered(key)
        for key in list(waiting):
            yield from answered(key)

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part, with components as doubles."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & fine).select(
        F.col("vec_id").cast("long"), F.transform("embedding", lambda x: x.cast("double")).alias("vector")
    )


def top_k(vectors: DataFrame, every: int = EVERY, k: int = TOP, scale: int = SCALE, shard: int = SHARD, block: int = BLOCK, page: int = PAGE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` (vec_id, embedding) whose id is
    divisible by ``every``, the ``k`` others with the largest integer inner product.

    Tasks put what they read under M-trees of ``shard`` vectors. The queries, the
    stated set, are broadcast in blocks of ``block``; what each tree finds best is
    cut to ``k`` a query in the task before rows meet by query. Ties go to smaller
    ids. Components become floor(``scale`` * x), x as double, however large; scores
    are exact, and one that a long cannot hold is given as the nearest long. Rows
    without an id, and vectors that are NULL or hold a NULL or non-finite component,
    take no part. Only vectors of equal length are compared. A row that repeats an id counts as a
    candidate of its own, but rows with the query's id are its own; a repeated
    query is asked once, with the least of its vectors.
    """
    whole = usable(vectors)
    stated = whole.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    context = vectors.sparkSession.sparkContext
    results, some = [], []

    def ask() -> None:
        by_size: dict[int, list] = {}
        for name, vector in some:
            values = _integers(np.array(vector, np.float64), scale)
            by_size.setdefault(len(vector), []).append((name, values))
        sent = context.broadcast({size: ([n for n, _ in rows], [v for _, v in rows]) for size, rows in by_size.items()})
        results.append(whole.mapInArrow(_search(sent, k, shard, page, scale), "query_id long, vec_id long, score long"))
        some.clear()

    for name, vector in stated.toLocalIterator():
        some.append((name, vector))
        if len(some) == block:
            ask()
    if some or not results:
        ask()
    found = results[0]
    for more in results[1:]:
        found = found.union(more)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )


def op7_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"))
