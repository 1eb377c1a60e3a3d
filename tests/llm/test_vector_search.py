import numpy as np
import pytest

from voltdrift.llm import vector_search as v


def expected(rows, every=50, k=5):
    fine = [(i, x) for i, x in rows if i is not None and x is not None and all(c is not None and np.isfinite(c) for c in x)]
    whole = [(i, [int(np.floor(256 * c)) for c in x]) for i, x in fine]
    out = []
    for i, q in {i: q for i, q in sorted(whole, reverse=True) if i % every == 0}.items():
        scores = sorted((-sum(a * b for a, b in zip(q, x, strict=True)), j) for j, x in whole if j != i and len(x) == len(q))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(5, 6))
    found = [(i, (centres[i % 5] + rng.normal(size=6) * 0.2).tolist()) for i in range(400)]
    found += [(1000 + i, [0.5] * 6) for i in range(150)]  # many ties
    found += [(2000, None), (2050, [float("nan")] * 6), (2001, [None] * 6), (2002, [float("inf")] * 6), (2003, []), (2100, [])]
    return [*found, (2150, [1.0, 2.0]), (2151, [3.0, 1.0]), (None, [9.0] * 6), found[3], found[50]]


@pytest.mark.parametrize("shard, block, page", [(8192, 8192, 96), (64, 3, 4)])
def test_matches_brute_force(spark, rows, shard, block, page):
    frame = spark.createDataFrame([(i, x, 0) for i, x in rows], "vec_id long, embedding array<double>, score int").repartition(3)
    found = v.top_k(frame, shard=shard, block=block, page=page)
    assert sorted(map(tuple, found.collect())) == expected(rows)


@pytest.mark.parametrize("large", [70_000.0, 1e6, -3e7, 1e12, 2.0**60, 1e40, 1e200, 1e305])
def test_large_components_take_part(spark, rows, large):
    """As candidates and as queries, beside and among ordinary vectors; a score that no long holds is the nearest long."""
    some = [*rows[:120], (3000, [large, 1.0, 0.3, 0.0, -2.0, 0.1]), (3001, [0.7, 0.0, 0.0, 0.0, 0.0, large / 3])]
    found = v.top_k(spark.createDataFrame(some, "vec_id long, embedding array<double>").repartition(2), shard=50, page=8)
    wide = [(q, rank, i, max(-(2**63), min(2**63 - 1, s))) for q, rank, i, s in expected(some)]
    if large < 1e12:
        assert sorted(map(tuple, found.collect())) == wide
    else:  # of scores that are cut, the smaller ids come first
        assert sorted((r.query_id, r.score) for r in found.collect()) == sorted((q, s) for q, _, _, s in wide)


def test_bounds_spare_pages():
    """Clustered vectors: a search opens few of the pages."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 8)) * 1000
    vectors = (np.repeat(centres, 50, axis=0) + rng.normal(size=(2000, 8))).astype(np.int64)
    tree = v.MTree(vectors, 40)
    opened = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            opened.append(key)
            return super().__getitem__(key)

    tree.vectors = vectors.view(Counting)
    best = tree.nearest(vectors[0], 5, np.arange(2000), -1)
    scores = sorted(((int(s), -i) for i, s in enumerate(vectors @ vectors[0])), reverse=True)[:5]
    assert best == [(s, -i) for s, i in scores]
    assert len(opened) < 15


def test_nothing(spark):
    assert v.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
