import random

import numpy as np
import pytest

from tests.llm import brute
from voltdrift.llm import decontaminate as d


def test_suffix_array_sorts_suffixes():
    rng = np.random.default_rng(2)
    for n, top in ((0, 1), (1, 1), (400, 3), (400, 90), (300, 1)):
        tokens = rng.integers(1, top + 1, n)
        order = d.suffix_array(tokens, n)
        assert order.tolist() == sorted(range(n), key=lambda i: tokens[i:].tolist())


@pytest.fixture(scope="module")
def tables():
    r = random.Random(4)
    words = [f"W{i}" for i in range(40)] + ["café", "x1"]
    sentence = lambda n: " ".join(r.choices(words, k=n))
    items = [(i, sentence(r.choice([4, 9, 10, 11, 25, 60]))) for i in range(30)]
    items += [(30, items[3][1]), (31, None), (32, ""), (33, "?!"), (None, sentence(12)), (None, None), (5, sentence(14))]
    docs = []
    for i in range(80):
        parts = [sentence(r.randrange(1, 60)) for _ in range(3)]
        if i % 3 == 0:
            text = r.choice([t for _, t in items if t])
            cut = text.split()[r.randrange(3) :]
            parts.insert(1, ", ".join(cut).upper())
        docs.append((i, "\n".join(parts)))
    return [*docs, docs[0], (90, None), (91, ""), (None, docs[3][1]), (92, sentence(5000))], items


@pytest.mark.parametrize("shard, block", [(1 << 20, 4 << 20), (200, 300)])
def test_matches_brute_force(spark, tables, shard, block):
    docs, items = tables
    frame = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, n_hit int").repartition(3)
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    found = d.contamination(frame, benchmark, shard_words=shard, block_bytes=block).collect()
    got = sorted(repr((r.doc_id, r.n_words, r.n_hit, r.n_items, r.item_ids)) for r in found)
    expected = []
    for doc, n, hit, ids in brute.contamination(docs, items):
        expected.append(repr((doc, n, hit, len(ids), sorted(i[1] for i in ids if isinstance(i, tuple)))))
    assert got == sorted(expected)
    texts = dict(items[:31])
    whole = {i: brute.words_of(t) for i, t in docs if i is not None}
    for r in found:
        assert (r.longest_words > 0) == (r.n_hit > 0)
        if r.longest_item in texts and r.longest_item != 5 and r.doc_id is not None:
            piece = whole[r.doc_id][r.longest_start : r.longest_start + r.longest_words]
            assert " ".join(piece) in " ".join(brute.words_of(texts[r.longest_item]))
    clean = d.decontaminated(frame, benchmark, shard_words=shard)
    assert clean.columns == frame.columns
    assert sorted(repr(r[0]) for r in clean.collect()) == sorted(repr(x[0]) for x in brute.contamination(docs, items) if not x[2])


def test_nothing(spark, tables):
    docs = spark.createDataFrame(tables[0], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.contamination(docs, none).where("n_hit > 0").count() == 0
    assert d.contamination(docs.limit(0), none).count() == 0
