import random

import pytest

from tests.llm import brute
from voltdrift.llm import simhash_dedup as s


def test_tree_finds_what_a_scan_finds():
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(20)]
    values = {b ^ sum(1 << r.randrange(64) for _ in range(r.randrange(6))) & ((1 << 64) - 1) for b in base for _ in range(20)}
    tree = s.BKTree()
    for v in values:
        tree.add(v)
    for v in list(values)[:80]:
        for radius in (0, 2, 5):
            found = {tree.values[i] for i in tree.within(v, radius)}
            assert found == {x for x in values if (x ^ v).bit_count() <= radius}


@pytest.fixture(scope="module")
def docs():
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [" ".join(r.choices(vocabulary, k=r.randrange(3, 120))) for _ in range(60)]
    for text in texts[:12]:
        for _ in range(6):
            words = text.split()
            words[r.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    texts += texts[:5] + [None, "", " \t\n", "one", "ONE", "One two", "éÉ x y z", "Z" * 5000, "word " * 4000]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[3], (None, texts[0]), (None, None), (None, "only without an id here")]


@pytest.mark.parametrize("shard", [2, 20_000])
def test_matches_brute_force(spark, docs, shard):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, fp string, component_id int")
    found = s.near_duplicates(frame, shard_size=shard)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, brute.near_duplicates(docs)))


def test_one_of_each_group_stays(spark, docs):
    frame = spark.createDataFrame([(i, t, "a") for i, t in docs], "doc_id long, text string, extra string")
    kept = s.keep_first(frame)
    assert kept.columns == frame.columns
    expected = [i for i, _, c in brute.near_duplicates(docs) if i is None or i == c]
    assert sorted(map(repr, (r[0] for r in kept.collect()))) == sorted(map(repr, expected))


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    rows = [(1, "one text of its own here"), (2, "one text of its own here"), (2, "and another that nobody else has"), (None, "one text of its own here")]
    kept = s.keep_first(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, [rows[0], rows[2], rows[3]]))


def test_nothing(spark):
    assert s.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
