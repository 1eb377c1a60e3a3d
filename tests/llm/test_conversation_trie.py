import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from voltdrift.llm import conversation_trie as t

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def in_order(rows):
    """The turns (role, text) of each conversation; ties as the operator has them must not occur."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    return {conv: [x for _, x in sorted(turns, key=lambda x: x[0])] for conv, turns in found.items()}


def rebuild(turns):
    found = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 4
        found[conv] = turns.get(conv - conv % 20, [])[:h] + own[h:]
    return found


def brute(turns):
    members = defaultdict(set)
    for conv, steps in turns.items():
        for d in range(len(steps) + 1):
            members[tuple(steps[:d])].add(conv)
    below = defaultdict(list)
    for prefix in members:
        for d in range(len(prefix) + 1):
            below[prefix[:d]].append(prefix)
    children = defaultdict(int)
    for prefix in members:
        if prefix:
            children[prefix[:-1]] += 1
    found = []
    for prefix, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(turns[c]) == len(prefix))))
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below[prefix] if p)
        found.append((
            min(who), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(who), children[prefix],
            sum(not children[p] for p in below[prefix]), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(map(repr, found))


def rows_of(frame):
    return sorted(repr(tuple(r)) for r in frame.select(COLUMNS).collect())


def random_rows(seed, conversations=120, most=9):
    r = random.Random(seed)
    found = []
    for conv in range(conversations):
        numbers = r.sample([None, *range(2 * most)], r.randrange(1, most))
        found += [(conv * 3 % 100 if conv % 7 else None, n, r.choice(["user", "assistant", None]), r.choice(["a b", "c", "", None, " x  y\tz "])) for n in numbers]
    seen, unique = set(), []
    for row in found:
        if row[:2] not in seen:
            seen.add(row[:2])
            unique.append(row)
    return unique


SCHEMA = "conv_id long, turn long, role string, text string, words string, copies int"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*x, "clash", 7) for x in rows], SCHEMA).repartition(partitions)


def test_two_fattest():
    for low in range(40):
        for high in range(low + 1, 41):
            best = max(range(low + 1, high + 1), key=lambda n: n & -n)
            assert t.two_fattest(low, high) == best


@pytest.mark.parametrize("batch", [1, 7, 1000])
def test_local_trie_holds_every_prefix(batch):
    r = random.Random(batch)
    for _ in range(60):
        start = r.choice([0, 0, 5])
        texts = [[r.randrange(2) for _ in range(r.choice([0, 1, 3, 20, 40]))] for _ in range(r.randrange(1, 30))]
        texts += [x[: r.randrange(len(x) + 1)] + [r.randrange(2)] for x in texts]
        sequences, expected = [], defaultdict(list)
        for conv, text in enumerate(texts):
            value, prefixes = t.EMPTY, [t.as_prefix(t.EMPTY)]
            expected[start, prefixes[0]].append(conv)
            for n, x in enumerate(text):
                value = t.extended(value, x, -x)
                prefixes.append(t.as_prefix(value))
                expected[start + n + 1, prefixes[-1]].append(conv)
            sequences.append(t.Sequence(conv, start, prefixes, text))
        trie = t.ZFastTrie()
        for at in range(0, len(sequences), batch):
            trie.insert_batch(sequences[at : at + batch])
        rows = list(trie.expanded())
        assert len(rows) == len({x[1] for x in rows})
        assert {(d, p): (n, least) for d, p, _, _, n, least in rows} == {k: (len(v), min(v)) for k, v in expected.items() if k[0] > start or not start}
        for sequence in sequences:
            node = trie.exit_node(sequence)
            assert node.sequence.at(sequence.end) == sequence.prefixes[-1] and node.low <= sequence.end <= node.high
        for handle, node in trie.handles.items():
            assert handle == node.handle() and node.parent.children[node.sequence.at(node.low + 1)] is node


@pytest.mark.parametrize("shard, layer, partitions", [(10_000, 1024, 2), (20, 3, 30), (7, 1, 5)])
def test_nodes_match_brute_force(spark, shard, layer, partitions):
    rows = random_rows(shard) + [(1000 + c, n, "user", f"{n % 5} long") for c in range(3) for n in range(60 + c)]
    rows += [(c, n, "user", "same") for c in range(2000, 2040) for n in range(4)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        symbols = t.written(t.symbols_of(frame(spark, rows)))
        assert rows_of(t.nodes(symbols, shard, layer)) == brute(in_order(rows))
        assert rows_of(t.nodes(t.rebuilt(symbols), shard, layer, batch=3)) == brute(rebuild(in_order(rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_equal_turns_at_a_place_all_count(spark):
    rows = [(20, 1, "user", "one two")] * 6 + [(40, None, "user", "one two")] * 5 + [(59, 1, "x", None)] * 2 + [(59, 2, "x", "long " * 30000)]
    found = t.nodes(t.rebuilt(t.symbols_of(frame(spark, rows))))
    assert rows_of(found) == brute(rebuild(in_order(rows)))


def test_query_over_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(t.op13_conversation_trie(spark, "/root/testdata/sf0.01")) == brute(rebuild(in_order(rows)))


def test_nothing(spark):
    assert t.conversation_trie(frame(spark, [])).count() == 0
    assert t.conversation_trie(frame(spark, [(None, 1, "user", "no id")])).count() == 0
