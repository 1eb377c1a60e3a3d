import random

from tests.llm.brute import Groups
from voltdrift.llm.components import connected


def test_components_match_union_find(spark):
    r = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    edges = chain + star + [(r.randrange(1000, 1100), r.randrange(1000, 1100)) for _ in range(70)] + [(7, 7), (8, None), (3, 2), (2, 3)]
    groups = Groups({x for e in edges for x in e if None not in e and e[0] != e[1]})
    for a, b in edges:
        if None not in (a, b) and a != b:
            groups.unite(a, b)
    found = connected(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == sorted((n, groups.root(n)) for n in groups.parent)


def test_no_edges(spark):
    found = connected(spark.createDataFrame([], "a long, b long"))
    assert found.columns == ["node", "label"] and found.count() == 0
