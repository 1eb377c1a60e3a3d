import random
import re
import time

import numpy as np
import pytest

from tests.llm import brute
from voltdrift.llm import personal_data as d


@pytest.fixture(scope="module")
def docs():
    r = random.Random(6)
    parts = [
        "a.b@c.de", "a@b.c.d@e.f", "x@y", "a@b.c_d@e.f", "@@a@b.c", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1", "0001.02.3.255",
        "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", "41111111111111111", "+1 (017) 555-7713", "+1 23", "+49 171 1234567",
        "+1 (974) 555-3436 161.17.88.162", "++12345678", "+1 555 - - 12345 6", "(017) 555-7713", "mail", "call", "\U0001f600", "é", "\n", "word", "12",
    ]
    rows = [(i, " ".join(r.choices(parts, k=r.randrange(1, 12)))) for i in range(150)]
    rows += [(200, None), (201, ""), rows[0], (None, "id@less.org"), (202, "a" * 50_000), (203, "1" * 50_000), (204, "+" + "(" * 20_000)]
    return [*rows, (205, "a@b.c " * 400), (206, "1." * 20_000), (207, "a@" + "b." * 20_000)]


def test_stated_spans_match_brute_force(spark, docs):
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, spans string")
    found = d.personal_data(frame, "doc_id", "text").collect()
    got = sorted(repr((r.doc_id, [(d.KINDS[s.kind], s.start, s.end) for s in r.stated])) for r in found)
    order = {k: i for i, k in enumerate(d.KINDS)}
    assert got == sorted(repr((i, sorted(brute.base_spans(t), key=lambda s: (order[s[0]], s[1])))) for i, t in docs)
    for r in found:
        assert set(map(tuple, r.stated)) <= set(map(tuple, r.spans))
        assert all(0 <= s.start < s.end <= len(r.text) for s in r.spans)


def test_trees_add_what_looks_like_the_stated(spark):
    """A phone number that runs into an address has too many digits for the pattern."""
    texts = [f"call +1 ({i:03d}) 555-{i:04d} now" for i in range(60)] + ["call +1 (974) 555-3436 161.17.88.162 x"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    last = d.personal_data(frame, "doc_id").where("doc_id = 60").first()
    assert [tuple(s) for s in last.stated] == [(1, 23, 36)]
    assert (3, 5, 22) in {tuple(s) for s in last.spans}


def test_long_text_takes_linear_time(spark):
    """100,000 addresses in one text, and as many that are none."""
    good = [f"10.{i // 60_000}.{i // 250 % 240}.{i % 250}" for i in range(100_000)]
    texts = [(1, " ".join(good)), (2, " ".join(["999.1.2.3"] * 100_000)), (3, "+1 (017) 555-7713 " * 20_000)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    start = time.monotonic()
    rows = {r.doc_id: r for r in d.personal_data(frame, "doc_id", "text").collect()}
    assert time.monotonic() - start < 120
    at = 0
    for span, address in zip(rows[1].stated, good, strict=True):
        assert (d.KINDS[span.kind], span.start, span.end) == ("ip", at, at + len(address))
        at += len(address) + 1
    assert not rows[2].stated and len(rows[3].stated) == 20_000
    for r in rows.values():
        assert set(map(tuple, r.stated)) <= set(map(tuple, r.spans))


def test_selection_matches_all_pairs(spark):
    r = random.Random(3)
    model = d.Model([], 0.0, {g: 0.5 - 0.1 * (g % 2) for g in range(len(d.GENERATORS))})
    trees = [d.Tree(("marks", [0, 1]), [("digits", [2, 3]), None], [0.4, -0.3, 0.1, 0.1])]
    model = model._replace(trees=trees)
    names = list(d.FEATURES)
    rows = []
    for row in range(40):
        stated = {k: [] for k in d.KINDS}
        for k in d.KINDS:
            at = 0
            while r.random() < 0.6:
                start = at + r.randrange(1, 60)
                at = start + r.randrange(3, 30)
                stated[k].append((start, at))
        candidates = [(s, s + r.randrange(1, 200), *(r.randrange(d.FEATURES[f]) for f in names)) for s in (r.randrange(300) for _ in range(r.randrange(12)))]
        rows.append((row, tuple(stated[k] for k in d.KINDS), candidates))
    pair = "array<struct<start:int,end:int>>"
    schema = f"doc_id int, base struct<{','.join(f'{k}:{pair}' for k in d.KINDS)}>, candidates array<struct<start:int,end:int,{','.join(f'{f}:int' for f in names)}>>"
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in d.selected(d.checkpointed(spark.createDataFrame(rows, schema)), model).collect()}
    for row, base, candidates in rows:
        stated = [(n, *s) for n, spans in enumerate(base) for s in spans]
        likely = []
        for i, (start, end, *features) in enumerate(candidates):
            x = dict(zip(names, features, strict=True))
            margin = (0.4 if x["digits"] in (2, 3) else -0.3) if x["marks"] in (0, 1) else 0.1
            chance = 1 / (1 + np.exp(-margin))
            if chance >= model.thresholds[x["generator"]] and not any(start < e and s < end for _, s, e in stated):
                likely.append((chance, -i, start, end, d.KINDS.index(list(d.GENERATORS.values())[x["generator"]][0])))
        best = [c for c in likely if not any(o[:2] > c[:2] and c[2] < o[3] and o[2] < c[3] for o in likely)]
        assert found[row] == sorted(stated + [(c[4], c[2], c[3]) for c in best])


def test_boosting_separates_cells():
    r = np.random.default_rng(0)
    cells = np.unique(np.stack([r.integers(0, n, 400) for n in d.FEATURES.values()], axis=1), axis=0)
    good = (cells[:, 1] >= 3) ^ (cells[:, 5] == 1)
    counts = np.full(len(cells), 20.0)
    model = d.fitted(cells, counts, np.where(good, 20.0, 0.0))
    assert len(model.trees) > 5 and all(t < 1 for t in model.thresholds.values())


def test_redaction(spark):
    rows = [(1, "write a@b.org or +1 (017) 555-7713, é 1.2.3.4!"), (2, None), (3, ""), (4, "nothing")]
    found = dict(map(tuple, d.redacted(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert found == {1: "write [EMAIL] or [PHONE], é [IP]!", 2: None, 3: "", 4: "nothing"}


def test_nothing_and_no_python(spark, docs):
    empty = d.personal_data(spark.createDataFrame([], "doc_id long, text string"), "doc_id")
    assert empty.count() == 0
    frame = spark.createDataFrame(docs[:5], "doc_id long, text string")
    text = d.found_spans(frame, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|InPandas", text)
