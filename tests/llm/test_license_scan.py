import random
import re

import pytest

from voltdrift.llm import license_scan as l
from voltdrift.llm.common import read
from voltdrift.llm.license_scan import op12_license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEXTS = [
    None, "", "...", "CC-BY", "cc by cc by", "xcc by cc\nby", "cc by", "é CC  By \U0001f600 all rights reserved all rights reserved",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
    "SPDX-License-Identifier: GPL-2.0-or-later", "under the Apache License, Version 2.0; apache license", "ccby general public licenses",
    "Tous droits réservés. Urheberrechtlich geschützt", "cc by " * 20000, "license " * 30000, "cc" + " " * 50000 + "by",
]


def base(text):
    words = WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        wanted = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
        places += found
        labels |= {label} if found else set()
    ends = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), *ends, ",".join(sorted(labels))


def plain(text):
    """Every rule on the whole text, without the filter; every detection against every other."""
    raw = (text or "").encode().lower()
    found = [x for n in range(len(l.rules())) for x in l.matches(raw, n)]

    def better(x, y):
        return (x.tier, x.start - x.end, x.rule) < (y.tier, y.start - y.end, y.rule)

    return {x for x in found if not any(y.start <= x.start and x.end <= y.end and better(y, x) for y in found)}


def test_hundreds_of_rules_each_with_a_keyword_of_all_its_matches():
    assert len(l.rules()) > 400
    for rule in l.rules():
        assert rule.keyword == "spdx" or re.search(rf"(^|[^a-z0-9]){rule.keyword}", rule.pattern.pattern.decode("latin-1")), rule
        outside = re.sub(r"\((?:[^()]|\([^()]*\))*\)\?", "", rule.pattern.pattern.decode("latin-1"))
        assert rule.keyword in outside, rule


@pytest.mark.parametrize("text", [t for t in TEXTS if len(t or "") < 10_000])
def test_filter_and_one_pass_suppression_lose_nothing(text):
    assert {x for x, stands in l.detections((text or "").encode().lower()) if stands} == plain(text)


def test_suppression_matches_all_pairs():
    r = random.Random(4)
    for _ in range(300):
        found = []
        for rule in range(r.randrange(12)):
            start = r.randrange(8)
            found.append(l.Detection(start, start + r.randrange(1, 8), r.randrange(4), rule))
        found.sort(key=lambda x: (x.tier, x.rule))
        found = [x._replace(rule=n) for n, x in enumerate(found)]
        found.sort(key=lambda x: (x.start, -x.end, x.rule))
        expected = []
        for x in found:
            holds = [y for y in found if y.start <= x.start and x.end <= y.end and y != x]
            expected.append(any((y.tier, y.start - y.end, y.rule) < (x.tier, x.start - x.end, x.rule) for y in holds))
        assert l.suppressed(found) == expected


def test_named_licences():
    def labels(text):
        return sorted(l.rules()[x.rule].label for x, stands in l.detections(text.encode().lower()) if stands)

    assert labels("Released under the MIT License.") == ["licensed", "mit"]
    assert labels("Licensed under CC BY-NC 4.0.") == ["cc-by-nc-4.0", "licensed"]
    assert labels("the GNU Lesser General Public License v2.1, that is LGPL") == ["lgpl", "lgpl-2.1"]
    assert labels("limited permission, admit, gplx, sublicensed") == []


def test_rows_of_all_kinds(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x"), (None, "GPL", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, detections string").repartition(3)
    found = l.scanned(docs).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(rows) and sum(r.doc_id == 3 for r in found) == 2
    assert [x.label for x in by_id[None].detections] == ["gpl"] and by_id[0].detections == [] and by_id[0].score == 0
    for i, text in enumerate(TEXTS):
        for x in by_id[i].detections:
            assert 0 <= x.start < x.end <= len(text) and 0 <= x.word < by_id[i].n_words
    assert l.scanned(docs.limit(0)).count() == 0


def test_query_holds_every_base_place(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for folder in (str(tmp_path), "/root/testdata/sf0.01"):
        texts = {r.doc_id: r.text for r in read(spark, folder, "documents").select("doc_id", "text").collect()}
        found = op12_license_scan(spark, folder).collect()
        assert len(found) == len(texts)
        for r in found:
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])
            assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
