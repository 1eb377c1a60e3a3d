"""Licence scans: ordered signature rules behind a keyword filter; detections inside better ones are suppressed."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltdrift.llm import license_rules as signatures
from voltdrift.llm.common import read

#: Bytes between words; all others (ASCII letters and digits, and bytes of other characters) make up words.
BETWEEN = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]"
_AS_WORDS = bytes(32 if re.match(BETWEEN, bytes([c])) else c for c in range(256))
_BASE = len(signatures.TIERS) - 1


class Rule(NamedTuple):
    tier: int
    label: str
    keyword: str
    pattern: re.Pattern[bytes]


class Detection(NamedTuple):
    start: int  # bytes in the text
    end: int
    tier: int
    rule: int


def compiled(pattern: str) -> re.Pattern[bytes]:
    """The pattern for whole words of a lower-case text; the byte before a match is still to be looked at."""
    gaps = pattern.encode("latin-1").replace(b" ?", b"\0").replace(b" ", BETWEEN + b"++").replace(b"\0", b"(?:" + BETWEEN + b"++)?")
    return re.compile(b"(?:" + gaps + b")(?=" + BETWEEN + rb"|\Z)", re.DOTALL)


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, in order of priority."""
    names = signatures.IDENTIFIERS.lower().split()
    tags = [(name, "spdx", f"spdx license identifier {re.sub('[-.]', ' ', name)}") for name in names]
    tables = [tags] + [
        [tuple(x.strip() for x in line.split(";", 2)) for line in table.strip().splitlines()]
        for table in (signatures.WORDING, signatures.VERSIONED, signatures.NAMES, signatures.MENTIONS, signatures.BASE)
    ]
    return tuple(Rule(tier, label, word, compiled(pattern)) for tier, table in enumerate(tables) for label, word, pattern in table)


@lru_cache(maxsize=1)
def _keywords():
    """An automaton over the keywords of all rules; a keyword carries its rules' numbers."""
    import ahocorasick

    found: dict[str, list[int]] = {}
    for number, rule in enumerate(rules()):
        found.setdefault(rule.keyword, []).append(number)
    automaton = ahocorasick.Automaton()
    for word, numbers in found.items():
        automaton.add_word(word, tuple(numbers))
    automaton.make_automaton()
    return automaton


def gated(text: bytes) -> list[int]:
    """The rules whose keyword occurs in a lower-case text, in order of priority."""
    found = {numbers for _, numbers in _keywords().iter(text.decode("latin-1"))}
    return sorted(number for numbers in found for number in numbers)


def matches(text: bytes, number: int) -> Iterator[Detection]:
    rule = rules()[number]
    for match in rule.pattern.finditer(text):
        start, end = match.span()
        if start == 0 or _AS_WORDS[text[start - 1]] == 32:
            yield Detection(start, end, rule.tier, number)


def suppressed(found: list[Detection]) -> list[bool]:
    """For detections in order of (start, longest first, rule): whether one of them that is no worse holds it.

    No worse: of a higher tier, or of the same tier and longer, or as long and of
    an earlier rule. One pass: in this order whatever holds a detection comes
    before it, unless both are equally long, so it is enough to know how far
    earlier detections of each tier reach.
    """
    reach, flags = [-1] * len(signatures.TIERS), []
    at = 0
    while at < len(found):
        same = at
        while same < len(found) and found[same][:2] == found[at][:2]:
            same += 1
        for x in found[at:same]:
            flags.append(max(reach[: x.tier + 1]) >= x.end)
            reach[x.tier] = max(reach[x.tier], x.end)
        at = same
    return flags


def detections(text: bytes) -> list[tuple[Detection, bool]]:
    """The detections in a lower-case text (UTF-8) from left to right, and whether each stands.

    Those of the same place come in order of priority, so the best one stands.
    """
    found = [x for number in gated(text) for x in matches(text, number)]
    found.sort(key=lambda x: (x.start, -x.end, x.rule))
    return [(x, not gone) for x, gone in zip(found, suppressed(found), strict=True)]


def words_in(text: bytes) -> int:
    return len(text.translate(_AS_WORDS).split())


def score(labels: dict[str, float]) -> float:
    """How sure it is that a licence is stated: one minus the chance that all labels err."""
    wrong = 1.0
    for label in sorted(labels):
        wrong *= 1 - labels[label]
    return 1 - wrong


_FOUND = pa.struct(
    [("label", pa.string()), ("rule", pa.int32()), ("tier", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("word", pa.int64()), ("stands", pa.bool_())]
)
SCANNED = (
    "doc_id long, n_words long, score double,"
    " detections array<struct<label: string, rule: int, tier: string, start: bigint, end: bigint, word: bigint, stands: boolean>>"
)


def _scanned(text: bytes) -> tuple[int, float, list[dict]]:
    rows, labels = [], {}
    at = words = points = 0
    for x, stands in detections(text):
        rule, (tier, sure) = rules()[x.rule], signatures.TIERS[x.tier]
        before = text[at : x.start]
        words, points, at = words + words_in(before), points + len(before.decode("utf-8", "surrogatepass")), x.start
        size = len(text[x.start : x.end].decode("utf-8", "surrogatepass"))
        rows.append({"label": rule.label, "rule": x.rule, "tier": tier, "start": points, "end": points + size, "word": words, "stands": stands})
        if stands or x.tier == _BASE:
            labels[rule.label] = max(sure, labels.get(rule.label, 0))
    return words + words_in(text[at:]), score(labels), rows


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        found = [_scanned((text.as_py() or b"").lower()) for text in texts]
        numbers, scores, rows = zip(*found, strict=True) if found else ([], [], [])
        columns = [batch.column(0), pa.array(numbers, pa.int64()), pa.array(scores, pa.float64()), pa.array(rows, pa.list_(_FOUND))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "score", "detections"])


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, score, detections) of every row of ``docs`` (doc_id, text).

    A detection has its label, rule and tier, its place in code points and its
    first word's number, and whether it stands: it does not if another that is no
    worse holds it. Those of tier ``base`` count as they are. Rules see whole
    texts in lower case (A-Z only), and none runs in a text without its keyword.
    Equal rows give equal results, one a row; a NULL text is empty and has no
    detection; rows without an id are scanned like others; other columns are not
    looked at. No rows give none. Detections take memory in proportion to one
    text at most.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, SCANNED)


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("detections", lambda x: x["tier"] == "base")
    named = F.filter("detections", lambda x: x["stands"] | (x["tier"] == "base"))

    def joined(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["label"]))), ",")

    at = F.transform(base, lambda x: x["word"])
    return scanned(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(named).alias("labels"),
        "score",
        F.transform(F.filter("detections", lambda x: x["stands"]), lambda x: F.struct(x["label"], x["start"], x["end"])).alias("spans"),
    )
