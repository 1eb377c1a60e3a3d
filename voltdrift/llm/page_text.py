"""Main text of web pages: the run of words and tags with the largest total score."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from math import log
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltdrift.llm.common import bounded_sample, read

SAMPLE = 2_000  # labelled pages learned from, at most
MOST, TAG_LEAST, TAG_MOST = 3.0, -1.0, -0.05  # bounds of a word's and a tag's score

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|template|noscript|textarea|iframe|svg|object|canvas|video|audio)\b[^>]*+>.*?(?:</\1\b[^>]*+>|\Z)"
    r"|<(/?)([a-z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">]++)*+|[^>]*+)>"
    r"|<[!?][^>]*+>"
    r"|</?[a-z!?][^>]*+\Z",
    re.S | re.I,
)
_NAMES = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)

# Elements that begin and end a block of text.
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td "
    "tfoot th thead title tr ul button label input caption".split()
)
# Of these, elements that can hold others and are tracked as open.
HOLDERS = set(
    "article aside blockquote body button details dialog div dl fieldset figure footer form head header label legend main menu "
    "nav ol section select table title ul".split()
)
# Elements, and whole names of class, id or role, that mark what is beside the article.
BESIDE_TAGS = set("nav header footer aside form button select dialog head title menu label legend fieldset".split())
BESIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended recommendations comment comments disqus reply "
    "replies respond discussion pagination pager widget toolbar search copyright legal disclaimer complementary contentinfo "
    "bannerad paywall outbrain taboola".split()
)
MAIN_TAGS = {"article", "main"}
MAIN_WORDS = {"articlebody", "main"}
ARTICLE, BESIDE, PLAIN, LINK = "article", "beside", "plain", "link"
INNER = "inner"  # what is beside the article, though it lies in it: left out, but no reason to end a run


class Token(NamedTuple):
    text: str  # of a run of text; empty for a tag
    tag: str  # its name, with / where it closes; empty for text
    place: str  # what the token lies in: the article, plain text, a link, or the mark of what is beside it


def tokens_of(page: str) -> list[Token]:
    """Runs of text and tags, each with the nearest enclosing element that says what it is part of."""
    found: list[Token] = []
    open_: list[tuple[str, str | None]] = []
    marks: list[str] = []
    links, at, has_main = 0, 0, False

    def place() -> str:
        if not marks:
            return LINK if links else PLAIN
        return marks[-1] if marks[-1] == ARTICLE or ARTICLE not in marks else INNER

    for match in _TOKEN.finditer(page):
        if match.start() > at:
            found.append(Token(page[at : match.start()], "", place()))
        at = match.end()
        name = (match[3] or "").lower()
        if not name:
            continue
        if match[2]:
            found.append(Token("", "/" + name, place()))
            if name == "a":
                links = 0
            if name in HOLDERS and any(x == name for x, _ in open_):
                while open_:
                    x, mark = open_.pop()
                    if mark:
                        marks.pop()
                    if x == name:
                        break
            continue
        if name in BLOCKS:
            links = 0
        elif name == "a":
            links = 1
        if name in HOLDERS:
            attributes = match[4] or ""
            words = {w for v in _NAMES.findall(attributes) for w in v.strip("\"'").lower().split()} if "=" in attributes else set()
            mark = None
            inside = ARTICLE in marks
            if name != "body" and words & BESIDE_WORDS and not (name in MAIN_TAGS and "comment" not in words):
                mark = min(words & BESIDE_WORDS)
            elif name in BESIDE_TAGS and not (name == "header" and inside):
                mark = name
            elif name in MAIN_TAGS or words & MAIN_WORDS:
                mark, has_main = ARTICLE, True
            if not (attributes.endswith("/")):
                open_.append((name, mark))
                if mark:
                    marks.append(mark)
        found.append(Token("", name, place()))
    if at < len(page):
        found.append(Token(page[at:], "", place()))
    if has_main:  # on such a page, what has no mark is beside the article
        found = [t._replace(place=BESIDE) if t.place in (PLAIN, LINK) else t for t in found]
    return found


class Weights(NamedTuple):
    words: dict[str, float]  # score of a word, by its place
    tags: dict[str, float]

    def word(self, place: str) -> float:
        return self.words.get(place, -MOST)

    def tag(self, name: str) -> float:
        return self.tags.get(name, TAG_LEAST / 2)


def fitted(pages: list[str]) -> Weights:
    """Log-odds of lying inside the article, from pages whose markup labels it (article, main).

    Words score positive where their place is mostly inside, tags always negative.
    Text of pages without such labels has fixed scores, as those pages say nothing
    about it: a word is 1, in a link -1; so has what an article holds beside its
    text, next to nothing. Places never seen are -MOST.
    """
    inner, outer = [Counter(), Counter()], [Counter(), Counter()]
    for page in pages:
        tokens = tokens_of(page)
        if not any(t.place == ARTICLE for t in tokens):
            continue
        for t in tokens:
            side = inner if t.place == ARTICLE else outer
            if t.tag:
                side[1][t.tag] += 1
            else:
                side[0][t.place] += len(t.text.split())
    totals = [[max(1, sum(c.values())) for c in side] for side in (inner, outer)]

    def odds(key: str, kind: int) -> float:
        inside = (inner[kind][key] + 0.5) / totals[0][kind]
        return log(inside / ((outer[kind][key] + 0.5) / totals[1][kind]))

    words = {p: max(-MOST, min(MOST, odds(p, 0))) for p in inner[0].keys() | outer[0].keys()}
    tags = {t: max(TAG_LEAST, min(TAG_MOST, odds(t, 1))) for t in inner[1].keys() | outer[1].keys()}
    return Weights({ARTICLE: MOST, BESIDE: -MOST} | words | {PLAIN: 1.0, LINK: -1.0, INNER: TAG_MOST}, tags)


def best_run(scores: list[float]) -> tuple[int, int]:
    """The contiguous run with the largest sum, in one scan; (0, 0) where no sum is positive."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, span = total, (start, i + 1)
    return span


def main_text(page: str | None, weights: Weights) -> str:
    """Blocks of the best run, joined by newlines, without what in it has a negative place.

    Where no word of a page has a positive place, names of class, id or role that
    say it is beside the article mark all there is: they count as plain text then.
    """
    tokens = tokens_of(page or "")
    if not any(weights.word(t.place) > 0 and t.text.strip() for t in tokens):
        tokens = [t._replace(place=PLAIN) if t.place in BESIDE_WORDS - BESIDE_TAGS else t for t in tokens]
    scores = [weights.tag(t.tag) if t.tag else weights.word(t.place) * len(t.text.split()) for t in tokens]
    start, stop = best_run(scores)
    blocks, block = [], []
    for t in tokens[start:stop]:
        if t.tag:
            if t.tag.lstrip("/") in BLOCKS:
                blocks.append(block)
                block = []
            elif t.tag == "br":
                block.append(" ")
        elif weights.word(t.place) > 0 or t.place == LINK:
            block.append(t.text)
    blocks.append(block)
    joined = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(x for x in joined if x)


def train(pages: DataFrame, sample: int = SAMPLE) -> Weights:
    """Weights from at most ``sample`` pages with an article or main element, chosen by a hash of id and url."""
    labelled = pages.where(F.col("html").rlike("(?i)<(article|main)[\\s>]")).select("page_id", "url")
    chosen = bounded_sample(labelled, sample, F.col("page_id"), F.col("url")).distinct()
    same = pages["page_id"].eqNullSafe(chosen["page_id"]) & pages["url"].eqNullSafe(chosen["url"])
    rows = pages.join(F.broadcast(chosen), same, "left_semi").orderBy("page_id", "url", "html").select("html")
    return fitted([r["html"] for r in rows.toLocalIterator()])


def _extract(weights: Weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([main_text(x.as_py(), weights) for x in batch.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), text], ["page_id", "url", "text"])

    return run


def extracted(pages: DataFrame, weights: Weights) -> DataFrame:
    """(page_id, url, text) of every row of ``pages`` (page_id, url, html).

    The whole html is read. NULL or empty html, and pages without content, give an
    empty text; broken markup is read as far as it goes (an unclosed element lasts
    to the end of the one around it); repeated rows and rows without an id are
    treated like others; other columns are not looked at.
    """
    return pages.select("page_id", "url", "html").mapInArrow(_extract(weights), "page_id long, url string, text string")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    found = extracted(pages, train(pages))
    return found.withColumn("n_chars", F.length("text").cast("long"))
