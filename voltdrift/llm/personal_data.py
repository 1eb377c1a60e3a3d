"""Personal data: fixed patterns, and boosted trees that select from further candidate spans.

Everything that runs over the texts is DataFrame functions.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltdrift.llm.common import checkpointed, read

ROUNDS, RATE, LEAST_LEAF = 30, 0.3, 5.0
PRECISION = 0.9  # share of true spans that a kind's threshold must reach
KINDS = ["email", "ip", "card", "phone"]

# The stated patterns. \G and the lookbehind keep a run of characters from being
# entered at every one of its characters; possessive loops do not recurse.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Generators of candidates, by name: their kind and pattern. They overlap the base spans and each other.
GENERATORS = {
    "email_words": ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z]{2,}+)++"),
    "ip_short": ("ip", r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])"),
    "card_fours": ("card", r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){3}(?![0-9])"),
    "phone_plus": ("phone", r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[\x20.-][0-9]{2,4}){1,2}(?![0-9])"),
    "phone_bare": ("phone", r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
}
_CUES = r"(?:mail|contact|write|call|phone|tel|mobil|fax|ip|host|server|address|card|visa|credit|pay)[^\n]{0,20}$"
SPAN = "array<struct<start:int,end:int,found:string,before:string,after:string>>"
CHUNK = 256  # matches whose places are summed up together
CELL = 64  # code points of a text in which overlapping candidates meet


def _struct(**fields: Column) -> Column:
    """A struct whose names hold inside lambda functions too, for literals as well."""
    return F.named_struct(*(x for name, value in fields.items() for x in (F.lit(name), value)))


def _matches(text: Column, pattern: str, plain: str) -> Column:
    """Matches of ``pattern`` in order, each with the text before it, and what follows both.

    Texts without the character class ``plain``, which every match needs, are not searched.
    """
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(0))
    between = F.split(text, pattern, -1)
    rest = F.array_size(between)
    pairs = F.arrays_zip(
        between.alias("between"), found.alias("found"), F.slice(between, F.lit(2), rest).alias("then"), F.slice(found, F.lit(2), rest).alias("next")
    )
    return F.when(text.rlike(plain), F.filter(pairs, lambda p: p["found"].isNotNull()))


def _placed(pairs: str) -> Column:
    """The matches with their places (code points) and what stands around them.

    The places are running sums, taken in chunks: arrays that grow by one element
    at a time are copied each time, so they are kept to CHUNK elements, and one
    element a chunk.
    """
    size = lambda p: F.length(p["between"]) + F.length(p["found"])
    chunks = F.transform(F.sequence(F.lit(1), F.size(pairs), F.lit(CHUNK)), lambda at: F.slice(pairs, at, CHUNK))
    sizes = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, p: a + size(p)))
    zero = _struct(at=F.lit(0), all=F.array().cast("array<int>"))
    starts = F.aggregate(sizes, zero, lambda state, n: _struct(at=state["at"] + n, all=F.concat(state["all"], F.array(state["at"]))))["all"]

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["between"])
        end = begin + F.length(pair["found"])
        after = F.left(F.concat(F.coalesce(pair["then"], F.lit("")), F.coalesce(pair["next"], F.lit(""))), F.lit(1))
        span = _struct(start=begin, end=end, found=pair["found"], before=F.right(pair["between"], F.lit(24)), after=after)
        return _struct(at=end, spans=F.concat(state["spans"], F.array(span)))

    def spans(chunk: Column, at: Column) -> Column:
        return F.aggregate(chunk, _struct(at=at, spans=F.array().cast(SPAN)), step)["spans"]

    return F.when(F.size(pairs) > 0, F.flatten(F.zip_with(chunks, starts, spans))).otherwise(F.array().cast(SPAN))


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(found: Column) -> Column:
    digits = F.transform(F.split(F.reverse(_digits(found)), ""), lambda x: F.try_to_number(x, F.lit("9")).cast("int"))
    digits = F.filter(digits, lambda x: x.isNotNull())
    doubled = F.transform(digits, lambda x, i: F.when(i % 2 == 1, F.when(x > 4, x * 2 - 9).otherwise(x * 2)).otherwise(x))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, found: Column) -> Column:
    """Whether a match of a kind's pattern counts."""
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda part: part.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        n = F.length(_digits(found))
        return n.between(16, 19) & F.when(n.between(16, 19), _luhn(found))
    if kind == "phone":
        return F.length(_digits(found)).between(8, 15)
    return F.lit(True)


def _is_valid(kind: str):
    return lambda span: valid(kind, span["found"])


# Features of a candidate, each with few values, so that all of them together have a bounded number of cells.
FEATURES = {"generator": len(GENERATORS), "digits": 6, "marks": 4, "before": 5, "after": 5, "cue": 2}


def _kind_of_character(c: Column) -> Column:
    return (
        F.when(c == "", 0).when(c.rlike(r"^\s"), 1).when(c.rlike(r"^[\p{L}]"), 2).when(c.rlike(r"^[0-9.]"), 3).otherwise(4)
    )


def _features(span: Column, generator: int) -> Column:
    digits = F.length(_digits(span["found"]))
    marks = F.length(F.regexp_replace(span["found"], "[A-Za-z0-9]", ""))
    amount = F.when(digits < 4, 0).when(digits < 8, 1).when(digits < 11, 2).when(digits < 13, 3).when(digits < 16, 4).otherwise(5)
    return _struct(
        start=span["start"],
        end=span["end"],
        generator=F.lit(generator),
        digits=amount,
        marks=F.least(marks, F.lit(3)),
        before=_kind_of_character(F.right(span["before"], F.lit(1))),
        after=_kind_of_character(span["after"]),
        cue=F.lower(span["before"]).rlike(_CUES).cast("int"),
    )


def _features_of(generator: int):
    return lambda span: _features(span, generator)


def found_spans(docs: DataFrame, *keep: str) -> DataFrame:
    """Rows of ``docs`` (text, and the columns ``keep``) with ``base``, the spans of the stated
    patterns by kind, and ``candidates``, what the generators propose and the trees look at."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"} | {g: "@" if k == "email" else "[0-9]" for g, (k, _) in GENERATORS.items()}
    patterns = BASE | {g: p for g, (_, p) in GENERATORS.items()}
    matched = docs.select(*keep, text.alias("_text")).select(
        *keep, *(_matches(F.col("_text"), p, plain[n]).alias(f"_m_{n}") for n, p in patterns.items())
    )
    placed = matched.select(*keep, *(_placed(f"_m_{n}").alias(f"_{n}") for n in patterns))
    base = F.struct(
        *(
            F.transform(F.filter(f"_{k}", _is_valid(k)), lambda s: _struct(start=s["start"], end=s["end"])).alias(k)
            for k in KINDS
        )
    )
    candidates = F.concat(
        *(F.transform(f"_{g}", _features_of(i)) for i, g in enumerate(GENERATORS))
    )
    return placed.select(*keep, base.alias("base"), candidates.alias("candidates"))


class Tree(NamedTuple):
    """A split on two features' values, at most: (feature, values on the left), and the leaves' scores."""

    first: tuple[str, list[int]]
    then: list[tuple[str, list[int]] | None]  # left, right
    leaves: list[float]  # left-left, left-right, right-left, right-right


class Model(NamedTuple):
    trees: list[Tree]
    bias: float
    thresholds: dict[int, float]  # by generator; above 1 where nothing reaches the precision


def _split(cells: np.ndarray, names: list[str], gradient: np.ndarray, weight: np.ndarray, inside: np.ndarray):
    """The best two-way split of a feature's values, ordered by their mean gradient."""
    best, chosen = 1e-9, None
    total_g, total_w = gradient[inside].sum(), weight[inside].sum()
    for f, name in enumerate(names):
        size = FEATURES[name]
        g = np.bincount(cells[inside, f], gradient[inside], size)
        w = np.bincount(cells[inside, f], weight[inside], size)
        order = [v for v in np.argsort(g / np.maximum(w, 1e-9), kind="stable").tolist() if w[v] > 0]
        for i in range(1, len(order)):
            left_g, left_w = g[order[:i]].sum(), w[order[:i]].sum()
            gain = left_g**2 / (left_w + 1) + (total_g - left_g) ** 2 / (total_w - left_w + 1) - total_g**2 / (total_w + 1)
            if gain > best:
                best, chosen = gain, (name, sorted(order[:i]))
    return chosen


def fitted(cells: np.ndarray, counts: np.ndarray, true: np.ndarray, precision: float = PRECISION) -> Model:
    """Gradient boosting with logistic loss on a table of cells (features, how many candidates, how many true ones)."""
    names = list(FEATURES)
    if not len(cells):
        return Model([], 0.0, {g: 2.0 for g in range(len(GENERATORS))})
    share = (true.sum() + 1) / (counts.sum() + 2)
    bias = float(np.log(share / (1 - share)))
    margin, trees = np.full(len(cells), bias), []

    def side(split, inside: np.ndarray) -> np.ndarray:
        return inside & np.isin(cells[:, names.index(split[0])], split[1])

    for _ in range(ROUNDS):
        chance = 1 / (1 + np.exp(-margin))
        gradient, weight = true - counts * chance, counts * chance * (1 - chance) + 1e-9
        everything = np.ones(len(cells), bool)
        first = _split(cells, names, gradient, weight, everything)
        if first is None:
            break
        left = side(first, everything)
        then, leaves = [], []
        for half in (left, ~left):
            split = _split(cells, names, gradient, weight, half) if counts[half].sum() >= LEAST_LEAF else None
            then.append(split)
            parts = [side(split, half), half & ~side(split, half)] if split else [half, half]
            values = [RATE * float(np.clip(gradient[p].sum() / (weight[p].sum() + 1), -4, 4)) if p.any() else 0.0 for p in parts]
            leaves += values
            if split:
                margin[parts[0]] += values[0]
                margin[parts[1]] += values[1]
            else:
                margin[half] += values[0]
        trees.append(Tree(first, then, leaves))
    chance = 1 / (1 + np.exp(-margin))
    thresholds = {}
    for g in range(len(GENERATORS)):
        own = np.nonzero(cells[:, 0] == g)[0]
        own = own[np.argsort(-chance[own], kind="stable")]
        good = np.cumsum(true[own]) >= precision * np.cumsum(counts[own])
        last = np.nonzero(good)[0]
        thresholds[g] = float(chance[own[last[-1]]]) - 1e-9 if len(last) else 2.0
    return Model(trees, bias, thresholds)


def chance_of(model: Model, c: Column) -> Column:
    """The boosted trees as one SQL expression of a candidate's features."""

    def on_left(split) -> Column:
        return c[split[0]].isin(*split[1])

    margin = F.lit(model.bias)
    for tree in model.trees:
        halves = [
            F.when(on_left(split), tree.leaves[2 * i]).otherwise(tree.leaves[2 * i + 1]) if split else F.lit(tree.leaves[2 * i])
            for i, split in enumerate(tree.then)
        ]
        margin = margin + F.when(on_left(tree.first), halves[0]).otherwise(halves[1])
    return 1 / (1 + F.exp(-margin))


def _kind_number(generator: Column) -> Column:
    numbers = [KINDS.index(k) for k, _ in GENERATORS.values()]
    return F.array(*map(F.lit, numbers))[generator]


def _of_kind(number: int):
    return lambda s: _struct(kind=F.lit(number), start=s["start"], end=s["end"])


def _base_list(base: Column) -> Column:
    """All base spans as (kind number, start, end)."""
    return F.concat(
        *(F.transform(base[k], _of_kind(i)) for i, k in enumerate(KINDS))
    )


def _numbered(found: DataFrame) -> DataFrame:
    """Rows with a number, and ``stated``, all stated spans. ``found`` must be written, so that numbers stay."""
    return found.select("*", _base_list(F.col("base")).alias("stated"), F.monotonically_increasing_id().alias("_row"))


def train(found: DataFrame, precision: float = PRECISION) -> Model:
    """Trees that tell candidates which are stated spans of their kind from the rest.

    Spark counts all candidates of all documents by their cell of features; the
    table of cells, a few thousand at most whatever the data, comes to the driver.
    Candidates and stated spans meet by row and place, so a text of many costs no
    more than many texts.
    """
    numbered = _numbered(found).where(F.size("candidates") > 0)
    each = numbered.select("_row", F.explode("candidates").alias("c")).select("_row", _kind_number(F.col("c.generator")).alias("kind"), "c.*")
    stated = numbered.select("_row", F.explode("stated").alias("s")).select("_row", "s.*", F.lit(1).alias("true"))
    table = (
        each.join(stated, ["_row", "kind", "start", "end"], "left")
        .groupBy(*FEATURES)
        .agg(F.count(F.lit(1)).alias("n"), F.count("true").alias("true"))
        .orderBy(*FEATURES)
        .collect()
    )
    cells = np.array([[r[f] for f in FEATURES] for r in table], np.int64).reshape(len(table), len(FEATURES))
    return fitted(cells, np.array([r["n"] for r in table], float), np.array([r["true"] for r in table], float), precision)


def _free(likely: DataFrame, stated: DataFrame) -> DataFrame:
    """The candidates of ``likely`` that overlap no stated span of their row.

    Along a text, a candidate's end is held against the furthest end of the stated
    spans that begin before it.
    """
    none = F.lit(None).cast("int")
    ends = likely.select("*", F.col("end").alias("_at"), none.alias("_reach"))
    begins = stated.select("_row", *(F.lit(None).cast(f.dataType).alias(f.name) for f in likely.schema if f.name != "_row"), F.col("start").alias("_at"), F.col("end").alias("_reach"))
    before = Window.partitionBy("_row").orderBy("_at", F.col("_reach").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = ends.unionByName(begins).withColumn("_furthest", F.max("_reach").over(before))
    return both.where(F.col("_reach").isNull() & (F.coalesce("_furthest", F.lit(-1)) <= F.col("start"))).select(likely.columns)


def _likeliest(free: DataFrame) -> DataFrame:
    """The candidates that no likelier one (the first of equal ones) of their row overlaps.

    They meet in cells of CELL code points, which hold few whatever the text.
    """
    cells = F.explode(F.sequence(F.floor(F.col("start") / CELL), F.floor((F.col("end") - 1) / CELL)))
    here = free.select("*", cells.alias("_cell"))
    other = here.select("_row", "_cell", *(F.col(c).alias(f"o_{c}") for c in ("start", "end", "chance", "i")))
    beaten = here.join(other, ["_row", "_cell"]).where(
        (F.col("start") < F.col("o_end")) & (F.col("o_start") < F.col("end"))
        & ((F.col("o_chance") > F.col("chance")) | ((F.col("o_chance") == F.col("chance")) & (F.col("o_i") < F.col("i"))))
    )
    return free.join(beaten.select("_row", "i").distinct(), ["_row", "i"], "left_anti")


def selected(found: DataFrame, model: Model) -> DataFrame:
    """``found`` with ``stated``, and ``spans``: the stated ones and the candidates that the trees select.

    A candidate is selected where its chance reaches its generator's threshold, it
    overlaps no stated span, and no likelier candidate (the first of equal ones)
    that reaches its own threshold and is free overlaps it.
    """
    thresholds = F.array(*(F.lit(model.thresholds[g]) for g in range(len(GENERATORS))))
    likely = F.filter(
        F.transform(
            "candidates",
            lambda c, i: _struct(
                kind=_kind_number(c["generator"]), start=c["start"], end=c["end"], chance=chance_of(model, c), least=thresholds[c["generator"]], i=i
            ),
        ),
        lambda c: c["chance"] >= c["least"],
    )
    numbered = _numbered(found)
    open_rows = numbered.select("_row", "stated", likely.alias("likely")).where(F.size("likely") > 0)
    each = open_rows.select("_row", F.explode("likely").alias("c")).select("_row", "c.*")
    free = _free(each, open_rows.select("_row", F.explode("stated").alias("s")).select("_row", "s.*"))
    added = _likeliest(checkpointed(free)).groupBy("_row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    spans = F.array_sort(F.concat("stated", F.coalesce("added", F.array().cast("array<struct<kind:int,start:int,end:int>>"))))
    return numbered.join(added, "_row", "left").withColumn("spans", spans).drop("_row", "added")


def personal_data(docs: DataFrame, *keep: str, precision: float = PRECISION) -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` with its spans of personal data.

    ``stated`` holds the spans of the fixed patterns, ``spans`` these and what the
    method adds, as (kind: a number in KINDS, start, end), in code points, by kind
    and start. A kind's matches do not overlap; those of different kinds may.
    NULL texts are empty; repeated rows and rows without an id are searched like
    others; without candidates nothing is added.
    """
    found = checkpointed(found_spans(docs, *keep))
    return selected(found, train(found, precision)).select(*keep, "stated", "spans")


def redacted(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """``docs`` (doc_id, text) with every span replaced by its kind in brackets; of overlapping spans, the first."""
    found = personal_data(docs, "doc_id", "text", precision=precision)
    by_start = F.array_sort(F.transform("spans", lambda s: _struct(start=s["start"], end=s["end"], kind=s["kind"])))
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    start = _struct(at=F.lit(0), out=F.lit(""))

    def step(state: Column, s: Column) -> Column:
        piece = F.substring("text", state["at"] + 1, s["start"] - state["at"])
        more = _struct(at=s["end"], out=F.concat(state["out"], piece, names[s["kind"]]))
        return F.when(s["start"] >= state["at"], more).otherwise(state)

    done = F.aggregate("spans", start, step)
    found = found.withColumn("spans", by_start).withColumn("done", done)
    rest = F.substring("text", F.col("done.at") + 1, F.length("text"))
    return found.select("doc_id", F.when(F.col("text").isNotNull(), F.concat("done.out", rest)).alias("text"))


def _has_kind(number: int):
    return lambda s: s["kind"] == number


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(read(spark, sf_dir, "documents"), "doc_id")
    names = F.array(*map(F.lit, KINDS))

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id",
        *(F.size(F.filter("stated", _has_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)),
        F.sha2(joined("stated"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )

