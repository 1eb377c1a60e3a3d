"""A prefix trie of conversations, built as z-fast tries over shards and merged.

A prefix of a conversation is known by a 127-bit polynomial hash of its turns. The
prefixes are dealt out over shards of bounded size by conversation, a long
conversation in layers of LAYER turns, so neither a prefix that many conversations
share nor a long conversation gathers in one task. Each shard inserts its
conversations in batches into a z-fast trie and expands the trie's edges into one
row for each prefix; only these rows, one a shard and prefix, are merged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltdrift.llm.common import checkpointed, read, written

SHARD = 10_000  # rows of a shard, on average
LAYER = 1024  # turns of a conversation in one shard
BATCH = 256  # sequences of turns inserted together
PIECE = 1 << 16  # ids of conversations in one row, for hashing
WORD = r"[^\x20\x09-\x0D]+"
BORROWED = 3  # most turns that a rebuilt conversation takes from another

PRIME = (1 << 127) - 1
MULTIPLIER = 0x5851F42D4C957F2D14057B7EF767814F
EMPTY = 1  # hash of no turns
_HALF = (1 << 64) - 1

Prefix = tuple[int, int]


def extended(value: int, t1: int, t2: int) -> int:
    """The hash of a sequence and one more turn, whose own hash is (t1, t2)."""
    return (value * MULTIPLIER + ((t1 & _HALF) << 64 | t2 & _HALF)) % PRIME


def as_prefix(value: int) -> Prefix:
    """A hash as two signed numbers of 64 bits."""
    return value >> 64, (value & _HALF) - (1 << 63)


# -- turns in order -------------------------------------------------------------------------------


def symbols_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, piece, turn, t1, t2, words, copies): turns without their texts; equal ones at a place are one row.

    Every conversation also has a row of no copies, so that one without turns is there too.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.lit(1).alias("piece"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("t1"), F.xxhash64(text, role, F.lit(1)).alias("t2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    same = turns.groupBy(turns.columns).agg(F.count(F.lit(1)).alias("copies"))
    return same.unionByName(_heads(turns))


def _heads(turns: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    none = {"piece": F.lit(-1), "turn": F.lit(None).cast("long"), "t1": zero, "t2": zero, "words": zero, "copies": zero}
    return turns.select("conv_id").distinct().select("conv_id", *(c.alias(name) for name, c in none.items()))


def rebuilt(symbols: DataFrame, family: int = 20) -> DataFrame:
    """Each conversation c with its first h turns taken from conversation c - c % ``family``; h is crc32(c) % 4.

    ``symbols`` as :func:`symbols_of` returns them, and so is the result. Fewer
    turns are taken where that conversation has fewer, and none where it is absent.
    """
    turns = symbols.where("piece = 1")
    # the first rows of each conversation; Spark keeps as many a map task before the shuffle
    order = "PARTITION BY conv_id ORDER BY turn NULLS FIRST, t1, t2, words"
    first = turns.withColumn("rn", F.expr(f"row_number() OVER ({order})")).where(f"rn <= {BORROWED}")
    first = first.withColumn("before", F.expr(f"coalesce(sum(copies) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"))
    borrowed = F.crc32(F.col("conv_id").cast("string")) % (BORROWED + 1)
    first = written(first.drop("piece"))

    def taken(h: Column) -> Column:
        return F.least(F.col("copies"), F.greatest(h - F.col("before"), F.lit(0)))

    own = first.select(
        F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), taken(borrowed).alias("gone")
    ).where("gone > 0")
    rest = turns.join(
        own, (F.col("conv_id") == F.col("_conv")) & F.col("turn").eqNullSafe(F.col("_turn")) & (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2")), "left"
    ).select("conv_id", "piece", "turn", "t1", "t2", "words", (F.col("copies") - F.coalesce("gone", F.lit(0))).alias("copies"))
    heads = symbols.where("piece = -1")
    wanted = heads.select("conv_id", borrowed.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("_base"))
    lent = first.withColumnRenamed("conv_id", "_base").join(wanted, "_base").select(
        "conv_id", F.lit(0).alias("piece"), F.col("rn").cast("long").alias("turn"), "t1", "t2", "words", taken(F.col("h")).alias("copies")
    )
    return rest.unionByName(lent).where("copies > 0").unionByName(heads)


class Run(NamedTuple):
    """What a task holds of a conversation, if it is the task's first or last: n turns, and their hash from zero on."""

    part: int
    conv_id: int
    n: int
    value: str


RUNS = "part int, conv_id long, n long, value string"
_RUNS = pa.schema([("part", pa.int32()), ("conv_id", pa.int64()), ("n", pa.int64()), ("value", pa.string())])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _outer_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last run of a task. Columns: part, conv_id, t1, t2, words, copies."""
    first = last = None
    for (part, conv), rows in groupby(_rows(batches), key=lambda row: row[:2]):
        n = value = 0
        for _, _, t1, t2, _, copies in rows:
            for _ in range(copies):
                value = extended(value, t1, t2)
            n += copies
        last = Run(part, conv, n, hex(value))
        first = first or last
    found = [] if first is None else [first] if first is last else [first, last]
    yield pa.RecordBatch.from_pylist([x._asdict() for x in found], schema=_RUNS)


class Before(NamedTuple):
    """What comes before a run, and whether the run ends its conversation."""

    value: int = EMPTY
    depth: int = 0
    opens: bool = True
    closes: bool = True


def _chained(runs: list[Run]) -> dict:
    """How each run of a conversation that crosses tasks begins."""
    found = {}
    for _, chain in groupby(sorted(runs, key=lambda r: r.part), key=lambda r: r.conv_id):
        chain = list(chain)
        value, depth = EMPTY, 0
        for run in chain:
            found[run.part, run.conv_id] = Before(value, depth, run is chain[0], run is chain[-1])
            value = (value * pow(MULTIPLIER, run.n, PRIME) + int(run.value, 16)) % PRIME
            depth += run.n
    return found


PATHS = "conv_id long, depth long, hi long, lo long, up_hi long, up_lo long, words long, ends boolean"
_PATHS = pa.schema([(c, pa.int64()) for c in ("conv_id", "depth", "hi", "lo", "up_hi", "up_lo", "words")] + [("ends", pa.bool_())])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 8192) -> Iterator[pa.RecordBatch]:
    some: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*some, strict=True) if some else [[] for _ in schema]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for row in rows:
        some.append(row)
        if len(some) == size:
            yield batch()
            some.clear()
    yield batch()


def _run_path(rows: Iterator[tuple], start: Before) -> Iterator[tuple]:
    """(depth, prefix, prefix above it, words) for each prefix that ends in a run."""
    value, depth = start.value, start.depth
    if start.opens:
        yield 0, as_prefix(value), (None, None), 0
    for _, _, t1, t2, words, copies in rows:
        for _ in range(copies):
            above, value, depth = as_prefix(value), extended(value, t1, t2), depth + 1
            yield depth, as_prefix(value), above, words


def _paths(starts: dict) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (part, conv), turns in groupby(_rows(batches), key=lambda row: row[:2]):
                start = starts.get((part, conv), Before())
                held = None
                for depth, prefix, above, words in _run_path(turns, start):
                    if held:
                        yield *held, False
                    held = conv, depth, *prefix, *above, words
                if held:
                    yield *held, start.closes

        yield from _batches(rows(), _PATHS)

    return run


def paths(symbols: DataFrame) -> DataFrame:
    """Every prefix of every conversation: conv_id, depth, hash, hash of the prefix one turn shorter, words of its last turn.

    Conversations are put in order over the tasks by ranges of their turns. Of each
    task's first and last conversation, two rows of fixed size go to the driver.
    """
    order = ["conv_id", "piece", "turn", "t1", "t2", "words"]  # NULLs first
    ranged = symbols.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = checkpointed(ranged.withColumn("part", F.spark_partition_id())).select("part", "conv_id", "t1", "t2", "words", "copies")
    runs = [Run(*row) for row in ordered.mapInArrow(_outer_runs, RUNS).collect()]
    return ordered.mapInArrow(_paths(_chained(runs)), PATHS)


# -- z-fast tries ---------------------------------------------------------------------------------


class Sequence(NamedTuple):
    """Turns of a conversation in one layer: the prefix they start from and the prefixes they lead to."""

    conv_id: int
    start: int
    prefixes: list[Prefix]  # [0] is the prefix of ``start`` turns
    words: list[int]

    @property
    def end(self) -> int:
        return self.start + len(self.prefixes) - 1

    def at(self, depth: int) -> Prefix:
        return self.prefixes[depth - self.start]


class Node:
    """A compacted node: an edge over the depths low + 1 to high, of which ``sequence`` is an example."""

    __slots__ = ("children", "high", "least", "low", "n", "parent", "sequence")

    def __init__(self, sequence: Sequence, low: int, high: int, parent: Node | None = None) -> None:
        self.sequence, self.low, self.high, self.parent = sequence, low, high, parent
        self.children: dict[Prefix, Node] = {}
        self.n, self.least = 0, None  # conversations that end here, and the smallest of them

    def handle(self) -> Prefix:
        return self.sequence.at(two_fattest(self.low, self.high))


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that the highest power of two divides."""
    return high & -1 << ((low ^ high).bit_length() - 1)


class ZFastTrie:
    """Z-fast tries, one for each prefix that sequences start from.

    ``handles`` finds a node by its prefix of two-fattest length.
    """

    def __init__(self) -> None:
        self.roots: dict[Prefix, Node] = {}
        self.handles: dict[Prefix, Node] = {}

    def exit_node(self, sequence: Sequence) -> Node | None:
        """The node in whose edge the sequence leaves the trie or ends, by fat binary search."""
        best = self.roots.get(sequence.prefixes[0])
        if best is None:
            return None
        low, high = sequence.start, sequence.end
        while low < high:
            fattest = two_fattest(low, high)
            node = self.handles.get(sequence.at(fattest))
            if node is None:
                high = fattest - 1
            elif node.high <= sequence.end and sequence.at(node.high) == node.sequence.at(node.high):
                best, low = node, node.high
            else:
                return node
        if best.high < sequence.end:
            return best.children.get(sequence.at(best.high + 1), best)
        return best

    @staticmethod
    def shared(sequence: Sequence, node: Node) -> int:
        """How deep the sequence runs along the node's edge."""
        low, high = node.low, min(node.high, sequence.end)
        while low < high:
            middle = (low + high + 1) // 2
            if sequence.at(middle) == node.sequence.at(middle):
                low = middle
            else:
                high = middle - 1
        return low

    def _split(self, node: Node, depth: int) -> Node:
        """Cut the node's edge; the upper part, a new node, which hangs where ``node`` hung."""
        upper = Node(node.sequence, node.low, depth, node.parent)
        del self.handles[node.handle()]
        node.parent.children[node.sequence.at(node.low + 1)] = upper
        upper.children[node.sequence.at(depth + 1)] = node
        node.low, node.parent = depth, upper
        self.handles[upper.handle()], self.handles[node.handle()] = upper, node
        return upper

    def insert(self, sequence: Sequence, n: int, least: int, node: Node | None, touched: set[int]) -> None:
        """Add ``n`` conversations, the smallest of them ``least``, that read as ``sequence``; ``node`` is its exit node."""
        if node is None:
            node = self.roots[sequence.prefixes[0]] = Node(sequence, sequence.start, sequence.start)
        depth = self.shared(sequence, node)
        if depth < node.high:
            touched.add(id(node))
            node = self._split(node, depth)
        if depth < sequence.end:
            touched.add(id(node))
            leaf = Node(sequence, depth, sequence.end, node)
            node.children[sequence.at(depth + 1)] = leaf
            self.handles[leaf.handle()] = leaf
            node = leaf
        node.n += n
        node.least = least if node.least is None else min(least, node.least)

    def insert_batch(self, sequences: Iterable[Sequence]) -> None:
        """Equal sequences as one; exit nodes first, found again where the batch has changed them meanwhile."""
        found: dict[tuple[Prefix, Prefix], list] = {}
        for sequence in sequences:
            same = found.setdefault((sequence.prefixes[0], sequence.prefixes[-1]), [sequence, 0, sequence.conv_id])
            same[1], same[2] = same[1] + 1, min(same[2], sequence.conv_id)
        located = [(*same, self.exit_node(same[0])) for same in found.values()]
        touched: set[int] = set()
        for sequence, n, least, node in located:
            if node is None or id(node) in touched:
                node = self.exit_node(sequence)
            self.insert(sequence, n, least, node, touched)

    def expanded(self) -> Iterator[tuple]:
        """(depth, prefix, prefix above, words, conversations, smallest conversation) for each depth of each edge.

        The root of a layer below the first is the end of an edge of the layer above it, and left out.
        """
        for root in self.roots.values():
            order, totals = [root], {}
            for node in order:
                order.extend(node.children.values())
            for node in reversed(order):
                n, least = node.n, node.least
                for child in node.children.values():
                    more, smallest = totals[id(child)]
                    n, least = n + more, smallest if least is None else min(least, smallest)
                totals[id(node)] = n, least
                if node is root and root.high == 0:
                    yield 0, root.sequence.prefixes[0], (None, None), 0, n, least
                for depth in range(node.low + 1, node.high + 1):
                    sequence = node.sequence
                    yield depth, sequence.at(depth), sequence.at(depth - 1), sequence.words[depth - sequence.start - 1], n, least


LOCAL = "shard long, depth long, hi long, lo long, up_hi long, up_lo long, words long, n long, least long"
_LOCAL = pa.schema([(c, pa.int64()) for c in ("shard", "depth", "hi", "lo", "up_hi", "up_lo", "words", "n", "least")])


def _sequences(rows: Iterable[tuple], layer: int) -> Iterator[Sequence]:
    """Rows conv_id, depth, hi, lo, up_hi, up_lo, words, in order, as one sequence for each conversation and layer."""
    for (conv, number), steps in groupby(rows, key=lambda row: (row[0], max(row[1] - 1, 0) // layer)):
        prefixes, words = [], []
        for _, depth, hi, lo, up_hi, up_lo, count in steps:
            if depth:
                if not prefixes:
                    prefixes.append((up_hi, up_lo))
                prefixes.append((hi, lo))
                words.append(count)
            else:
                prefixes.append((hi, lo))
        yield Sequence(conv, number * layer, prefixes, words)


def _shard_trie(layer: int, batch: int) -> Callable:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        table = table.select(["conv_id", "depth", "hi", "lo", "up_hi", "up_lo", "words"]).sort_by([("conv_id", "ascending"), ("depth", "ascending")])
        sequences = list(_sequences(_rows(table.to_batches()), layer))
        trie = ZFastTrie()
        for at in range(0, len(sequences), batch):
            trie.insert_batch(sequences[at : at + batch])
        rows = ((shard, depth, *prefix, *above, words, n, least) for depth, prefix, above, words, n, least in trie.expanded())
        return pa.Table.from_batches(list(_batches(rows, _LOCAL)), schema=_LOCAL)

    return run


# -- the merged trie ------------------------------------------------------------------------------

SUMS = "hi long, lo long, saved long, leaves long"
_SUMS = pa.schema([(c, pa.int64()) for c in ("hi", "lo", "saved", "leaves")])


def _subtree_sums(layer: int) -> Callable:
    """Sums over the subtrees of a shard's nodes, the deepest first."""

    def run(table: pa.Table) -> pa.Table:
        table = table.select(["depth", "hi", "lo", "up_hi", "up_lo", "saved", "leaves"]).sort_by([("depth", "descending")])
        given = list(_rows(table.to_batches()))
        below: dict[Prefix, tuple[int, int]] = {}

        def add(hi: int, lo: int, saved: int, leaves: int) -> None:
            before = below.get((hi, lo), (0, 0))
            below[hi, lo] = before[0] + saved, before[1] + leaves

        for depth, hi, lo, up_hi, _, saved, leaves in given:
            if depth and up_hi is None:  # from deeper layers
                add(hi, lo, saved, leaves)
        rows = []
        for depth, hi, lo, up_hi, up_lo, saved, leaves in given:
            if not depth or up_hi is not None:
                more = below.pop((hi, lo), (0, 0))
                total = saved + more[0], leaves + more[1]
                rows.append((hi, lo, *total))
                if depth == 1 or (depth and (depth - 1) % layer):
                    add(up_hi, up_lo, *total)
        return pa.Table.from_batches(list(_batches(iter(rows), _SUMS)), schema=_SUMS)

    return run


ENDS = "hi long, lo long, part int, at long, ids string"
_ENDS = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("part", pa.int32()), ("at", pa.int64()), ("ids", pa.string())])
HASHES = "hi long, lo long, ends_sha256 string"
_HASHES = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("ends_sha256", pa.string())])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()

    def rows() -> Iterator[tuple]:
        for prefix, members in groupby(_rows(batches), key=lambda row: row[:2]):
            ids, at = [], 0
            for _, _, conv in members:
                ids.append(str(conv))
                if len(ids) == PIECE:
                    yield *prefix, part, at, ",".join(ids)
                    ids, at = [], at + 1
            if ids:
                yield *prefix, part, at, ",".join(ids)

    yield from _batches(rows(), _ENDS, 64)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for prefix, pieces in groupby(_rows(batches), key=lambda row: row[:2]):
            found, between = hashlib.sha256(), ""
            for *_, ids in pieces:
                found.update((between + ids).encode())
                between = ","
            yield *prefix, found.hexdigest()

    yield from _batches(rows(), _HASHES)


def end_hashes(ends: DataFrame) -> DataFrame:
    """(hi, lo, ends_sha256): for each prefix the SHA-256 of the conversations that end there, in ascending order.

    Ids are ordered over the tasks and joined there; a prefix with many ends
    reaches the last task as a few rows, which pass through its hash one by one.
    """
    order = ["hi", "lo", "conv_id"]
    lists = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_listed, ENDS)
    return lists.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "part", "at").mapInArrow(_hashed, HASHES)


def nodes(symbols: DataFrame, shard: int = SHARD, layer: int = LAYER, batch: int = BATCH) -> DataFrame:
    """The trie's nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``symbols`` as :func:`symbols_of` returns them. A node is a prefix of one
    conversation or more; ``conv_id`` is the smallest of them. ``saved_tokens`` adds
    up over its subtree the words that need not be stored again. Conversations
    without turns end at the root. No conversations give no nodes.
    """
    steps = written(paths(symbols))
    n, deepest = steps.agg(F.count(F.lit(1)), F.max("depth")).first()
    layered = (deepest or 0) > layer
    shards = max(1, -(-n // shard))
    number = F.floor(F.greatest(F.col("depth") - 1, F.lit(0)) / layer).cast("long")
    place = F.pmod(F.xxhash64("conv_id", number), F.lit(shards)).alias("shard")
    local = written(steps.select(place, "conv_id", "depth", "hi", "lo", "up_hi", "up_lo", "words").groupBy("shard").applyInArrow(_shard_trie(layer, batch), LOCAL))
    same = [F.min(c).alias(c) for c in ("depth", "up_hi", "up_lo", "words")]
    merged = local.groupBy("hi", "lo").agg(F.min("least").alias("conv_id"), F.sum("n").alias("n_convs"), *same)
    children = merged.where("depth > 0").groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")).agg(F.count(F.lit(1)).alias("n_children"))
    merged = written(merged.join(children, ["hi", "lo"], "left").fillna(0, ["n_children"]))
    saved, leaf = ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), (F.col("n_children") == 0).cast("long").alias("leaves")
    owned = merged.select("hi", "lo", F.col("conv_id").alias("least"), saved, leaf)
    keys = ["shard", "depth", "hi", "lo", "up_hi", "up_lo", "saved", "leaves"]
    values = local.join(owned, ["hi", "lo", "least"], "left").fillna(0, ["saved", "leaves"]).select(*keys)
    if layered:
        values = values.unionByName(_from_deeper(steps, merged.select("conv_id", number.alias("number"), saved, leaf), layer, shards))
    sums = values.groupBy("shard").applyInArrow(_subtree_sums(layer), SUMS).groupBy("hi", "lo").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    above = merged.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("conv_id").alias("parent_conv_id"))
    found = merged.join(sums, ["hi", "lo"]).join(end_hashes(steps.where("ends")), ["hi", "lo"], "left").join(above, ["up_hi", "up_lo"], "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def _from_deeper(steps: DataFrame, owned: DataFrame, layer: int, shards: int) -> DataFrame:
    """What each conversation's own nodes add up to below a layer, placed at the end of its sequence in that layer."""
    each = owned.groupBy("conv_id", "number").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    ends = steps.where((F.col("depth") > 0) & (F.col("depth") % layer == 0))
    ends = ends.select("conv_id", "hi", "lo", "depth", (F.col("depth") / layer - 1).cast("long").alias("number"))
    both = ends.unionByName(each.where("number > 0").select("conv_id", (F.col("number") - 1).alias("number"), "saved", "leaves"), allowMissingColumns=True)
    merged = both.groupBy("conv_id", "number").agg(*(F.max(c).alias(c) for c in ("hi", "lo", "depth", "saved", "leaves")))
    below = "OVER (PARTITION BY conv_id ORDER BY number DESC)"
    sums = merged.select("conv_id", "number", "hi", "lo", "depth", *(F.expr(f"sum({c}) {below}").alias(c) for c in ("saved", "leaves")))
    none = F.lit(None).cast("long")
    return sums.where("depth IS NOT NULL AND saved IS NOT NULL").select(
        F.pmod(F.xxhash64("conv_id", "number"), F.lit(shards)).alias("shard"), "depth", "hi", "lo", none.alias("up_hi"), none.alias("up_lo"), "saved", "leaves"
    )


def conversation_trie(conversations: DataFrame, **options) -> DataFrame:
    """The trie of ``conversations`` (conv_id, turn, role, text); see :func:`nodes`.

    Turns stand by turn, NULL first; those of equal number by a hash of role and
    text, and equal ones one after another. NULL roles and texts are empty, rows
    without an id take no part, and other columns are not looked at.
    """
    return nodes(symbols_of(conversations), **options)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes(rebuilt(written(symbols_of(read(spark, sf_dir, "conversations")))))
