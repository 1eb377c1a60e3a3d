"""Near-duplicate documents: SimHash fingerprints linked through BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltdrift.llm.common import checkpointed, read
from voltdrift.llm.components import connected

SEED = 42
WORDS = 3
RADIUS = 2
SHARD = 20_000  # fingerprints in one tree, at most
_STEP = 1 << 16  # shingles whose bits are counted at a time
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_MASK = (1 << 64) - 1


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The unsigned 64-bit SimHash of a text; 0 where it has no word."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return 0
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _STEP):
        some = hashes[at : at + _STEP]
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(x.as_py()) for x in batch.column(1)]
        signed = pa.array(np.array(found, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), signed], ["doc_id", "text_key", "fp"])


class BKTree:
    """Fingerprints in a tree whose children are keyed by their Hamming distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        self.group: list[int] = []

    def within(self, value: int, radius: int) -> list[int]:
        """Positions of all values at ``radius`` or less; only edges the triangle inequality allows are followed."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            distance = (value ^ self.values[at]).bit_count()
            if distance <= radius:
                found.append(at)
            children = self.children[at]
            if len(children) > 2 * radius + 1:
                for edge in range(distance - radius, distance + radius + 1):
                    if edge in children:
                        todo.append(children[edge])
            else:
                todo += [child for edge, child in children.items() if -radius <= edge - distance <= radius]
        return found

    def add(self, value: int) -> int:
        """Insert a value; its position, or that of an equal one."""
        at, new = 0, len(self.values)
        while self.values and at != new:
            distance = (value ^ self.values[at]).bit_count()
            if not distance:
                return at
            at = self.children[at].setdefault(distance, new)
        self.values.append(value)
        self.children.append({})
        self.group.append(new)
        return new

    def root(self, at: int) -> int:
        while self.group[at] != at:
            self.group[at] = at = self.group[self.group[at]]
        return at

    def unite(self, some: list[int]) -> int:
        roots = [self.root(x) for x in some]
        least = min(roots)
        for x in roots:
            self.group[x] = least
        return least


def _search(radius: int):
    """Rows of (shard, role, fp), sorted: each shard's tree is built from role 0; role 1 only searches it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, shard, out_a, out_b = BKTree(), None, [], []

        def close() -> None:
            for at, value in enumerate(tree.values):
                if (top := tree.root(at)) != at:
                    out_a.append(value)
                    out_b.append(tree.values[top])

        def flush() -> pa.RecordBatch:
            sides = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (out_a, out_b)]
            out_a.clear()
            out_b.clear()
            return pa.RecordBatch.from_arrays(sides, ["a", "b"])

        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            for key, role, fp in zip(keys, batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                if key != shard:
                    close()
                    tree, shard = BKTree(), key
                value = fp & _MASK
                near = tree.within(value, radius)
                if role == 0:
                    tree.unite([*near, tree.add(value)])
                elif near:
                    out_a.append(value)
                    out_b.append(tree.values[tree.unite(near)])
            yield flush()
        close()
        yield flush()

    return run


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, shard_size: int = SHARD) -> DataFrame:
    """Edges (a, b) that connect all fingerprints (column fp) within ``radius`` of each other.

    Fingerprints that differ in at most ``radius`` bits agree in one of
    ``radius + 1`` blocks of bits, so a tree holds the fingerprints of one block
    value and is searched by these only. A block value with more than
    ``shard_size`` fingerprints is dealt over several trees, each searched by all
    of its fingerprints: a tree is bounded whatever the data. Trees travel with
    the shuffle, one at a time in a task, as all trees together grow with the
    corpus. Edges are a spanning set: those that a tree's own groups already
    imply are not sent.
    """
    width = -(-64 // (radius + 1))
    blocks = [
        F.struct(
            F.lit(i).alias("block"),
            F.expr(f"shiftrightunsigned(fp, {i * width}) & {(1 << min(width, 64 - i * width)) - 1}L").alias("value"),
        )
        for i in range(radius + 1)
    ]
    keyed = distinct.select("fp", F.explode(F.array(*blocks)).alias("k")).select("fp", "k.block", "k.value")
    full = keyed.groupBy("block", "value").count().where(F.col("count") > 1)
    keyed = keyed.join(full, ["block", "value"])
    parts = F.ceil(F.col("count") / shard_size).cast("int")
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    routed = keyed.withColumn("own", own).select(
        "fp", "block", "value", "own", F.explode(F.sequence(F.lit(0), parts - 1)).alias("shard")
    )
    routed = routed.select("block", "value", "shard", F.when(F.col("shard") == F.col("own"), 0).otherwise(1).alias("role"), "fp")
    return (
        routed.repartition("block", "value", "shard")
        .sortWithinPartitions("block", "value", "shard", "role", "fp")
        .mapInArrow(_search(radius), "a long, b long")
    )


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shard_size: int = SHARD) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (columns doc_id, text).

    Words and shingles as in :func:`fingerprint`. Texts that are NULL, empty or
    without a word have fingerprint zero and are linked like any other. Rows are
    linked through their fingerprints, so equal texts meet before any search; a
    row without an id belongs to its component but cannot name it, and where no
    member has an id, component_id is NULL. Repeated rows come back repeated,
    other columns of ``docs`` are not looked at, and no rows give no rows.
    """
    found = _components(docs, radius, shard_size)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _components(docs: DataFrame, radius: int = RADIUS, shard_size: int = SHARD) -> DataFrame:
    """(doc_id, text_key, fp, component_id) of every row; a row's text is told by its hash."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    marked = checkpointed(keyed.mapInArrow(_fingerprints, "doc_id long, text_key long, fp long"))
    distinct = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    labels = connected(fingerprint_links(distinct.select("fp"), radius, shard_size))
    members = checkpointed(labels.withColumnRenamed("node", "fp").join(distinct, "fp"))
    least = members.groupBy("label").agg(F.min("first").alias("least"))
    linked = members.join(least, "label").select("fp", "least", F.lit(True).alias("linked"))
    named = distinct.join(linked, "fp", "left").select(
        "fp", F.when(F.col("linked"), F.col("least")).otherwise(F.col("first")).alias("component_id")
    )
    return marked.join(named, "fp").select("doc_id", "text_key", "fp", "component_id")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that name their component, or that have no id; all columns.

    Of rows that share an id, each is judged by its own text.
    """
    found = _components(docs, **options).where(F.col("doc_id") != F.col("component_id"))
    gone = found.select(F.col("doc_id").alias("_gone"), F.col("text_key").alias("_gone_key")).distinct()
    return docs.join(gone, (docs["doc_id"] == F.col("_gone")) & (F.xxhash64(docs["text"]) == F.col("_gone_key")), "left_anti")


def op2_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
