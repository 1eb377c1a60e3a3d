"""Repair of conversations: cheapest edits by a dynamic programme that keeps square-root many checkpoints.

A conversation's turns are edited until their roles read ``(s?(ua)+)?``. Turns are
put in order by ranges, so one long conversation spreads over many tasks. Within a
task a *run* (what it holds of a conversation) is a string of symbols, a byte a
turn. A step of the programme is a 4 x 4 matrix of costs over the grammar's states,
and so is a whole run: the few runs of conversations that cross from one task into
the next are chained by their matrices.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltdrift.llm.common import checkpointed, read

SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
ROLES = ("user", "assistant")

# States of the grammar: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 60
#: The state that a turn of the role the grammar wants next leads to (insert, rerole).
NEXT = (USER, USER, ASSISTANT, USER)
#: What keeping a turn leads to, by its role's initial; other initials cannot be kept.
KEPT = ((SYSTEM, None, None, None), (USER, USER, None, USER), (None, None, ASSISTANT, None), (None,) * 4)
INITIALS = "sua"  # the fourth is any other
FINE, CUT, GONE = range(3)  # as it should be; truncated; blank or repeated, so it must be deleted

Costs = tuple[int, int, int, int]
AT_END: Costs = (0, NEVER, NEVER, 0)


def symbol(role: str, kind: int) -> int:
    at = INITIALS.find(role[:1]) if role else -1
    return 3 * (at if at >= 0 else 3) + kind


def inserting(costs: Costs) -> Costs:
    """The least costs where turns may be inserted first; no more than two in a row can pay."""
    s, y, u, a = costs
    u, a = min(u, INSERT + a), min(a, INSERT + u)
    return min(s, INSERT + u), min(y, INSERT + u), u, a


def before(turn: int, after: Costs) -> Costs:
    """The costs in each state before a turn, given those after it."""
    role, kind = divmod(turn, 3)
    if kind == GONE:
        costs = tuple(DELETE + c for c in after)
    else:
        more, kept = TRUNCATED * kind, KEPT[role]
        costs = tuple(
            min(DELETE + after[x], REROLE + more + after[NEXT[x]], KEEP + more + after[kept[x]] if kept[x] is not None else NEVER)
            for x in range(4)
        )
    return inserting(costs)


def costs_of(turns: bytes, end: Costs) -> Costs:
    for turn in reversed(turns):
        end = before(turn, end)
    return end


def matrix(turns: bytes) -> list[int]:
    """Costs from each state before the turns to each state after them, row by row."""
    columns = [costs_of(turns, tuple(0 if x == y else NEVER for x in range(4))) for y in range(4)]
    return [min(NEVER, columns[y][x]) for x in range(4) for y in range(4)]


def through(costs: list[int], end: Costs) -> Costs:
    """The costs before a run, by its matrix, given those after it."""
    return tuple(min(NEVER, min(costs[4 * x + y] + end[y] for y in range(4))) for x in range(4))


def edits(turns: bytes, state: int, end: Costs) -> Iterator[tuple[str, int]]:
    """The ASCII-least cheapest edits from ``state``, given the costs after the last turn: letter and state after it.

    The backward pass keeps the costs at every b-th turn only, b the square root of
    the number of turns; the walk forward computes those of one block at a time anew.
    """
    size = math.isqrt(len(turns)) + 1
    starts = range(0, len(turns), size)
    checkpoints = [end]
    for start in reversed(starts):
        checkpoints.append(costs_of(turns[start : start + size], checkpoints[-1]))
    checkpoints.pop()
    for start in starts:
        block = turns[start : start + size]
        costs = [checkpoints.pop()]
        for turn in reversed(block):
            costs.append(before(turn, costs[-1]))
        for turn in block:
            here, after = costs.pop(), costs[-1]
            role, kind = divmod(turn, 3)
            while True:
                least, onward = here[state], NEXT[state]
                if least == DELETE + after[state]:
                    letter = "D"
                elif least == INSERT + here[onward]:
                    yield "I", onward
                    state = onward
                    continue
                elif kind != GONE and KEPT[role][state] is not None and least == KEEP + TRUNCATED * kind + after[KEPT[role][state]]:
                    letter, state = "K", KEPT[role][state]
                else:
                    letter, state = "R", onward
                yield letter, state
                break


def closing(state: int) -> Iterator[tuple[str, int]]:
    """The insertions after the last turn."""
    costs = inserting(AT_END)
    while costs[state]:
        state = NEXT[state]
        yield "I", state


class Run(NamedTuple):
    """What one task holds of a conversation, if it is the task's first or last."""

    part: int
    conv_id: int | None
    first: str
    last: str
    costs: list[int]


class Context(NamedTuple):
    """How a run begins and ends."""

    state: int = START
    end: Costs = inserting(AT_END)
    previous: str | None = None  # initial of the role before the run
    closes: bool = True


def _symbols(turns: list[dict]) -> bytes:
    """A byte a turn: of equal rows, the first as it is, the others to be deleted."""
    found = bytearray()
    for turn in turns:
        kind = GONE if turn["blank"] or turn["again"] else CUT if turn["truncated"] else FINE
        found.append(symbol(turn["role"], kind))
        found.extend(bytes([symbol(turn["role"], GONE)]) * (turn["copies"] - 1))
    return bytes(found)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int | None, list[dict]]]:
    """(task, conversation, turns) of each conversation in a sorted task."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for (part, conv), turns in groupby(rows, key=lambda row: (row["part"], row["conv_id"])):
        yield part, conv, list(turns)


RUNS = "part int, conv_id long, first string, last string, costs array<long>"


def _outer_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = last = None
    for run in _runs(batches):
        first, last = first or run, run
    found = [] if first is None else [first] if first is last else [first, last]
    rows = [Run(part, conv, turns[0]["role"][:1], turns[-1]["role"][:1], matrix(_symbols(turns)))._asdict() for part, conv, turns in found]
    schema = pa.schema([("part", pa.int32()), ("conv_id", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("costs", pa.list_(pa.int64()))])
    yield pa.RecordBatch.from_pylist(rows, schema=schema)


EXITS = "part int, conv_id long, exits array<int>"


def _exits(contexts: dict) -> Callable:
    """For each run that crosses into the next task, the state it is left in, by the state it is entered in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for part, conv, turns in _runs(batches):
            if (part, conv) in contexts:
                symbols, end = _symbols(turns), contexts[part, conv].end
                exits = []
                for state in range(4):
                    for _, state in edits(symbols, state, end):  # noqa: B007, PLW2901
                        pass
                    exits.append(state)
                rows.append({"part": part, "conv_id": conv, "exits": exits})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("part", pa.int32()), ("conv_id", pa.int64()), ("exits", pa.list_(pa.int32()))]))

    return run


EDITED = "conv_id long, part int, at long, edit string, role string, text string, fault string, illegal int, cost int"
_EDITED = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("at", pa.int64())]
    + [(c, pa.string()) for c in ("edit", "role", "text", "fault")]
    + [("illegal", pa.int32()), ("cost", pa.int32())]
)


def _edited_run(part: int, conv: int | None, turns: list[dict], context: Context) -> Iterator[tuple]:
    """Rows of EDITED; insertions belong to the turn that follows them."""
    symbols = _symbols(turns)
    copies = ((turn, copy) for turn in turns for copy in range(turn["copies"]))
    previous, state, at = context.previous, context.state, 0
    for letter, state in edits(symbols, state, context.end):  # noqa: B007
        if letter == "I":
            yield conv, part, at, "I", ROLES[state - USER], "", None, 0, INSERT
        else:
            turn, copy = next(copies)
            fault = "blank" if turn["blank"] else "duplicate" if turn["again"] or copy else "truncated" if turn["truncated"] else None
            initial = turn["role"][:1]
            illegal = int(previous is not None and previous + initial not in ("su", "ua", "au"))
            previous = initial
            more = TRUNCATED if fault == "truncated" else 0
            if letter == "D":
                yield conv, part, at, "D", turn["role"], None, fault, illegal, DELETE
            elif letter == "K":
                yield conv, part, at, "K", turn["role"], turn["text"], fault, illegal, KEEP + more
            else:
                yield conv, part, at, "R", ROLES[state - USER], turn["text"], fault, illegal, REROLE + more
        at += 1
    if context.closes:
        for _, state in closing(state):
            yield conv, part, at, "I", ROLES[state - USER], "", None, 0, INSERT
            at += 1


def _edit(contexts: dict) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[] for _ in _EDITED]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _EDITED, strict=True)], schema=_EDITED)

        for part, conv, turns in _runs(batches):
            for row in _edited_run(part, conv, turns, contexts.get((part, conv), Context())):
                rows.append(row)
                if len(rows) == 4096:
                    yield batch()
                    rows.clear()
        yield batch()

    return run


def _chains(runs: list[Run]) -> Iterator[list[Run]]:
    """Runs of one conversation in tasks that follow each other, if there are several."""
    for _, chain in groupby(sorted(runs, key=lambda r: r.part), key=lambda r: (r.conv_id,)):
        chain = list(chain)
        if len(chain) > 1:
            yield chain


def _ends(runs: list[Run]) -> dict:
    """The costs after each run of a chain, from the last run back."""
    found = {}
    for chain in _chains(runs):
        end = inserting(AT_END)
        for run in reversed(chain):
            found[run.part, run.conv_id] = Context(end=end, closes=run is chain[-1])
            end = through(run.costs, end)
    return found


def _entered(runs: list[Run], contexts: dict, exits: dict) -> dict:
    """The contexts with the states in which each run is entered, from the first run on."""
    found = {}
    for chain in _chains(runs):
        state, previous = START, None
        for run in chain:
            key = run.part, run.conv_id
            found[key] = contexts[key]._replace(state=state, previous=previous)
            state, previous = exits[key][state], run.last
    return found


def _tail(text: str) -> Column:
    return F.rtrim(F.col(text), F.lit(SPACE))


def _in_order(turns: DataFrame) -> DataFrame:
    """The turns with their faults, equal ones as one row with ``copies``, in order over the tasks, written."""
    same = turns.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    hashes = [F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(1)).alias("h2")]
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    # aggregated before the shuffle; only turns that occur more than once are joined back
    first = turns.select("conv_id", "role", *hashes, place.alias("place"), "copies").groupBy("conv_id", "role", "h1", "h2")
    first = first.agg(F.min("place").alias("first"), F.sum("copies").alias("n")).where("n > 1").drop("n")
    first = first.select(*(F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "h1", "h2")), "first")
    marked = same.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64("text", F.lit(1))})
    equal = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("conv_id", "role", "h1", "h2")]
    marked = marked.join(first, equal, "left").select(
        "conv_id", "turn", "role", "text", F.col("copies").cast("long").alias("copies"),
        F.coalesce(place > F.col("first"), F.lit(False)).alias("again"),
        (_tail("text") == "").alias("blank"),
        (~F.right(_tail("text"), F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    order = ["conv_id", "turn", "role", "text"]  # NULLs first
    ranged = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    return checkpointed(ranged.withColumn("part", F.spark_partition_id()))


def repaired(turns: DataFrame) -> DataFrame:
    """Every edit of every conversation in ``turns`` (conv_id, turn, role, text), in the order (conv_id, part, at).

    A row is a turn that is kept (edit K), given the role that the grammar wants
    (R), deleted (D, text NULL), or inserted (I, text empty), with the edit's cost,
    the turn's first fault (blank, duplicate, truncated) and whether its role cannot
    follow the one before it (``illegal``). Turns stand by turn, NULL first, then
    role, then text. A NULL conv_id is a conversation too; NULL roles and texts are
    one space; other columns are not looked at; no rows give none. A run's turns,
    and so one task's share of a conversation, have to fit into memory; a
    conversation as such need not.
    """
    given = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.col("copies") if "copies" in turns.columns else F.lit(1)).cast("long").alias("copies"),
    )
    ordered = _in_order(given)
    thin = ordered.select("part", "conv_id", "role", "blank", "again", "truncated", "copies")
    # two rows a task at most, of fixed size
    runs = [Run(*row) for row in thin.mapInArrow(_outer_runs, RUNS).collect()]
    contexts = _ends(runs)
    if contexts:
        exits = {(x.part, x.conv_id): x.exits for x in thin.mapInArrow(_exits(contexts), EXITS).collect()}
        contexts = _entered(runs, contexts, exits)
    return ordered.mapInArrow(_edit(contexts), EDITED)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults made by crc32(``conv_id:turn``) modulo 20.

    0 drops the row, 1 empties its text, 2 removes its full stops, exclamation and
    question marks, 3 doubles it (``copies``), 4 makes its role user.
    """
    given = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    hit = given.withColumn("hit", F.crc32(name) % 20).where("hit <> 0")
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return hit.select(
        "conv_id", "turn",
        F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("hit") == 3, 2).otherwise(1).alias("copies"),
    )


DIGESTS = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_DIGESTS = pa.schema(
    [("conv_id", pa.int64())] + [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("repaired_sha256", pa.string())]
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for batch in batches for row in batch.to_pylist())
    found = []
    for conv, steps in groupby(rows, key=lambda row: row["conv_id"]):
        counts = {"blank": 0, "duplicate": 0, "truncated": 0, None: 0}
        illegal = cost = 0
        audit, hashed, between = [], hashlib.sha256(), ""
        for step in steps:
            counts[step["fault"]] += 1
            illegal, cost = illegal + step["illegal"], cost + step["cost"]
            audit.append(step["edit"])
            if step["edit"] != "D":
                hashed.update(f"{between}{step['role']}:{step['text']}".encode("utf-8", "surrogatepass"))
                between = "\n"
        found.append((conv, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, "".join(audit), hashed.hexdigest()))
    columns = zip(*found, strict=True) if found else [[] for _ in _DIGESTS]
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _DIGESTS, strict=True)], schema=_DIGESTS)


def digests(steps: DataFrame) -> DataFrame:
    """One row per conversation of what :func:`repaired` returns: counts, cost, all edits, and a hash of what is left.

    The hash is over one text, so a conversation passes through one task, as a
    stream: nothing of it but the letters of its edits is held.
    """
    return steps.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at").mapInArrow(_digest, DIGESTS)


def gaps(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps): the turn numbers missing between the first and the last of each conversation."""
    counted = turns.groupBy("conv_id").agg(F.max("turn").alias("last"), F.min("turn").alias("first"), F.countDistinct("turn").alias("n"))
    missing = F.col("last").cast("decimal(20,0)") - F.col("first") + 1 - F.col("n")
    return counted.select("conv_id", F.coalesce(missing, F.lit(0)).cast("long").alias("gaps"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    turns = damaged(conversations)
    found = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for name, of in (("gaps", gaps(turns)), ("digest", digests(repaired(turns)))):
        of = of.withColumnRenamed("conv_id", f"{name}_conv")
        found = found.join(of, F.col("conv_id").eqNullSafe(F.col(f"{name}_conv")), "left").drop(f"{name}_conv")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
