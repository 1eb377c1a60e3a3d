import hashlib
import random
import re
import zlib
from functools import lru_cache
from itertools import product

import pytest

from voltdrift.llm import conversation_repair as c
from voltdrift.llm.conversation_repair import op11_conversation_repair

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
WHOLE = re.compile(r"(s?(ua)+)?")


def damage(rows):
    """Rows (conv, turn, role, text) after damage, in order, by conversation."""
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, [])
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if hit:
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            found[conv] += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return {k: sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for k, v in found.items()}


def faults(turns):
    seen, found = set(), []
    for _, role, text in turns:
        tail = text.strip(SPACES)
        found.append("blank" if not tail else "duplicate" if (role, text) in seen else "truncated" if tail[-1] not in ".!?" else None)
        seen.add((role, text))
    return found


def cheapest(turns):
    """(cost, audit, repaired turns), by all suffixes and role strings so far."""
    marks = faults(turns)

    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        options = []
        if i == len(turns) and state in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            for role in ("user", "assistant"):
                if legal(state, role[0]):
                    cost, audit, rest = best(i, role[0], inserted + 1)
                    options.append((cost + 2, "I" + audit, ((role, ""), *rest)))
        if i < len(turns):
            _, role, text = turns[i]
            cost, audit, rest = best(i + 1, state, 0)
            options.append((cost + 3, "D" + audit, rest))
            if marks[i] not in ("blank", "duplicate"):
                more = int(marks[i] == "truncated")
                for to, price, letter in ((role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    if legal(state, to[:1]):
                        cost, audit, rest = best(i + 1, to[:1], 0)
                        options.append((cost + price + more, letter + audit, ((to, text), *rest)))
        return min(options, default=(1 << 50, "~", ()))

    for i in range(len(turns), 0, -1):  # fills the cache from the end, so that no call goes deep
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    return best(0, "", 0)


def legal(state, initial):
    return initial != "" and state + initial in ("s", "u", "su", "ua", "au")


def exhaustive(turns):
    """(cost, audit) among all edits with up to two insertions at each place."""
    marks, options = faults(turns), []
    between = [x for n in range(3) for x in product("ua", repeat=n)]
    each = [[("D", "", 3)] if m in ("blank", "duplicate") else [("D", "", 3), ("K", r[:1], m == "truncated"), ("R", "u", 2 + (m == "truncated")), ("R", "a", 2 + (m == "truncated"))]
            for (_, r, _), m in zip(turns, marks, strict=True)]
    for edits in product(*each):
        for added in product(between, repeat=len(turns) + 1):
            audit, roles, cost = "", "", 0
            for i, new in enumerate(added):
                audit, roles, cost = audit + "I" * len(new), roles + "".join(new), cost + 2 * len(new)
                if i < len(turns):
                    letter, role, price = edits[i]
                    audit, roles, cost = audit + letter, roles + (role or ("?" if letter == "K" else "")), cost + price
            if WHOLE.fullmatch(roles):
                options.append((cost, audit))
    return min(options)


def expected(rows):
    found = set()
    for conv, turns in damage(rows).items():
        marks = faults(turns)
        known = [t for t, _, _ in turns if t is not None]
        cost, audit, rest = cheapest(turns)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        found.add((
            conv, max(known) - min(known) + 1 - len(set(known)) if known else 0,
            marks.count("blank"), marks.count("duplicate"), marks.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rest).encode()).hexdigest(),
        ))
    return found


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found(frame):
    return {tuple(r) for r in frame.select(COLUMNS).collect()}


def random_rows(seed, conversations=40, most=12):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "u"]
    texts = ["Fine.", "Cut", " \t\n", "", None, "Why?  ", "Twice.", "é! ", "a.b", "."]
    return [
        (conv if conv else None, r.choice([n, n, n, None, n // 2]), r.choices(roles, [6, 6, 2, 1, 1, 1, 1])[0], r.choice(texts))
        for conv in range(conversations) for n in range(r.randrange(1, most))
    ]


def test_exhaustive_search_agrees_with_suffixes():
    for rows in (random_rows(7, 25, 3), random_rows(8, 25, 3)):
        for turns in damage(rows).values():
            assert exhaustive(turns) == cheapest(turns)[:2]


@pytest.mark.parametrize("turns", [0, 1, 2, 3, 10, 99, 400])
def test_walk_matches_suffixes_and_runs_compose(turns):
    r = random.Random(turns)
    for _ in range(5):
        rows = [(n, r.choice(["user", "assistant", "system", "x"]), r.choice([f"{n}.", f"{n}", "", "Same."])) for n in range(turns)]
        marks = faults(rows)
        symbols = bytes(c.symbol(role, {"truncated": c.CUT, None: c.FINE}.get(m, c.GONE)) for (_, role, _), m in zip(rows, marks, strict=True))
        cost, audit, _ = cheapest(rows)
        end = c.inserting(c.AT_END)
        whole = c.costs_of(symbols, end)
        assert c.inserting(whole)[c.START] == cost
        cut = r.randrange(turns + 1)
        middle = c.costs_of(symbols[cut:], end)
        assert c.through(c.matrix(symbols[:cut]), middle) == whole == c.costs_of(symbols[:cut], middle)
        letters, state = "", c.START
        for piece, after in ((symbols[:cut], middle), (symbols[cut:], end)):
            for letter, state in c.edits(piece, state, after):
                letters += letter
        assert letters + "".join(x for x, _ in c.closing(state)) == audit


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_query_matches_brute_force(spark, tmp_path, partitions):
    rows = random_rows(partitions) + [(500, n, "user" if n % 3 else "assistant", f"Turn {n}.") for n in range(300)]
    rows += [(501, 1, "user", "Again.")] * 30 + [(502, None, None, None), (503, 2, "user", "long " * 30000)]
    frame = spark.createDataFrame([(*x, "y", 1) for x in rows], "conv_id long, turn long, role string, text string, part string, copies int")
    frame.repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        assert found(op11_conversation_repair(spark, str(tmp_path))) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op11_conversation_repair(spark, "/root/testdata/sf0.01")) == expected(rows)


def test_nothing(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert found(op11_conversation_repair(spark, str(tmp_path))) == set()
