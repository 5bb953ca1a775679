"""Repaired conversations against a search over all edit scripts."""

import hashlib
import heapq
import random
import re
import sys
import zlib

import pytest

from tabwright.llm import catalog, conversation_repair as repair
from tests.llm.test_results import FOLDER

GRAMMAR = re.compile(r"(s?(ua)+)?")
KINDS = "conv_id bigint, turn bigint, role string, text string, cost string, n int"
NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def spoil(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if role is None else role), (" " if text is None else text)
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(turns):
    """Least (cost, audit, repaired lines): every script of limited cost, cheapest first."""
    # cost, audit, turns done, place (0 nothing, 1 after s, 2 after u, 3 after a), lines
    heap, best, n = [(0, "", 0, 0, ())], None, len(turns)
    while heap:
        cost, audit, i, place, lines = heapq.heappop(heap)
        if best and cost > best[0]:
            break
        if i == n and place in (0, 3):
            best = min(best or (cost, audit, lines), (cost, audit, lines))
        follow, full, after = ("a", "assistant", 3) if place == 2 else ("u", "user", 2)
        if cost + 2 <= 3 * n:
            heapq.heappush(heap, (cost + 2, audit + "I", i, after, (*lines, full + ":")))
        if i < n:
            role, text, fault = turns[i]
            cut = fault == "truncated"
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, place, lines))
            if fault not in ("blank", "duplicate"):
                if role[:1] == follow or (role[:1] == "s" and place == 0):
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, {"s": 1, "u": 2, "a": 3}[role[0]], (*lines, f"{role}:{text}")))
                heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, after, (*lines, f"{full}:{text}")))
    return best


def table_best(turns):
    """The same by a table from the end: least cost, then least letters to the end."""
    sys.setrecursionlimit(20_000)
    n = len(turns)
    memo = {}

    def go(i, place, inserts):
        if (i, place, inserts) in memo:
            return memo[i, place, inserts]
        found = [(0, "", ())] if i == n and place in (0, 3) else []
        follow = "a" if place == 2 else "u"
        full = {"u": "user", "a": "assistant"}[follow]

        def add(cost, letter, line, rest):
            if rest is not None:
                found.append((cost + rest[0], letter + rest[1], line + rest[2]))

        if inserts < 4:
            add(2, "I", (full + ":",), go(i, 2 if follow == "u" else 3, inserts + 1))
        if i < n:
            role, text, fault = turns[i]
            cut = fault == "truncated"
            add(3, "D", (), go(i + 1, place, 0))
            if fault not in ("blank", "duplicate"):
                if role[:1] == follow or (role[:1] == "s" and place == 0):
                    add(cut, "K", (f"{role}:{text}",), go(i + 1, {"s": 1, "u": 2, "a": 3}[role[0]], 0))
                add(2 + cut, "R", (f"{full}:{text}",), go(i + 1, 2 if follow == "u" else 3, 0))
        memo[i, place, inserts] = min(found, key=lambda f: (f[0], f[1])) if found else None
        return memo[i, place, inserts]

    return go(0, 0, 0)


def expected(rows):
    """Per conversation the columns of NAMES, from rows that are not damaged any more."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).digest()))
        seen, turns, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, None: 0}
        for _, _, role, text in mine:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"
            counts[fault] += 1
            seen.add((role, text))
            turns.append((role, text, fault))
        numbers = [r[1] for r in mine if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum((a[0][:1] or " ") + (b[0][:1] or " ") not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        cost, audit, lines = table_best(turns)
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def compare(report, ids, rows):
    want = expected(rows)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in report.collect()}
    assert got == {i: want.get(i, nothing) for i in ids}


def test_search_and_table_agree():
    random.seed(31)
    for _ in range(200):
        turns = [(random.choice(["system", "user", "assistant", "tool"]), str(i), random.choice([None, None, None, "blank", "truncated"])) for i in range(random.randint(0, 4))]
        a, b = cheapest(turns), table_best(turns)
        assert a[:2] == b[:2] and a[2] == b[2]
        assert GRAMMAR.fullmatch("".join(line[0] for line in b[2]))


def test_blocks_align_as_a_search_does(monkeypatch):
    """Whole conversations and chained blocks of any size give the least cost and letters."""
    random.seed(32)
    faults = {"x": "tool", "s": "system", "u": "user", "a": "assistant"}
    for round_ in range(400):
        symbols = "".join(random.choice("suaxuauaUA-") for _ in range(random.randint(0, 12)))
        turns = [("user", "", "blank") if c == "-" else (faults[c.lower()], "t", "truncated" if c.isupper() else None) for c in symbols]
        monkeypatch.setattr(repair, "BLOCK", [24, 1, 2, 5][round_ % 4])
        assert repair._finish(repair._chain(repair._blocks(symbols), 0)) == table_best(turns)[:2]


def test_query_on_the_smallest_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    compare(catalog.QUERIES["op13_conversation_repair"](spark, FOLDER), {r[0] for r in rows}, spoil(rows))


@pytest.mark.parametrize("piece", [4096, 3])
def test_edges(spark, piece):
    random.seed(33)
    rows = [(1, None, None, None), (1, None, "user", "null turn first."), (1, 5, "", "no role."), (2, 0, "user", "　"), (2, 0, "user", "　"),
            (None, 1, "user", "no id?"), (None, None, "assistant", "x"), (3, 0, "system", " \n"), (4, 7, "assistant", "Long " * 50_000 + "."),
            (5, 0, "system", "Only."), (6, 3, "user", "A."), (6, 3, "user", "A."), (6, 3, "assistant", "B.")]
    rows += [(7, i, random.choice(["user", "assistant"]), random.choice(["yes.", "no", "", "so!"]) + str(i % 7) * (i % 3) + ".") for i in range(300)]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], KINDS)
    filled = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    compare(repair.repair_report(frame, frame, piece), {r[0] for r in rows}, filled)
    assert repair.repair_report(frame, frame.where("false")).where("audit != '' or cost != 0").count() == 0
    assert repair.repair_report(frame.where("false"), frame.where("false")).collect() == []


def test_repaired_turns(spark):
    frame = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "There?"), (1, 2, "assistant", "Yes.")], "conv_id bigint, turn bigint, role string, text string")
    report = repair.structure(frame)
    got = [tuple(r) for r in repair.repair(frame, report).collect()]
    assert got == [(1, 0, "K", 0, "user", "Hi."), (1, 1, "I", None, "assistant", ""), (1, 2, "K", 1, "user", "There?"), (1, 3, "K", 2, "assistant", "Yes.")]
