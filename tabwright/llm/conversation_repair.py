"""Conversation structure repair: turns aligned to an alternating grammar.

A conversation is well formed if its roles' first letters are nothing or ``s?(ua)+``: an
optional system turn, then user and assistant in turn. Every conversation gets the
cheapest edits to that form: Keep 0, Rerole to user or assistant 2, Delete 3 (a must for
blank and duplicate turns), Insert an empty user or assistant turn 2, and 1 more for each
truncated turn that stays. Of equally cheap edits those whose letters K, R, D, I spell the
string least in ASCII count.

Turns are sorted by range over all tasks and cut into blocks. A block is aligned by
Wagner and Fischer's table to each feasible length of the alternating string, from each
place in the grammar where it may begin. The cheapest cost so far bounds Ukkonen's band
of diagonals, and the lengths tried at all; backtraced audits are compared where costs are
equal. An audit of a block ends with its last turn (insertions belong to the turn after
them), so no audit is the start of another and audits of blocks can be chained: a
conversation of any length is dealt over many tasks, each of which gives one small
table (place of entry, place of exit) -> (cost, audit), and only these meet.

Defined cases: NULL roles and texts are one blank; an empty role fits no place; NULL ids
are one conversation; turns go by number (NULL first), then role, then digest of the
text; repeated rows are duplicate turns. An empty table gives empty tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabwright.llm.common import settle

REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
#: Turns aligned in one table; longer conversations chain such blocks.
BLOCK = 24
#: Turns that one row of chained blocks covers at most.
PIECE = 4096
_BLANKS = " \t\n\x0b\x0c\r"
_ROLES = {"u": "user", "a": "assistant"}
#: Places in the grammar: nothing yet, after s, after u, after a.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: What must still be inserted at the end, by place.
_TAIL = {_START: "", _SYSTEM: "II", _USER: "I", _ASSISTANT: ""}
_NONE = 1 << 60

Table = Callable[[int], tuple[tuple[int, int, str], ...]]


def _targets(entry: int, length: int) -> list[tuple[str, int]]:
    """Strings of a length that may follow a place, each with the place after it."""
    if not length:
        return [("", entry)]
    turns = "au" if entry == _USER else "ua"
    found = [(turns * length)[:length]]
    if entry == _START:
        found.append("s" + ("ua" * length)[: length - 1])
    return [(t, {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[t[-1]]) for t in found]


def _align(turns: str, target: str, limit: int) -> tuple[int, str] | None:
    """Least cost of turning ``turns`` into ``target`` and its least audit, if within ``limit``.

    A turn is its role's first letter (x for another), in capitals if it is truncated, or
    - if it must go. Nothing is inserted after the last turn.
    """
    n, m = len(turns), len(target)
    live = [0]
    for t in turns:
        live.append(live[-1] + (t != "-"))
    drift = m - live[n]
    least = DELETE * (n - live[n]) + (INSERT * drift if drift > 0 else -DELETE * drift)
    if least > limit:
        return None
    # A path off the diagonals between 0 and drift pays one more insertion and deletion each.
    slack = (limit - least) // (INSERT + DELETE)
    low, high = min(0, drift) - slack, max(0, drift) + slack
    table = [[_NONE] * m + [0]]
    for i in range(n - 1, -1, -1):
        below, row, t = table[-1], [_NONE] * (m + 1), turns[i]
        letter, cut = t.lower(), CUT * t.isupper()
        for j in range(min(m, live[i] + high), max(0, live[i] + low) - 1, -1):
            cost = below[j] + DELETE
            if j < m:
                if t != "-" and letter == target[j]:
                    cost = min(cost, below[j + 1] + cut)
                elif t != "-" and target[j] != "s":
                    cost = min(cost, below[j + 1] + REROLE + cut)
                if target[j] != "s":
                    cost = min(cost, row[j + 1] + INSERT)
            row[j] = min(cost, _NONE)
        table.append(row)
    table.reverse()
    if table[0][0] > limit:
        return None
    audit, i, j = [], 0, 0
    while i < n:
        cost, t = table[i][j], turns[i]
        if table[i + 1][j] + DELETE == cost:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and table[i][j + 1] + INSERT == cost:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if t.lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return table[0][0], "".join(audit)


@lru_cache(maxsize=1 << 15)
def align_block(turns: str, entry: int) -> tuple[tuple[int, int, str], ...]:
    """(exit, cost, audit) for each place a block can end at when it begins at ``entry``."""
    n, live = len(turns), len(turns) - turns.count("-")
    gone = DELETE * (n - live)
    best: dict[int, tuple[int, str]] = {}
    step = 0
    while True:
        worst = max(best[x][0] if x in best else _NONE for x in (_USER, _ASSISTANT))
        if step > live and gone + INSERT * step > worst:
            break
        for length in {live + step, live - step} if step <= live else {live + step}:
            for target, place in _targets(entry, length):
                limit = best[place][0] if place in best else DELETE * n + INSERT * length
                if (found := _align(turns, target, limit)) and (place not in best or found < best[place]):
                    best[place] = found
        step += 1
    return tuple((place, *found) for place, found in sorted(best.items()))


def _chain(tables: list[Table], entry: int) -> dict[int, tuple[int, str]]:
    """Least (cost, audit) by place at the end of consecutive blocks."""
    now: dict[int, tuple[int, int, tuple | None]] = {entry: (0, 0, None)}
    for table in tables:
        new: dict[int, tuple[tuple[int, int, str], tuple | None]] = {}
        for place, (cost, rank, link) in now.items():
            for end, more, audit in table(place):
                found = (cost + more, rank, audit)
                if end not in new or found < new[end][0]:
                    new[end] = (found, link)
        order = sorted(found[1:] for found, _ in new.values())
        now = {end: (found[0], order.index(found[1:]), (link, found[2])) for end, (found, link) in new.items()}
    out = {}
    for place, (cost, _, link) in now.items():
        audits = []
        while link is not None:
            link, audit = link
            audits.append(audit)
        out[place] = (cost, "".join(reversed(audits)))
    return out


def _blocks(turns: str) -> list[Table]:
    return [lambda entry, b=turns[i : i + BLOCK]: align_block(b, entry) for i in range(0, len(turns), BLOCK)]


def _finish(ends: dict[int, tuple[int, str]]) -> tuple[int, str]:
    return min((cost + INSERT * len(_TAIL[place]), audit + _TAIL[place]) for place, (cost, audit) in ends.items())


def _digest(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256))


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    filled = conversations.select(
        F.col(conv).alias("c"), F.col(turn).alias("t"),
        F.coalesce(F.col(role), F.lit(" ")).alias("r"), F.coalesce(F.col(text), F.lit(" ")).alias("x"),
    )
    return filled.withColumn("d", _digest(F.col("r"), F.col("x")))


def _marked(turns: DataFrame) -> DataFrame:
    """Light rows: place in the order, first letter, and the fault of each turn but repeats of its neighbour."""
    bare = F.rtrim(F.col("x"), F.lit(_BLANKS))
    light = turns.select(
        "c", "t", "r", "d", F.substring("r", 1, 1).alias("letter"), (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    firsts = (
        light.groupBy("c", "d").agg(F.min(F.struct("t")).alias("first"), F.count("*").alias("n"))
        .where("n > 1").select(F.col("c").alias("c2"), F.col("d").alias("d2"), "first")
    )
    return light.join(firsts, F.col("c").eqNullSafe(F.col("c2")) & (F.col("d") == F.col("d2")), "left").select(
        "c", "t", "r", "d", "letter", "blank", "cut",
        (F.col("first").isNotNull() & ~F.col("first.t").eqNullSafe(F.col("t"))).alias("again"),
    )


class _Piece:
    """Consecutive turns of one conversation inside a task."""

    def __init__(self, conv, whole: bool):
        self.conv, self.whole = conv, whole
        self.symbols: list[str] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.least = self.most = None
        self.first = self.last = ""

    def add(self, turn, letter: str, blank: bool, duplicate: bool, cut: bool) -> None:
        letter = letter or " "
        if self.symbols:
            self.illegal += self.last + letter not in ("su", "ua", "au")
        else:
            self.first = letter
        self.last = letter
        if turn is not None:
            self.distinct += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn
        self.blank += blank
        self.duplicate += duplicate and not blank
        if cut := cut and not blank and not duplicate:
            self.truncated += 1
        kind = letter if letter in "sua" else "x"
        self.symbols.append("-" if blank or duplicate else kind.upper() if cut else kind)


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_TABLE = T.ArrayType(T.StructType([
    T.StructField("entry", T.IntegerType()), T.StructField("exit", T.IntegerType()),
    T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
]))


def _piece_schema(conv: T.StructField, turn: T.StructField) -> T.StructType:
    return T.StructType([
        conv, T.StructField("seq", T.LongType()), T.StructField("whole", T.BooleanType()),
        *[T.StructField(n, T.LongType()) for n in (*_COUNTS, "distinct")],
        T.StructField("least", turn.dataType), T.StructField("most", turn.dataType),
        T.StructField("first", T.StringType()), T.StructField("last", T.StringType()),
        T.StructField("ends", _TABLE),
    ])


def _row(piece: _Piece, seq: int) -> dict:
    tables, ends = _blocks("".join(piece.symbols)), []
    if piece.whole:
        ends.append((_START, _ASSISTANT, *_finish(_chain(tables, _START))))
    else:
        for entry in range(4):
            ends += [(entry, end, *found) for end, found in _chain(tables, entry).items()]
    return {
        "c": piece.conv, "seq": seq, "whole": piece.whole, **{n: getattr(piece, n) for n in (*_COUNTS, "distinct", "least", "most", "first", "last")},
        "ends": [dict(zip(("entry", "exit", "cost", "audit"), e, strict=True)) for e in ends],
    }


def _pieces(batches: Iterator[pa.RecordBatch], schema: pa.Schema, longest: int) -> Iterator[pa.RecordBatch]:
    """One row for each conversation that lies inside the task, and rows to chain for the others."""
    part, seq, piece, before, out = TaskContext.get().partitionId() << 32, 0, None, None, []
    started = False

    def close(whole: bool) -> None:
        nonlocal seq
        piece.whole = piece.whole and whole
        out.append(_row(piece, part + seq))
        seq += 1

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("c", "t", "d", "letter", "blank", "cut", "again")]
        for conv, turn, digest, letter, blank, cut, again in zip(*columns, strict=True):
            if piece is None or piece.conv != conv:
                if piece is not None:
                    close(True)
                # What lies before the first conversation of a task is not known here.
                piece, started = _Piece(conv, started), True
            elif len(piece.symbols) == longest:
                close(False)
                piece = _Piece(conv, False)
            piece.add(turn, letter, blank, again or before == (conv, turn, digest), cut)
            before = (conv, turn, digest)
        if len(out) >= 256:
            yield pa.RecordBatch.from_pylist(out, schema)
            out.clear()
    if piece is not None:
        close(False)
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _meet(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """Chain the pieces of one conversation."""
    pieces = sorted(table.to_pylist(), key=lambda p: p["seq"])
    total = {n: sum(p[n] for p in pieces) for n in (*_COUNTS, "distinct")}
    most = None
    for a, b in zip(pieces, pieces[1:], strict=False):
        total["illegal"] += a["last"] + b["first"] not in ("su", "ua", "au")
        most = a["most"] if a["most"] is not None else most
        total["distinct"] -= most is not None and b["least"] == most
    turns = [t for p in pieces for t in (p["least"], p["most"]) if t is not None]

    def lookup(piece: dict) -> Table:
        return lambda entry: tuple((e["exit"], e["cost"], e["audit"]) for e in piece["ends"] if e["entry"] == entry)

    cost, audit = _finish(_chain([lookup(p) for p in pieces], _START))
    return pa.Table.from_pylist([{
        "c": pieces[0]["c"], **total, "least": min(turns, default=None), "most": max(turns, default=None), "cost": cost, "audit": audit,
    }], schema)


def structure(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece: int = PIECE) -> DataFrame:
    """One row per conversation: gaps, faults, illegal neighbours, least cost and audit."""
    marked = _marked(_turns(conversations, conv, turn, role, text))
    fields = {f.name: f for f in marked.schema.fields}
    schema = _piece_schema(fields["c"], fields["t"])
    ordered = marked.repartitionByRange("c", "t", "r", "d").sortWithinPartitions("c", "t", "r", "d")
    arrow = to_arrow_schema(schema)
    pieces = settle(ordered.mapInArrow(lambda batches: _pieces(batches, arrow, piece), schema))
    names = ["c", *_COUNTS, "distinct", "least", "most"]
    met = T.StructType([*[schema[n] for n in names], T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])
    met_arrow = to_arrow_schema(met)
    edges = pieces.where("not whole").groupBy("c").applyInArrow(lambda table: _meet(table, met_arrow), met)
    found = pieces.where("whole").select(*names, F.col("ends")[0]["cost"].alias("cost"), F.col("ends")[0]["audit"].alias("audit")).unionByName(edges)
    return found.select(
        F.col("c").alias(conv), F.coalesce(F.col("most") - F.col("least") + 1 - F.col("distinct"), F.lit(0)).cast("bigint").alias("gaps"),
        *_COUNTS, "cost", "audit",
    )


def _edited(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Turns after their edits; each conversation comes as its audit, then its turns in order."""
    out: list[dict] = []
    conv, audit, at, place, count = None, "", 0, _START, 0

    def put(edit: str, letter: str, turn, role: str, text: str) -> None:
        nonlocal place, count
        place = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[letter]
        out.append({"c": conv, "place": count, "edit": edit, "t": turn, "r": role, "x": text})
        count += 1

    def insert() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            letter = "a" if place == _USER else "u"
            put("I", letter, None, _ROLES[letter], "")
            at += 1

    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            rows = batch.slice(start, 256)
            columns = [rows.column(n).to_pylist() for n in ("c", "audit", "t", "r", "x")]
            for c, letters, turn, role, text in zip(*columns, strict=True):
                if letters is not None:
                    insert()
                    conv, audit, at, place, count = c, letters, 0, _START, 0
                    continue
                insert()
                edit = audit[at]
                at += 1
                if edit == "K":
                    put("K", role[0], turn, role, text)
                elif edit == "R":
                    letter = "a" if place == _USER else "u"
                    put("R", letter, turn, _ROLES[letter], text)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out.clear()
    insert()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def repair(conversations: DataFrame, report: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The turns of all conversations after the edits of ``report`` (from ``structure``).

    Turns of a conversation come together and in order: their place, the edit that made
    them (K, R or I), the turn number they had, role and text.
    """
    turns = _turns(conversations, conv, turn, role, text)
    heads = report.select(F.col(conv).alias("c"), "audit")
    both = turns.withColumn("head", F.lit(1)).unionByName(heads.withColumn("head", F.lit(0)), allowMissingColumns=True)
    ordered = both.repartition("c").sortWithinPartitions("c", "head", "t", "r", "d").select("c", "audit", "t", "r", "x")
    fields = {f.name: f for f in ordered.schema.fields}
    schema = T.StructType([
        fields["c"], T.StructField("place", T.LongType()), T.StructField("edit", T.StringType()), fields["t"],
        T.StructField("r", T.StringType()), T.StructField("x", T.StringType()),
    ])
    arrow = to_arrow_schema(schema)
    return ordered.mapInArrow(lambda batches: _edited(batches, arrow), schema).toDF(conv, "place", "edit", turn, role, text)


def _hashed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    conv, digest, done = None, None, []
    for batch in batches:
        for c, place, role, text in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
            if place == 0:
                if digest is not None:
                    done.append((conv, digest.hexdigest()))
                conv, digest = c, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d, strict=True)) for d in done], schema)
            done.clear()
    if digest is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (conv, digest.hexdigest()), strict=True))], schema)


def transcript_hashes(repaired: DataFrame, conv: str = "conv_id", role: str = "role", text: str = "text") -> DataFrame:
    """SHA-256 of the ``role:text`` lines of each conversation, read in the order ``repair`` gives."""
    schema = T.StructType([repaired.schema[conv], T.StructField("repaired_sha256", T.StringType())])
    arrow = to_arrow_schema(schema)
    return repaired.select(conv, "place", role, text).mapInArrow(lambda batches: _hashed(batches, arrow), schema)


def damage(conversations: DataFrame) -> DataFrame:
    """A copy with planted faults, by a checksum of conversation and turn modulo 20."""
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text"), blank)
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (
        conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), text.alias("text"), kind.alias("kind"))
        .where("kind != 0")
        .select(
            "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            copies.alias("copy"),
        )
        .drop("copy")
    )


def repair_report(conversations: DataFrame, turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """``structure`` of ``turns`` and the hash of what ``repair`` makes of them, for every id of ``conversations``."""
    report = settle(structure(turns, piece=piece))
    hashes = transcript_hashes(repair(turns, report))
    ids = conversations.select("conv_id").distinct()
    a, b = report.withColumnRenamed("conv_id", "c1"), hashes.withColumnRenamed("conv_id", "c2")
    found = ids.join(a, F.col("conv_id").eqNullSafe(F.col("c1")), "left").join(b, F.col("conv_id").eqNullSafe(F.col("c2")), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return found.select(
        "conv_id", *[F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in ("gaps", *_COUNTS, "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
