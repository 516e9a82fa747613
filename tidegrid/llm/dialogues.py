"""Conversation structure repair: cheapest edits by a persistent audit DP.

The roles of a repaired conversation read ``(s?(ua)+)?``.  Four states say what was put out so far:
nothing, a system turn, a user turn, an assistant turn.  Each state keeps its cheapest edits, of
equally cheap ones those whose initials come first.  The initials (the audit) are linked nodes: a
prefix is shared by all that continue it.  A node has its ancestors at distances 1, 2, 4, ... and a
rolling hash of its prefix, so two audits are compared at the first place where they differ, which
is found by jumps; where hashes call prefixes equal, the shared links are walked to make sure.

Two audits of equal cost over the same rows never are one the beginning of the other, as every
further initial (an insertion) costs something.  So the order of prefixes decides, and a stretch
of rows can be solved alone, once for each state before it, and put together with others later.

What decides needs no texts: rows travel as a turn, a role, a digest and flags, sorted into
partitions of like size, whatever conversation they belong to.  A conversation inside one partition
is solved there; one that crosses a border, or is long, is solved in pieces of ``PIECE`` rows, and
the pieces' tables of (state before, state after) are folded.  Only then the texts are sorted by
conversation and pass through a running SHA-256, a row at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm.common import shipped, written

PIECE = 4096
MANY = 64
_MOD, _BASE = (1 << 61) - 1, 911_382_323
_SPACES = " \t\n\x0b\x0c\r"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}


class Node:
    """The last edit of an audit, linked to the audit before it."""

    __slots__ = ("op", "depth", "hash", "up")

    def __init__(self, before: Node | None, op: str):
        self.op = op
        if before is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = before.depth + 1
        self.hash = (before.hash * _BASE + ord(op)) % _MOD
        up, at, k = [before], before, 0
        while len(at.up) > k:
            at = at.up[k]
            up.append(at)
            k += 1
        self.up = tuple(up)

    def at_depth(self, depth: int) -> Node:
        node = self
        while node.depth > depth:
            k = (node.depth - depth).bit_length() - 1
            node = node.up[min(k, len(node.up) - 1)]
        return node

    def text(self) -> str:
        out, node = [], self
        while node.depth:
            out.append(node.op)
            node = node.up[0]
        return "".join(reversed(out))


def _same(x: Node, y: Node) -> bool:
    """Whether two prefixes of equal length and hash are equal, by walking to where they meet."""
    while x is not y:
        if x.op != y.op:
            return False
        x, y = x.up[0], y.up[0]
    return True


def before(x: Node, y: Node) -> bool:
    """Whether the audit of ``x`` comes before that of ``y``."""
    if x is y:
        return False
    depth = min(x.depth, y.depth)
    a, b = x.at_depth(depth), y.at_depth(depth)
    if a is b:
        return x.depth < y.depth
    if a.hash == b.hash:
        return x.depth < y.depth if _same(a, b) else x.text() < y.text()
    # the last nodes, going back, whose hashes differ: their links meet in equal prefixes
    while a.up[0] is not b.up[0]:
        jump = 0
        for k in range(min(len(a.up), len(b.up)) - 1, -1, -1):
            if a.up[k].hash != b.up[k].hash:
                a, b, jump = a.up[k], b.up[k], 1
                break
        if not jump:
            break
    if not _same(a.up[0], b.up[0]):
        return x.text() < y.text()
    return a.op < b.op


class States:
    """Per state the cheapest (cost, audit) so far, or None."""

    def __init__(self, start: int = NOTHING):
        self.best: list = [None] * 4
        self.best[start] = (0, Node(None, ""))

    @staticmethod
    def _offer(best: list, to: int, cost: int, node: Node, op: str) -> None:
        have = best[to]
        if have is None or cost < have[0]:
            best[to] = (cost, Node(node, op))
        elif cost == have[0]:
            new = Node(node, op)
            if before(new, have[1]):
                best[to] = (cost, new)

    def insert(self) -> None:
        """What may be put in before the next row or at the end."""
        best = self.best
        for at, to in ((NOTHING, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT)):
            if best[at] is not None:
                self._offer(best, to, best[at][0] + COSTS["I"], best[at][1], "I")

    def row(self, initial: str, must_go: bool, extra: int) -> None:
        """One row: kept, given a role, or deleted."""
        self.insert()
        old, new = self.best, [None] * 4
        for at in range(4):
            if old[at] is None:
                continue
            cost, node = old[at]
            self._offer(new, at, cost + COSTS["D"], node, "D")
            if must_go:
                continue
            to = ASSISTANT if at == USER else USER
            if initial == ("a" if at == USER else "u"):
                self._offer(new, to, cost + COSTS["K"] + extra, node, "K")
            elif initial == "s" and at == NOTHING:
                self._offer(new, SYSTEM, cost + COSTS["K"] + extra, node, "K")
            self._offer(new, to, cost + COSTS["R"] + extra, node, "R")
        self.best = new

    def end(self) -> tuple[int, str]:
        self.insert()
        done = [x for x in (self.best[NOTHING], self.best[ASSISTANT]) if x is not None]
        cost, node = done[0]
        for c, n in done[1:]:
            if c < cost or c == cost and before(n, node):
                cost, node = c, n
        return cost, node.text()


class Piece:
    """Facts and solutions of consecutive rows of one conversation."""

    FACTS = ("blank", "duplicate", "truncated", "illegal", "turns")

    def __init__(self, starts: tuple[int, ...]):
        self.states = {s: States(s) for s in starts}
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.rows = 0
        self.head = self.tail = self.first = self.last = self.lo = self.hi = None
        self.removed = 0

    def _meet(self, initial: str, copies: int) -> None:
        if self.tail is None:
            self.head = initial
        elif self.tail + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.illegal += copies - 1  # no role may follow itself
        self.tail = initial

    def add(self, turn: int | None, initial: str, fault: str, copies: int) -> None:
        """``copies`` equal rows, of which the first has ``fault``, or '' for none."""
        if self.rows == 0:
            self.first = turn
        elif turn is not None and turn != self.last:
            self.turns += 1
        if self.rows == 0 and turn is not None:
            self.turns = 1
        self.last = turn
        if turn is not None:
            self.lo = turn if self.lo is None else self.lo
            self.hi = turn
        self.rows += copies
        self._meet(initial, copies)
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        if fault == "blank":
            self.blank += copies - 1
        else:
            self.duplicate += copies - 1
        for states in self.states.values():
            states.row(initial, fault in ("blank", "duplicate"), int(fault == "truncated"))
            for _ in range(copies - 1):
                states.row(initial, True, 0)

    def remove(self, turn: int | None, initial: str, fault: str, copies: int) -> None:
        """A piece of rows that all must go: insertions before them are never better than after."""
        self.first = self.last = self.lo = self.hi = turn
        self.turns = int(turn is not None)
        self.rows = self.removed = copies
        self._meet(initial, copies)
        setattr(self, fault, copies)
        self.states = {}

    def table(self) -> tuple[list, list]:
        costs, audits = [None] * 16, [None] * 16
        if self.removed:
            for s in range(4):
                costs[5 * s], audits[5 * s] = COSTS["D"] * self.removed, "D" * self.removed
        for s, states in self.states.items():
            for t, found in enumerate(states.best):
                if found is not None:
                    costs[4 * s + t], audits[4 * s + t] = found[0], found[1].text()
        return costs, audits


PIECE_FIELDS = "whole boolean, part int, piece int, rows long, blank long, duplicate long, " \
    "truncated long, illegal long, turns long, lo long, hi long, first long, last long, " \
    "head string, tail string, cost long, audit string, costs array<long>, audits array<string>"


def _piece_row(conv, piece: Piece, whole: bool, part: int, number: int) -> dict:
    row = {n: getattr(piece, n) for n in ("rows", "blank", "duplicate", "truncated", "illegal",
                                          "turns", "lo", "hi", "first", "last", "head", "tail")}
    row |= {"conv": conv, "whole": whole, "part": part, "piece": number}
    if whole:
        cost, audit = piece.states[NOTHING].end()
        return row | {"cost": cost, "audit": audit, "costs": None, "audits": None}
    costs, audits = piece.table()
    return row | {"cost": None, "audit": None, "costs": costs, "audits": audits}


def _solve(kind: pa.DataType):
    """Rows sorted by conversation and turn to pieces; see the module's docstring."""
    schema = pa.schema([("conv", kind)] + [(f.split()[0], {
        "boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "string": pa.string(),
        "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}[f.split()[1]])
        for f in PIECE_FIELDS.split(", ")])

    def pieces(rows: Iterator[tuple], part: int) -> Iterator[dict]:
        """One conversation's rows are held back until it is known whether it ends here."""
        number, first, conv, held, split = 0, True, None, [], False

        def solved(starts, whole):
            nonlocal number
            piece = Piece(starts)
            for row in held:
                piece.add(*row)
            held.clear()
            number += 1
            return _piece_row(conv, piece, whole, part, number)

        for n, (key, *row) in enumerate(rows):
            conv = key if n == 0 else conv
            if key != conv:
                if held:
                    yield solved((NOTHING,), True) if not first and not split else \
                        solved((0, 1, 2, 3), False)
                conv, first, split = key, False, False
            if row[3] > MANY:
                # the first copy may stay, the others go together
                turn, initial, fault, copies = row
                held.append((turn, initial, fault, 1))
                yield solved((0, 1, 2, 3), False)
                piece = Piece(())
                piece.remove(turn, initial, "blank" if fault == "blank" else "duplicate", copies - 1)
                number += 1
                yield _piece_row(conv, piece, False, part, number)
                split = True
                continue
            held.append(tuple(row))
            if len(held) >= PIECE:
                yield solved((0, 1, 2, 3), False)
                split = True
        if held:
            yield solved((0, 1, 2, 3), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        names = ("conv", "turn", "initial", "fault", "copies")
        rows = (row for b in batches for row in zip(*(b.column(n).to_pylist() for n in names)))
        out: list[dict] = []
        for row in pieces(rows, part):
            out.append(row)
            if len(out) >= 64:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


class _Fold:
    """Puts the pieces of one conversation together; an audit is links of whole pieces' audits."""

    def __init__(self):
        self.best: list = [(0, None), None, None, None]
        self.facts = dict.fromkeys(Piece.FACTS, 0)
        self.lo = self.hi = self.tail = self.last = None
        self.empty = True

    @staticmethod
    def _join(link, other=None) -> str:
        """The audit of ``link`` back to where ``other``, of as many pieces, meets it."""
        out = []
        while link is not None and link is not other:
            out.append(link[1])
            link, other = link[0], other and other[0]
        return "".join(reversed(out))

    def add(self, row: dict) -> None:
        for name in Piece.FACTS:
            self.facts[name] += row[name]
        if not self.empty:
            self.facts["illegal"] += self.tail + row["head"] not in ("su", "ua", "au")
            self.facts["turns"] -= row["first"] is not None and row["first"] == self.last
        self.empty, self.tail, self.last = False, row["tail"], row["last"]
        if row["hi"] is not None:
            self.lo, self.hi = row["lo"] if self.lo is None else self.lo, row["hi"]
        new: list = [None] * 4
        for s in range(4):
            for t in range(4):
                cost = row["costs"][4 * s + t]
                if self.best[s] is None or cost is None:
                    continue
                cost, link = cost + self.best[s][0], (self.best[s][1], row["audits"][4 * s + t])
                have = new[t]
                if have is None or cost < have[0] or cost == have[0] and \
                        self._join(link, have[1]) < self._join(have[1], link):
                    new[t] = (cost, link)
        self.best = new

    def result(self, conv) -> dict:
        found = []
        for at, more in ((NOTHING, ""), (ASSISTANT, ""), (USER, "I"), (SYSTEM, "II")):
            if self.best[at] is not None:
                cost, link = self.best[at]
                found.append((cost + COSTS["I"] * len(more), at, more, link))
        least = min(x[0] for x in found)
        audit = min(self._join(link) + more for cost, _, more, link in found if cost == least)
        return {"conv": conv, "gaps": _gaps(self.lo, self.hi, self.facts["turns"]), "cost": least,
                "audit": audit, **{n: self.facts[n] for n in Piece.FACTS[:4]}}


def _gaps(lo: int | None, hi: int | None, turns: int) -> int:
    return 0 if lo is None else hi - lo + 1 - turns


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _put_together(kind: pa.DataType):
    schema = pa.schema([("conv", kind)] + [(f.split()[0], pa.string() if "string" in f else pa.int64())
                                           for f in RESULT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, conv = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if fold is None or row["conv"] != conv:
                    if fold is not None:
                        out.append(fold.result(conv))
                    fold, conv = _Fold(), row["conv"]
                fold.add(row)
            yield pa.RecordBatch.from_pylist(out, schema)
        if fold is not None:
            yield pa.RecordBatch.from_pylist([fold.result(conv)], schema)
    return run


class _Writer:
    """Follows an audit over a conversation's rows and digests what is left of them."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.some = audit, 0, NOTHING, False
        self.digest = hashlib.sha256()

    def _put(self, role: str, text: str, state: int) -> None:
        self.digest.update(("\n" * self.some + role + ":" + text).encode())
        self.some, self.state = True, state

    def _next(self) -> tuple[str, int]:
        return ("assistant", ASSISTANT) if self.state == USER else ("user", USER)

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role, state = self._next()
            self._put(role, "", state)
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        op = self.audit[self.at]
        self.at += 1
        if op == "R":
            role, state = self._next()
            self._put(role, text, state)
        elif op == "K":
            self._put(role, text, SYSTEM if role[0] == "s" else self._next()[1])

    def result(self) -> str:
        self.inserts()
        return self.digest.hexdigest()


def _write(kind: pa.DataType):
    schema = pa.schema([("conv", kind), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, conv = None, None
        for batch in batches:
            out = []
            for key, audit, role, text, copies in zip(
                    *(batch.column(n).to_pylist()
                      for n in ("conv", "audit", "role", "text", "copies"))):
                if audit is not None:
                    if writer is not None:
                        out.append({"conv": conv, "repaired_sha256": writer.result()})
                    writer, conv = _Writer(audit), key
                else:
                    for _ in range(copies):
                        writer.row(role, text)
            yield pa.RecordBatch.from_pylist(out, schema)
        if writer is not None:
            yield pa.RecordBatch.from_pylist(
                [{"conv": conv, "repaired_sha256": writer.result()}], schema)
    return run


def damaged(convs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(conv, turn, role, text, copies) after damage that a checksum of the row's place decides.

    One row in twenty each is dropped, emptied, loses its sentence ends, comes twice, or becomes a
    user's.  Nulls count as one space, in the checksum too.
    """
    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(filled(conv), F.lit(":"), filled(turn))) % 20
    rows = convs.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                        filled(role).alias("role"), filled(text).alias("text"),
                        kind.cast("int").alias("kind")).where("kind <> 0")
    return rows.select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


def plain(convs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """(conv, turn, role, text, copies) of conversations as they are; nulls count as one space."""
    return convs.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
        F.lit(1).cast("long").alias("copies"))


def repairs(rows: DataFrame) -> DataFrame:
    """What is wrong with each conversation of ``rows`` (conv, turn, role, text, copies), the
    cheapest repair and the digest of what it leaves: (conv, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256).

    Rows stand by turn, nulls first, equal turns by role and by a digest of the text.  A row's first
    fault counts: blank, duplicate (role and text seen before), truncated (no ``.``, ``!`` or ``?``
    at the end).  A role's initial is its first character; an empty role has none, follows nothing
    and cannot be kept.  Kept rows cost 0, rows given the role user or assistant 2, deleted rows 3
    (blank and duplicate ones must go), inserted empty ones 2, truncated rows that stay 1 more.
    Of the cheapest edits those with the least initials count (D, I, K, R).  A null ``conv`` is a
    conversation like any other.  Equal rows are counted, not listed; a conversation with most of
    the rows is solved in many tasks, only its digest needs one that reads its rows in order.
    """
    spark = shipped(rows.sparkSession)
    kind = pa_type(rows.schema["conv"].dataType)
    conv_type = rows.schema["conv"].dataType.simpleString()
    trimmed = F.trim(F.col("text"), F.lit(_SPACES))
    light = rows.select(
        "conv", "turn", "role", F.md5("text").alias("digest"), F.substring("role", 1, 1).alias("initial"),
        F.when(trimmed == "", "blank").when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "truncated")
        .otherwise("").alias("state"), "copies")
    light = light.groupBy("conv", "turn", "role", "digest", "initial", "state") \
        .agg(F.sum("copies").alias("copies"))
    # where the same role and text first came
    first = light.groupBy("conv", "role", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min("turn").alias("least"),
        F.max(F.col("turn").isNull()).alias("untimed")).where("n > 1") \
        .select(F.col("conv").alias("_conv"), F.col("role").alias("_role"),
                F.col("digest").alias("_digest"), "least", "untimed")
    again = F.col("turn").isNotNull() & (F.col("untimed") | (F.col("turn") > F.col("least")))
    marked = light.join(first, F.col("conv").eqNullSafe(F.col("_conv"))
                        & (F.col("role") == F.col("_role"))
                        & (F.col("digest") == F.col("_digest")), "left") \
        .withColumn("fault", F.when((F.col("state") != "blank") & again, "duplicate")
                    .otherwise(F.col("state")))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest"]
    placed = marked.select("conv", "turn", "role", "digest", "initial", "fault", "copies") \
        .repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = written(placed.select("conv", "turn", "initial", "fault", "copies").mapInArrow(
        _solve(kind), f"conv {conv_type}, {PIECE_FIELDS}"), "pieces")
    whole = pieces.where("whole").select(
        "conv", F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("turns"), F.lit(0).cast("long"))
        .alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    cut = pieces.where("not whole").repartition("conv") \
        .sortWithinPartitions(F.col("conv"), "part", "piece") \
        .mapInArrow(_put_together(kind), f"conv {conv_type}, {RESULT}")
    solved = written(whole.unionByName(cut), "audits")
    # the audit comes first, then the rows in the order in which it was made
    heads = solved.select("conv", "audit", *[F.lit(None).cast(t).alias(n) for n, t in (
        ("turn", "long"), ("role", "string"), ("text", "string"), ("copies", "long"),
        ("digest", "string"))])
    body = rows.withColumn("audit", F.lit(None).cast("string")).withColumn("digest", F.md5("text"))
    both = heads.unionByName(body.select(*heads.columns))
    digests = both.repartition("conv").sortWithinPartitions(
        F.col("conv"), F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "digest") \
        .select("conv", "audit", "role", "text", "copies") \
        .mapInArrow(_write(kind), f"conv {conv_type}, repaired_sha256 string") \
        .withColumnRenamed("conv", "_conv")
    return solved.join(digests, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv")


def pa_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def repair(convs: DataFrame, damage: bool = False, conv: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text") -> DataFrame:
    """:func:`repairs` of every conversation of ``convs``, with ``damage`` after :func:`damaged`.

    One row a conversation, its key under its own name.  A conversation without rows left has zeros,
    an empty audit and the digest of nothing.  Other columns are not read; an empty table gives an
    empty one.
    """
    rows = (damaged if damage else plain)(convs, conv, turn, role, text)
    found = repairs(rows)
    zero = F.lit(0).cast("long")
    return convs.select(F.col(conv).alias("_id")).distinct() \
        .join(found, F.col("_id").eqNullSafe(F.col("conv")), "left") \
        .select(F.col("_id").alias(conv),
                *[F.coalesce(n, zero).alias(n) for n in (
                    "gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                F.coalesce("audit", F.lit("")).alias("audit"),
                F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
