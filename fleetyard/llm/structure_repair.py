"""Conversation structure repair: the cheapest edits that make a conversation well formed.

A conversation is read by turn; its rows are kept, given a new role, deleted,
or empty turns are inserted, so that the role initials read ``(s?(ua)+)?`` at
least cost. Ways of editing are paths through a lattice: a node is (rows read,
what the turns so far end in), an arc one edit with an integer cost.

``auction`` finds shortest paths by the auction algorithm: every node has a
price, never more than any arc from it plus the price at its end. A path grows
from the origin along tight arcs; where none leaves its last node, that node's
price rises to the least of its arcs and the path shrinks by it. When the path
reaches the destination, prices along it are distances, and every cheapest way
uses tight arcs only. ``trace`` follows the tight arcs in letter order, so of
equally cheap ways the one whose letters come first is taken.

Long conversations are cut into blocks of BLOCK rows. From the last block to
the first, the prices of a block's four entry nodes become the costs of the
exits of the block before it; then blocks are traced in order, so the work
follows the number of rows and holds four prices a block.

Spark deals conversations out by id. A row's text is moved once; beside it go
narrow rows (place, checksum and faults), which come first in a conversation's
order, so a task knows a conversation's edits when its texts stream by and
holds one byte per row, never texts. Repeated rows are found by a window over
the narrow rows.

Odd input: rows of one turn are taken by role and text checksum, null turns
first, null roles and texts as one space; a null id is a conversation like any
other; a role of another initial than s, u, a can only be replaced or deleted;
other columns are ignored; a conversation without rows, and an empty table,
need no edits. Texts may be of any length, a row at a time.
"""
from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetyard.llm.frames import map_stream

# Costs of edits; a truncated row that stays adds TRUNCATED.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# Bits of a row's code: its initial, then its first fault.
OTHER, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
BLANK, DUPLICATE, CUT = 4, 8, 16
# States: no turn yet, a system turn, ends in a user turn, ends in an assistant turn.
EMPTY, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = 0, 1, 2, 3
_KEEP = {(EMPTY, SYSTEM): AFTER_SYSTEM, (EMPTY, USER): AFTER_USER, (AFTER_SYSTEM, USER): AFTER_USER,
         (AFTER_ASSISTANT, USER): AFTER_USER, (AFTER_USER, ASSISTANT): AFTER_ASSISTANT}
_NEXT = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)
_ROLE = {AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}
_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
BLOCK = 32
SPACE = " \t\n\x0b\f\r"

Arcs = list[list[tuple[str, int, int]]]


def lattice(codes: bytes, exits: Sequence[int] | None) -> Arcs:
    """Arcs (letter, node, cost) of every node 4 * rows + state, in letter order.

    The last node is the destination. ``exits``: the cost of leaving by each
    state; None at a conversation's end, where it must be well formed.
    """
    n = len(codes)
    arcs: Arcs = []
    for i, code in enumerate(codes):
        stays = not code & (BLANK | DUPLICATE)
        extra = TRUNCATED if code & CUT else 0
        for state in range(4):
            out = [("D", 4 * (i + 1) + state, DELETE), ("I", 4 * i + _NEXT[state], INSERT)]
            if stays:
                kept = _KEEP.get((state, code & 3))
                if kept is not None:
                    out.append(("K", 4 * (i + 1) + kept, extra))
                out.append(("R", 4 * (i + 1) + _NEXT[state], REROLE + extra))
            arcs.append(out)
    end = 4 * (n + 1)
    for state in range(4):
        if exits is not None:
            arcs.append([("", end, exits[state])])
        else:
            done = [("", end, 0)] if state in (EMPTY, AFTER_ASSISTANT) else []
            arcs.append([*done, ("I", 4 * n + _NEXT[state], INSERT)])
    arcs.append([])
    return arcs


def auction(arcs: Arcs, prices: list[int], origin: int) -> int:
    """Distance from the origin to the last node. ``prices`` (feasible: never above
    an arc plus the price at its end) rise in place and stay feasible."""
    end = len(arcs) - 1
    path = [origin]
    while path[-1] != end:
        node = path[-1]
        least, ahead = min((cost + prices[to], to) for _, to, cost in arcs[node])
        if prices[node] < least:
            prices[node] = least
            if len(path) > 1:
                path.pop()
        else:
            path.append(ahead)
    return prices[origin]


def trace(arcs: Arcs, prices: list[int], origin: int) -> tuple[str, int]:
    """Letters of the first way, in letter order, along tight arcs to the last
    node, and the node before it. Tight arcs may lead to dead ends: left again."""
    end = len(arcs) - 1
    way, letters, dead = [origin], [], set()
    while way[-1] != end:
        node = way[-1]
        for letter, to, cost in arcs[node]:
            if prices[node] == cost + prices[to] and to not in dead:
                way.append(to)
                letters.append(letter)
                break
        else:
            dead.add(node)
            way.pop()
            letters.pop()
    return "".join(letters), way[-2]


def cheapest(codes: bytes) -> tuple[int, str]:
    """Cost and letters of the cheapest edits of a conversation, the first of equally cheap ones."""
    blocks = [codes[i:i + BLOCK] for i in range(0, len(codes), BLOCK)] or [b""]
    exits: list[list[int] | None] = [None] * len(blocks)
    for b in range(len(blocks) - 1, 0, -1):
        arcs, base = _shifted(blocks[b], exits[b])
        prices = [0] * len(arcs)
        exits[b - 1] = [base + auction(arcs, prices, state) for state in range(4)]
    total, state, letters = 0, EMPTY, []
    for b, block in enumerate(blocks):
        arcs, base = _shifted(block, exits[b])
        prices = [0] * len(arcs)
        cost = auction(arcs, prices, state) + base
        total = total if b else cost
        part, last = trace(arcs, prices, state)
        letters.append(part)
        state = last % 4
    return total, "".join(letters)


def _shifted(block: bytes, exits: list[int] | None) -> tuple[Arcs, int]:
    """The lattice with exits less their least cost, and that cost: prices start near the distances."""
    base = min(exits) if exits else 0
    return lattice(block, [x - base for x in exits] if exits else None), base


_remembered = lru_cache(maxsize=1 << 14)(cheapest)


def edits(codes: bytes) -> tuple[int, str]:
    return _remembered(codes) if len(codes) <= BLOCK else cheapest(codes)


def _faults(role: Column, text: Column) -> Column:
    """A row's code without duplicates."""
    shown = F.rtrim(text, F.lit(SPACE))
    first = F.substring(role, 1, 1)
    initial = (F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(OTHER))
    return initial + F.when(shown == "", BLANK).when(F.substring(shown, -1, 1).isin(".", "!", "?"), 0).otherwise(CUT)


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
ROWS = "conv_id long, place long, edit string, role string, text string, " + ", ".join(f"{c} long" for c in REPORT)


class _Conversation:
    """What is known of the conversation that streams by."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.last = conv_id, bytearray(), None
        self.turns, self.least, self.most, self.illegal = 0, None, None, 0
        self.letters, self.cost, self.place, self.state = None, 0, 0, EMPTY

    def fault(self, turn, code):
        if self.codes and (self.codes[-1] & 3, code & 3) not in _LEGAL:
            self.illegal += 1
        self.codes.append(code)
        if turn is not None and turn != self.most:
            self.turns += 1
            self.least, self.most = turn if self.least is None else self.least, turn

    def settle(self):
        if self.letters is None:
            self.cost, self.letters = edits(bytes(self.codes))

    def edit(self, role, text):
        """Output of the next row: inserted turns before it, then itself."""
        self.settle()
        while self.letters[self.place] == "I":
            yield self.insert()
        letter = self.letters[self.place]
        if letter == "R":
            self.state = _NEXT[self.state]
            role = _ROLE[self.state]
        elif letter == "K":
            self.state = _KEEP[self.state, {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]]
        yield self.row(letter, role, text)

    def insert(self):
        self.state = _NEXT[self.state]
        return self.row("I", _ROLE[self.state], "")

    def row(self, letter, role, text):
        self.place += 1
        return (self.conv_id, self.place - 1, letter, role, text, *[None] * len(REPORT))

    def close(self):
        self.settle()
        while self.place < len(self.letters):
            yield self.insert()
        count = lambda bit: sum(1 for c in self.codes if c & bit)
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        yield (self.conv_id, self.place, None, None, None,
               gaps, count(BLANK), count(DUPLICATE), count(CUT), self.illegal, self.cost)


def _batches(rows, schema: pa.Schema, most_rows: int = 2000, most_chars: int = 1 << 22):
    """Tuples as record batches of bounded size."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= most_rows or chars >= most_chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


_ROW_SCHEMA = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                         ("text", pa.string()), *[(c, pa.int64()) for c in REPORT]])


def _stream(batches):
    def rows():
        now = None
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                for conv_id, turn, role, text, code in zip(*[c.to_pylist() for c in batch.slice(at, 1000).columns]):
                    if now is None or now.conv_id != conv_id:
                        if now is not None:
                            yield from now.close()
                        now = _Conversation(conv_id)
                    if code is not None:
                        now.fault(turn, code)
                    elif text is not None:
                        yield from now.edit(role, text)
        if now is not None:
            yield from now.close()

    yield from _batches(rows(), _ROW_SCHEMA)


def repair(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Edited rows of every conversation, and a last row with its report.

    ``turns``: conv_id, turn, role, text. Columns: conv_id, place (from 0 in
    order), edit (K, R, D or I), role and text after the edit (a deleted row
    has its own). The last row of a conversation has a null edit and gaps,
    blank, duplicate, truncated, illegal (before repair) and cost.
    ``conversations``: ids to report on even if they have no rows. Rows come
    out by conversation in order of place within their partition.
    """
    fill = lambda c: F.coalesce(F.col(c), F.lit(" "))
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     fill("role").alias("role"), fill("text").alias("text"))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
                            .cast("binary"), 256))
    t = t.withColumn("digest", digest)
    none = F.lit(None)
    seen = F.row_number().over(Window.partitionBy("conv_id", "digest").orderBy("turn")) > 1
    narrow = t.select("conv_id", "turn", "role", "digest", _faults(F.col("role"), F.col("text")).alias("code"))
    narrow = narrow.withColumn("again", seen)
    fresh = F.col("code").bitwiseAND(3)
    code = F.when(F.col("again") & (F.col("code").bitwiseAND(BLANK) == 0), fresh + DUPLICATE).otherwise(F.col("code"))
    narrow = narrow.select("conv_id", F.lit(0).alias("phase"), "turn", "role", "digest", "again",
                           none.cast("string").alias("text"), code.alias("code"))
    whole = t.select("conv_id", F.lit(1).alias("phase"), "turn", "role", "digest", F.lit(False).alias("again"), "text",
                     none.cast("int").alias("code"))
    rows = narrow.union(whole)
    if conversations is not None:
        ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
        rows = rows.union(ids.select("conv_id", F.lit(0), none.cast("long"), none.cast("string"), none.cast("binary"),
                                     F.lit(False), none.cast("string"), none.cast("int")))
    rows = (rows.repartition("conv_id").sortWithinPartitions("conv_id", "phase", "turn", "role", "digest", "again")
            .select("conv_id", "turn", "role", "text", "code"))
    return rows.transform(map_stream, _stream, ROWS)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut short, repeated and misattributed,
    by the checksum of ``conv_id:turn`` modulo 20 (0, 1, 2, 3, 4); nulls are one space."""
    fill = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(fill("conv_id"), F.lit(":"), fill("turn")).cast("binary")) % 20
    c = conversations.select("conv_id", "turn", fill("role").alias("role"), fill("text").alias("text"), kind.alias("kind"))
    c = c.filter("kind != 0").withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1)))
                                                           .otherwise(F.array(F.lit(0)))))
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    return c.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text"))


DIGEST = ("conv_id long, " + ", ".join(f"{c} long" for c in REPORT) + ", audit string, repaired_sha256 string")


def _digests(batches):
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in REPORT],
                        ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def rows():
        audit, said, first = [], hashlib.sha256(), True
        for batch in batches:
            for conv_id, _, edit, role, text, *report in zip(*[c.to_pylist() for c in batch.columns]):
                if edit is None:
                    yield (conv_id, *report, "".join(audit), said.hexdigest())
                    audit, said, first = [], hashlib.sha256(), True
                    continue
                audit.append(edit)
                if edit != "D":
                    said.update((f"{role}:{text}" if first else f"\n{role}:{text}").encode())
                    first = False

    yield from _batches(rows(), schema)


def repair_digest(conversations: DataFrame) -> DataFrame:
    """One row per conversation: the report, letters and digest of its damaged rows' repair."""
    return repair(damaged(conversations), conversations).transform(map_stream, _digests, DIGEST)
