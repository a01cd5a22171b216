"""Chat formatting by event sourcing: logs are folded to final messages, then rendered.

A log has one row per event: conv_id, the columns that name a message (they
order the messages of a conversation), the columns that order its events, kind
and body.

* ``open``: the message begins; body is its role;
* ``delta``: body is added to the text;
* ``edit``: body replaces the text, and every later message as it was then goes;
* ``regenerate``: the text is dropped and streamed anew; later messages go likewise.

So an event counts unless a later ``edit`` or ``regenerate`` falls on its own
or an earlier message. Logs are dealt out by conversation and block of
messages; ``fold`` finds, for every message, the last such event on it or before
it (a running maximum in the block, and one over the conversation's blocks),
and joins what follows it in order. A long conversation is no group of its own,
and texts are dealt out once for log, fold and rendering. ``render`` writes the messages in
parts of at most PART turns with a loss mask; ``parse`` reads parts back. All
of it is DataFrame and SQL functions.

Odd input: null ids name a conversation like any other; a null role or text is
empty; null places come first; an event delivered twice counts once; events at
one place are taken by kind and body; unknown kinds change nothing; a message
whose events are all dropped is none. Other columns are ignored. An empty log
has no messages. Texts of any length are whole; one message has to fit in a row.
"""
from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Turns in a rendered part; turns (of a log derived from them) in a block.
PART, BLOCK = 64, 64
# Code points in a streamed delta of a derived log.
DELTA = 256


@dataclass(frozen=True)
class Template:
    """Marks around a turn. A text's control strings are cut by a backslash
    after their first character, and its backslashes doubled."""

    head: str = "<|turn|>"
    mid: str = "<|text|>"
    tail: str = "<|done|>\n"

    def __post_init__(self):
        first = {m[:1] for m in self.marks}
        if any(not m or "\\" in m or any(c in first for c in m[1:]) for m in self.marks):
            raise ValueError("a mark's first character must not occur again in any mark; no backslashes")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.head, self.mid, self.tail

    def escaped(self, text: Column) -> Column:
        inside = "|".join(f"(?<={re.escape(m[0])})(?={re.escape(m[1:])})" for m in self.marks)
        return F.regexp_replace(text, rf"\\|{inside}", r"\\$0")

    @staticmethod
    def plain(text: Column) -> Column:
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")

    def turn(self, role: Column, text: Column) -> Column:
        return F.concat(F.lit(self.head), self.escaped(role), F.lit(self.mid), self.escaped(text), F.lit(self.tail))


def block_key(block: Column) -> Column:
    """What rows are dealt out by: the conversation and a block of its messages. Carried
    from the log to the rendered parts, so that texts are dealt out once."""
    return F.struct("conv_id", block.alias("block"))


def event_log(turns: DataFrame) -> DataFrame:
    """The log that streams the given turns (conv_id, turn, role, text).

    Every turn is opened and streamed in deltas of DELTA code points. By the
    checksum of its place, a quarter of the assistant turns is first drafted
    and regenerated, and a quarter of the others written short and edited.
    Turns with the same number are numbered by role and text (column copy).
    Messages are named by (turn, copy), events ordered by (turn, copy, step);
    ``p`` is the key of the message's block of BLOCK turns.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    t = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    t = t.withColumn("p", block_key(F.floor(F.col("turn") / BLOCK))).drop("conv_id").repartition("p")
    t = t.withColumn("copy", F.row_number().over(Window.partitionBy("p", "turn").orderBy("role", "text")))

    def event(kind: str, body: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), body.alias("body"))

    def deltas(x: Column) -> Column:
        pieces = F.regexp_extract_all(x, F.lit(f"(?s).{{1,{DELTA}}}"), F.lit(0))
        return F.transform(pieces, lambda p: event("delta", p))

    whole, short = deltas(F.col("text")), F.expr("left(text, int(length(text) / 2))")
    revised = F.crc32(F.concat_ws(":", "p.conv_id", "turn").cast("binary")) % 4 == 0
    start = F.array(event("open", F.col("role")))
    log = (F.when(revised & (F.col("role") == "assistant"),
                  F.concat(start, deltas(F.concat(short, F.lit(" ..."))),
                           F.array(event("regenerate", F.lit(None).cast("string"))), whole))
           .when(revised, F.concat(start, deltas(short), F.array(event("edit", F.col("text")))))
           .otherwise(F.concat(start, whole)))
    return (t.select("p", "turn", "copy", F.posexplode(log).alias("step", "e"))
            .select("p", "turn", "copy", "step", "e.kind", "e.body"))


def fold(events: DataFrame, message: Sequence[str] = ("message",), order: Sequence[str] = ("seq",)) -> DataFrame:
    """Final messages: ``p``, the ``message`` columns, role and text.

    ``events`` have conv_id, and in their first message column a number, of
    which BLOCK make a block; or the key of a block, ``p``, which never falls
    from one message of a conversation to the next.
    """
    key = F.col("p") if "p" in events.columns else block_key(F.floor(F.col(message[0]) / BLOCK))
    e = events.select(key.alias("p"), F.struct(*message).alias("place"), F.struct(*order).alias("at"), "kind", "body")
    resets = F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.col("at")))
    e = e.withColumn("latest", resets.over(Window.partitionBy("p")))
    # Narrow: the last reset in the blocks before.
    blocks = e.groupBy("p").agg(F.first("latest").alias("latest"))
    before = Window.partitionBy("p.conv_id").orderBy("p.block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("p", F.max("latest").over(before).alias("earlier"))
    log = F.sort_array(F.collect_set(F.struct("at", "kind", "body")))
    told = e.groupBy("p", "place").agg(log.alias("log"), resets.alias("reset"))
    so_far = Window.partitionBy("p").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    told = told.withColumn("here", F.max("reset").over(so_far)).join(blocks, "p")
    live = told.withColumn("cut", F.greatest("here", "earlier")).withColumn(
        "live", F.filter("log", lambda x: F.col("cut").isNull() | (x["at"] >= F.col("cut"))))
    opened = F.filter("log", lambda x: x["kind"] == "open")
    body = F.transform(F.filter("live", lambda x: x["kind"].isin("delta", "edit")),
                       lambda x: F.coalesce(x["body"], F.lit("")))
    known = F.exists("live", lambda x: x["kind"].isin("open", "delta", "edit", "regenerate"))
    return live.filter(known).select(
        "p", "place.*", F.coalesce(F.try_element_at(opened, F.lit(-1))["body"], F.lit("")).alias("role"),
        F.array_join(body, "").alias("text"))


def render(messages: DataFrame, message: Sequence[str] = ("message",), template: Template = Template(),
           learn: str = "assistant") -> DataFrame:
    """conv_id, block, part, n_turns, formatted, mask: (block, part) order a conversation's
    parts; mask has (start, stop), in code points of ``formatted``, of each text of role ``learn``."""
    m = messages.select("p", F.struct(*message, "role", "text").alias("at"), "role",
                        F.length(template.escaped(F.col("text"))).alias("inside"),
                        template.turn(F.col("role"), F.col("text")).alias("piece"))
    m = m.withColumn("part", F.floor((F.row_number().over(Window.partitionBy("p").orderBy("at")) - 1) / PART))
    upto = Window.partitionBy("p", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    m = m.withColumn("stop", F.sum(F.length("piece").cast("long")).over(upto) - len(template.tail))
    m = m.withColumn("start", F.when(F.col("role") == learn, F.col("stop") - F.col("inside")))
    g = m.groupBy("p", "part").agg(F.sort_array(F.collect_list(F.struct("stop", "start", "piece"))).alias("t"))
    spans = F.transform(F.filter("t", lambda x: x["start"].isNotNull()),
                        lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop")))
    return g.select("p.conv_id", "p.block", "part", F.size("t").cast("long").alias("n_turns"),
                    F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"), spans.alias("mask"))


def parse(parts: DataFrame, template: Template = Template()) -> DataFrame:
    """Rendered parts with their turns (role, text) and learnt texts read back from
    ``formatted`` and ``mask``."""
    quoted = [re.escape(m) for m in template.marks]
    turns = F.split("formatted", quoted[2])
    turns = F.slice(turns, F.lit(1), F.size(turns) - 1)

    def read(turn: Column) -> Column:
        two = F.split(F.substring(turn, F.lit(len(template.head) + 1), F.length(turn)), quoted[1], 2)
        return F.struct(template.plain(two[0]).alias("role"), template.plain(two[1]).alias("text"))

    learnt = F.transform("mask", lambda s: template.plain(
        F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int"))))
    return parts.withColumn("turns", F.transform(turns, read)).withColumn("learnt", learnt)


def chat_digest(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation, from the parsed parts of its rendered log.

    A digest is of one value, so what a conversation says is put together in
    one row here, already joined by part.
    """
    name = ("turn", "copy")
    p = parse(render(fold(event_log(conversations), name, (*name, "step")), name, template), template)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    p = p.select("conv_id", F.size("turns").cast("long").alias("n"), F.length("formatted").cast("long").alias("c"),
                 F.struct("block", "part", said.alias("said"), F.array_join("learnt", "").alias("learnt")).alias("x"))
    g = p.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("c").alias("formatted_chars"),
                                 F.sort_array(F.collect_list("x")).alias("xs"))
    whole = lambda name: F.array_join(F.transform("xs", lambda x: x[name]), "")
    return (g.withColumn("loss", whole("learnt"))
            .select("conv_id", "n_turns", F.sha2(whole("said").cast("binary"), 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"),
                    F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars"))


# A conversation whose texts hold control strings of usual templates.
PROBE = "\\### Assistant: </turn> ok"


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and number -7: a user and an assistant row that say PROBE."""
    kind = dict(conversations.select("conv_id", "turn", "role", "text").dtypes)
    rows = conversations.sparkSession.createDataFrame(
        [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return conversations.select(*kind).unionByName(rows.select(*[F.col(c).cast(k) for c, k in kind.items()]))
