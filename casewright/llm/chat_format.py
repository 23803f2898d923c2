"""Chat formatting: final messages rebuilt from an event log, rendered by a template and read back.

A log has the columns conv_id, seq (any type with an order), kind, message, role, text. Kinds:

* ``message`` opens a message with a role and a first text; an opening that repeats replaces the text;
* ``delta`` appends to it (a streamed answer);
* ``edit`` replaces what it said so far;
* ``regenerate`` empties it and withdraws every message that was opened after it and before this event.

Events are grouped by conversation, ordered by ``seq``, and folded. The fold needs no running state: a message says what
its events said from its last replacement on, and it is withdrawn if a later event went back to before its opening, which
is a running minimum over the log read backwards. That minimum is taken over rows without texts, in stretches of the
range-sorted log, so that no task holds a whole conversation there. Texts move once, to their conversation; those of very
large conversations first to their message, and as finished messages to their conversation. A conversation is one
training text, hence one cell of the result.

Everything is a DataFrame function; there is no Python in the data path.

Defined cases: a null text is empty, a null role too. A null ``seq`` comes first. Events that repeat wholly were delivered
twice and count once. At one ``seq``, a message's events apply in the order message, regenerate, edit, delta, and wholly
tied texts in their own order; messages opened at one ``seq`` are ordered by their name. Unknown kinds, events before the opening of
their message or of messages never opened are ignored. A null conv_id or message is a value like any other. An empty log gives an
empty result, and a conversation all of whose messages never open gives no row. Other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.llm.common import settle

MESSAGE, REGENERATE, EDIT, DELTA = "message", "regenerate", "edit", "delta"
KINDS = (MESSAGE, REGENERATE, EDIT, DELTA)
#: A conversation is large from so many bytes of text on, and from this part of all bytes, so that at most
#: ``MOST_LARGE`` conversations are.
LARGE_BYTES = 64 << 20
MOST_LARGE = 10_000
#: Large conversations are folded in so many parts, each with some of the messages.
LARGE_PARTS = 1024


@dataclass(frozen=True)
class Template:
    """Marks of a turn and the strings that must not stand in a text as they are.

    A turn is ``start`` role ``middle`` text ``end``. In roles and texts the escape character E becomes ``Ee``, and ``Ec`` is
    put behind the first character of every control string. Every E is followed by ``e`` or ``c`` then, so both steps can be
    undone, and no control string is left.
    """

    start: str = "<|turn|>"
    middle: str = "<|says|>"
    end: str = "</s>"
    others: tuple[str, ...] = ("<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
    escape: str = "\\"
    trained_roles: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        if any(self.escape in c or len(c) < 2 or c[0].isalnum() for c in self.controls) or len(self.escape) != 1:
            raise ValueError("control strings have two characters at least, begin with a mark and lack the escape character")
        if any(a != b and a in b for a in self.controls for b in self.controls) or len({*self.controls}) < len(self.controls):
            raise ValueError("no control string may stand inside another")
        marks = (self.start, self.middle, self.end)
        if any(m.startswith(c[k:]) for c in self.controls for m in marks for k in range(1, len(c))):
            raise ValueError("no mark may begin as a control string ends")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.start, self.middle, self.end, *self.others)

    def escaped(self, text: Column) -> Column:
        firsts = "".join(sorted({"\\" + c[0] for c in self.controls}))
        begins = f"(?s)(?=[{firsts}])(?=" + "|".join(map(_quoted, self.controls)) + ")(.)"
        doubled = F.replace(text, F.lit(self.escape), F.lit(f"{self.escape}e"))
        return F.regexp_replace(doubled, begins, "$1" + re.escape(self.escape) + "c")

    def unescaped(self, text: Column) -> Column:
        joined = F.replace(text, F.lit(f"{self.escape}c"), F.lit(""))
        return F.replace(joined, F.lit(f"{self.escape}e"), F.lit(self.escape))


def _quoted(control: str) -> str:
    return "".join(c if c.isalnum() else "\\" + c for c in control)


def _rank(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind).cast("int")


def decisions(events: DataFrame) -> DataFrame:
    """(conv_id, message, created, role) of every message that is not withdrawn; reads no texts.

    The openings and the returns (a return names the place to which its conversation went back) are range-sorted by
    (conversation, seq). The least place returned to later is taken inside each stretch, and over one row per stretch for the
    stretches behind it; only conversations that span several stretches need the latter, at most one row a stretch.
    """
    log = events.select("conv_id", "seq", "kind", "message", F.coalesce("role", F.lit("")).alias("role"))
    opened = log.filter(F.col("kind") == MESSAGE).groupBy("conv_id", "message").agg(
        F.min(F.struct("seq", "role")).alias("first")).select("conv_id", "message", F.col("first.seq").alias("created"), F.col("first.role").alias("role"))
    o, r = opened.alias("o"), log.filter(F.col("kind") == REGENERATE).select("conv_id", "message", "seq").alias("r")
    same = F.col("o.conv_id").eqNullSafe(F.col("r.conv_id")) & F.col("o.message").eqNullSafe(F.col("r.message"))
    returns = r.join(o, same).filter("r.seq > o.created or o.created is null").select(
        "r.conv_id", "r.seq", F.struct(F.col("o.created").alias("at")).alias("back"))
    points = returns.withColumns({"message": F.lit(None).cast(opened.schema["message"].dataType),
                                  "role": F.lit(None).cast("string")}).unionByName(
        opened.select("conv_id", F.col("created").alias("seq"), "message", "role"), allowMissingColumns=True)
    ranged = settle("points", points.repartitionByRange("conv_id", "seq").withColumn("stretch", F.spark_partition_id()))
    later = Window.partitionBy("conv_id").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    behind = ranged.filter("back is not null").groupBy("conv_id", "stretch").agg(F.min("back").alias("least")).unionByName(
        ranged.groupBy("conv_id").agg(F.min("stretch").alias("low"), F.max("stretch").alias("high")).filter("low < high").select(
            "conv_id", F.explode(F.sequence("low", "high")).alias("stretch")), allowMissingColumns=True).groupBy("conv_id", "stretch").agg(
        F.min("least").alias("least")).withColumn("behind", F.min("least").over(later)).filter("behind is not null")
    backwards = Window.partitionBy("conv_id", "stretch").orderBy(F.desc("seq"), F.col("back").isNotNull())
    inside = ranged.withColumn("inside", F.min("back").over(backwards.rowsBetween(Window.unboundedPreceding, 0)))
    i, b = inside.filter("back is null").alias("i"), F.broadcast(behind).alias("b")  # a row per stretch at most, see above
    here = F.col("i.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("i.stretch") == F.col("b.stretch"))
    return i.join(b, here, "left").withColumn("to", F.least("inside", "behind")).filter(
        F.col("to").isNull() | ~(F.col("to") < F.struct(F.col("i.seq").alias("at")))).select(
        "i.conv_id", "i.message", F.col("i.seq").alias("created"), "i.role")


def _large(events: DataFrame, large_bytes: int) -> DataFrame:
    """The conv_id of the large conversations: ``MOST_LARGE`` rows at most, hence small enough to broadcast."""
    sizes = settle("sizes", events.groupBy("conv_id").agg(F.sum(F.octet_length("text")).alias("bytes")))
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    return settle("large", sizes.filter(F.col("bytes") > max(large_bytes, total // MOST_LARGE)).select("conv_id"))


def _messages(events: DataFrame, final: DataFrame, part: Column) -> DataFrame:
    """(conv_id, turns): one row for each conversation and value of ``part``, with some or all of its final messages."""
    said = events.filter(F.col("kind").isin(*KINDS)).select(
        "conv_id", "message", F.struct("seq", _rank(F.col("kind")).alias("rank")).alias("at"),
        (F.col("kind") != DELTA).alias("replaces"), F.coalesce("text", F.lit("")).alias("text"))
    both = said.unionByName(final, allowMissingColumns=True).withColumn("part", part)
    last = F.max(F.when(F.col("replaces"), F.col("at")))
    texts = F.collect_set(F.when(F.col("at").isNotNull(), F.struct("at", "text")))
    folded = both.repartition("conv_id", "part").groupBy("conv_id", "part", "message").agg(
        F.max(F.when(F.col("at").isNull(), F.struct("created", "role"))).alias("opened"), last.alias("since"), texts.alias("texts")
    ).filter("opened is not null")
    kept = F.filter("texts", lambda t: t["at"] >= F.greatest(
        F.col("since"), F.struct(F.col("opened.created").alias("seq"), F.lit(0).alias("rank"))))
    text = F.array_join(F.transform(F.array_sort(kept), lambda t: t["text"]), "")
    turn = F.struct(F.col("opened.created").alias("created"), "message", F.col("opened.role").alias("role"), text.alias("text"))
    return folded.select("conv_id", "part", turn.alias("turn")).groupBy("conv_id", "part").agg(
        F.collect_list("turn").alias("turns")).select("conv_id", "turns")


def fold(events: DataFrame, large_bytes: int = LARGE_BYTES) -> DataFrame:
    """(conv_id, turns array<struct<role, text>>): the final messages of each conversation in order."""
    large, final = _large(events, large_bytes), decisions(events)

    def among(rows: DataFrame, how: str) -> DataFrame:
        return rows.alias("r").join(F.broadcast(large).alias("l"), F.col("r.conv_id").eqNullSafe(F.col("l.conv_id")), how)

    if large.isEmpty():
        whole = _messages(events, final, F.lit(0))
    else:
        part = F.pmod(F.xxhash64("message"), F.lit(LARGE_PARTS))
        parts = _messages(among(events, "left_semi"), among(final, "left_semi"), part)
        whole = _messages(among(events, "left_anti"), among(final, "left_anti"), F.lit(0)).union(
            parts.groupBy("conv_id").agg(F.flatten(F.collect_list("turns")).alias("turns")))
    return whole.select("conv_id", F.transform(F.array_sort("turns"), lambda t: F.struct(
        t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def render(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, formatted, mask) from ``fold``'s rows.

    ``mask`` has an entry for each turn: the number of characters before its text since the last text (``skipped``), those of
    its text, and whether they count for the loss. The marks never do.
    """
    turn = lambda t: F.struct(
        F.concat(F.lit(template.start), template.escaped(t["role"]), F.lit(template.middle)).alias("head"),
        template.escaped(t["text"]).alias("text"), t["role"].isin(*template.trained_roles).alias("loss"))
    shown = conversations.select("conv_id", F.transform("turns", turn).alias("shown"))
    entry = lambda t, i: F.struct(
        (F.char_length(t["head"]) + F.when(i == 0, 0).otherwise(len(template.end))).alias("skipped"),
        F.char_length(t["text"]).alias("chars"), t["loss"].alias("loss"))
    return shown.select(
        "conv_id", F.array_join(F.transform("shown", lambda t: F.concat(t["head"], t["text"], F.lit(template.end))), "").alias("formatted"),
        F.transform("shown", entry).alias("mask"))


def read_back(rendered: DataFrame, template: Template = Template()) -> DataFrame:
    """``rendered`` with ``turns`` and ``trained`` (texts under the mask, in order), both read from ``formatted``.

    Marks stand nowhere but between turns, so cutting at them is exact. A mask that does not lie on the texts is an error.
    """
    pieces = F.slice(F.split("formatted", _quoted(template.start)), 2, 1 << 30)
    cut = lambda p: F.split(p, _quoted(template.middle) + "|" + _quoted(template.end))
    cuts = rendered.withColumn("__cuts", F.transform(pieces, cut))
    fits = lambda c, m: (
        (F.char_length(c[1]) == m["chars"])
        & (m["skipped"] - F.char_length(c[0]) - len(template.start + template.middle)).isin(0, len(template.end)))
    lies = F.forall(F.zip_with("__cuts", "mask", fits), lambda f: F.coalesce(f, F.lit(False)))
    turns = F.transform("__cuts", lambda c: F.struct(
        template.unescaped(c[0]).alias("role"), template.unescaped(c[1]).alias("text")))
    under = F.filter(F.zip_with("__cuts", "mask", lambda c, m: F.when(m["loss"], template.unescaped(c[1]))), lambda t: t.isNotNull())
    return cuts.withColumns({
        "turns": F.when(lies, turns).otherwise(F.raise_error(F.lit("the mask does not lie on the texts"))), "trained": under}).drop("__cuts")


def log_of_turns(turns: DataFrame, size: int = 512) -> DataFrame:
    """A log whose fold gives back ``turns`` (conv_id, turn, role, text), for tables that hold finished turns.

    Answers are streamed in deltas of ``size`` characters; where the digest of an answer begins with 0 to 3 a first attempt and a
    follow-up to it were withdrawn by a regeneration. Other turns are written as a draft and edited. Rows that repeat wholly are the
    same events; rows that share a turn and differ are turns of their own, ordered by role and digest of the text.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    named = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.md5(text.cast("binary")).alias("digest"))
    name = F.concat_ws(":", F.coalesce(F.col("turn").cast("string"), F.lit("")), "role", "digest")

    def event(step, kind, said, suffix="", by=F.col("role")):
        return F.struct(F.struct("turn", F.lit(step).cast("int").alias("step") if isinstance(step, int) else step.alias("step")).alias("seq"),
                        F.lit(kind).alias("kind"), F.concat(name, F.lit(suffix)).alias("message"), by.alias("role"), said.alias("text"))

    opened = F.array(event(0, MESSAGE, F.when(F.col("role") == "assistant", F.lit("")).otherwise(F.lit("..."))))
    chunks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    streamed = F.transform(chunks, lambda c, i: event((i + 4).cast("int"), DELTA, c))
    withdrawn = F.array(event(1, DELTA, F.substring("text", 1, 40)), event(2, MESSAGE, F.lit("again"), " again", F.lit("user")),
                        event(3, REGENERATE, F.lit(None).cast("string")))
    answer = F.concat(F.when(F.substring("digest", 1, 1) < "4", withdrawn).otherwise(F.slice(withdrawn, 1, 0)), streamed)
    events = F.concat(opened, F.when(F.col("role") == "assistant", answer).otherwise(F.array(event(1, EDIT, F.col("text")))))
    return named.select("conv_id", F.inline(events))
