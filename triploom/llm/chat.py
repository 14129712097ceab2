"""Chat formatting: turns of conversations to training text with a loss mask.

A declarative :class:`ChatTemplate` names, per role, the marks around a turn
and whether its text is learned, and the finite-state machine of turn order
(the role that may follow each state). Texts keep any control string they
hold, in an escaped form that reads back exactly: a backslash is doubled,
and a backslash is put after the first character of a control string.

Conversations are folded in two steps: turns into blocks of ``BLOCK_TURNS``
turn numbers, then the blocks of a conversation; order checks run inside
the blocks and across their edges. :func:`chat_segments` never brings a
conversation together at all.

Defined results: a null text or role is empty; a role that the template
doesn't name gets the marks of ``other`` (with its name, escaped) and makes
the conversation invalid; rows with equal (conv, turn) are kept, in the
order of role and text; a null turn number comes first; a null conv_id is a
conversation of its own; an empty table gives no rows; further columns are
not read. Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_TURNS = 1024


@dataclass(frozen=True)
class ChatTemplate:
    """Marks, loss flags and turn order. ``order`` maps a state to the roles
    that may follow; the state after a turn is its role, the first state is
    ``start`` and ``final`` lists the states a conversation may end in."""

    marks: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("<<SYS>>", "<</SYS>>"),
        "user": ("[INST]", "[/INST]"),
        "assistant": ("<s>", "</s>"),
    })
    other: tuple[str, str, str] = ("[ROLE]", "[SAYS]", "[/ROLE]")
    learned: tuple[str, ...] = ("assistant",)
    order: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    })
    final: tuple[str, ...] = ("assistant",)

    def controls(self) -> list[str]:
        return [m for pair in self.marks.values() for m in pair] + list(self.other)


def escape(text: Column, template: ChatTemplate) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in template.controls():
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _turns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _segments(role: Column, text: Column, template: ChatTemplate) -> Column:
    """The segments of one turn: opening mark, text, closing mark."""
    seg = lambda t, loss: F.struct(t.alias("text"), F.lit(loss).alias("loss"))
    head, said, tail = template.other
    out = F.array(
        seg(F.concat(F.lit(head), escape(role, template), F.lit(said)), False),
        seg(escape(text, template), False), seg(F.lit(tail), False))
    for name, (opening, closing) in template.marks.items():
        out = F.when(role == name, F.array(
            seg(F.lit(opening), False), seg(escape(text, template), name in template.learned),
            seg(F.lit(closing), False))).otherwise(out)
    return out


def chat_segments(rows: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row per segment: conv_id, turn, role, segment, text, loss. A
    row-wise projection, so it needs no shuffle."""
    t = _turns(rows)
    return t.select("conv_id", "turn", "role",
                    F.posexplode(_segments(F.col("role"), F.col("text"), template))
                    .alias("segment", "s")).select(
        "conv_id", "turn", "role", "segment", F.col("s.text").alias("text"),
        F.col("s.loss").alias("loss"))


def _step_ok(template: ChatTemplate, state: Column, role: Column) -> Column:
    """Whether the machine has an edge from ``state`` reading ``role``."""
    edges = [f"{s}>{r}" for s, follow in template.order.items() for r in follow]
    return F.array_contains(F.array(*[F.lit(e) for e in edges]),
                            F.concat(state, F.lit(">"), role))


def chat_format(rows: DataFrame, template: ChatTemplate = ChatTemplate(),
                block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per conversation: conv_id, valid (turn order), n_turns,
    segments (array of text and loss flag, in order), formatted (their
    texts joined)."""
    t = _turns(rows).withColumn(
        "block", F.floor(F.col("turn") / block_turns)).withColumn(
        "segments", _segments(F.col("role"), F.col("text"), template))
    blocks = (t.groupBy("conv_id", "block")
              .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "segments")))
                   .alias("t"))
              .select("conv_id", "block", F.transform("t", lambda x: x["role"]).alias("roles"),
                      F.flatten(F.transform("t", lambda x: x["segments"])).alias("segments")))
    inner = F.size(F.filter(
        F.transform("roles", lambda r, i: (i == 0) | _step_ok(
            template, F.get("roles", i - 1), r)), lambda ok: ~ok))
    blocks = blocks.select(
        "conv_id", "block", "segments", F.size("roles").cast("long").alias("n"),
        F.get("roles", F.lit(0)).alias("first"), F.element_at("roles", -1).alias("last"),
        inner.alias("bad"))
    conv = (blocks.groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct(
                "block", "first", "last", "bad", "n", "segments"))).alias("b")))
    before = lambda i: F.when(i == 0, F.lit("start")).otherwise(
        F.get("b", i - 1)["last"])
    steps = F.transform("b", lambda x, i: (x["bad"] == 0) & _step_ok(
        template, before(i), x["first"]))
    ends = F.element_at("b", -1)["last"].isin(*template.final)
    out = conv.select(
        "conv_id", (F.forall(steps, lambda ok: ok) & ends).alias("valid"),
        F.aggregate("b", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n_turns"),
        F.flatten(F.transform("b", lambda x: x["segments"])).alias("segments"))
    return out.withColumn("formatted", F.array_join(
        F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """The turns of a formatted text, as an array of (role, text), read from
    its marks alone."""
    quote = lambda s: "".join("\\" + c if c in r"[]<>/\|().*+?^$" else c for c in s)
    head, said, tail = template.other
    forms = [f"{quote(a)}.*?{quote(b)}" for a, b in template.marks.values()]
    forms.append(f"{quote(head)}.*?{quote(said)}.*?{quote(tail)}")
    found = F.regexp_extract_all(formatted, F.lit("(?s)" + "|".join(forms)), F.lit(0))

    def turn(x: Column) -> Column:
        own = x.substr(F.lit(len(head) + 1), F.length(x) - len(head) - len(tail))
        out = F.struct(unescape(F.substring_index(own, said, 1)).alias("role"),
                       unescape(own.substr(F.length(F.substring_index(own, said, 1))
                                           + len(said) + 1, F.length(own))).alias("text"))
        for name, (a, b) in template.marks.items():
            out = F.when(x.startswith(a), F.struct(
                F.lit(name).alias("role"),
                unescape(x.substr(F.lit(len(a) + 1), F.length(x) - len(a) - len(b)))
                .alias("text"))).otherwise(out)
        return out

    return F.transform(found, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescape(s["text"])), "")
