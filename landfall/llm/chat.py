"""Chat formatting into budgeted windows of whole turns.

A conversation's turns are marked and concatenated. Prefix sums of their token counts cut it
into spans: the sum's axis is divided into blocks of the room that the budget leaves beside
the system turn and the repeated history; the turns that lie inside a block are one span, a
turn that crosses into the next block is a span of its own. So a span never exceeds the room
unless it is one single turn. Each span becomes a window: the leading system turn, then the
turns before the span that lie within `history` tokens of it, then the span. Only assistant
texts that are new in a window are under the loss mask; the repeated ones are masked out.

Everything is window functions and one aggregation per window, which the budget bounds, so a
very long conversation spreads over many windows. Where a conversation's system turn and
history do not leave room, the room is a quarter of the budget.

The template writes <|im_start|>role, a line feed, the text, <|im_end|> and a line feed.
Inside roles and texts & becomes &amp; and <| becomes &lt;|, so no control string is left
in them, and the two replacements in reverse order give the text back; a line feed in a role
becomes &nl;.

Defined results: a NULL text or role is the empty text; a NULL turn comes first; turns with
equal numbers are ordered by role and text; repeated rows are repeated turns; rows with a
NULL conv_id are one conversation; an empty table gives no rows; other columns are ignored.
A turn longer than the budget has a window of its own, marked by `over_budget`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import text_of

START, END = "<|im_start|>", "<|im_end|>\n"
#: Tokens of a turn's marks and role.
TURN_OVERHEAD = 6


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def estimated_tokens(text: Column) -> Column:
    """Tokens of a text without a tokenizer: one for each started run of four UTF-8 bytes."""
    return F.ceil(F.octet_length(text) / 4).cast("long")


def format_windows(
    turns: DataFrame,
    budget: int = 2048,
    history: int = 256,
    tokens: Column | None = None,
) -> DataFrame:
    """Windows of (conv_id, turn, role, text): conv_id, window, text, loss, repeated, tokens.

    `loss` is the list of (start, end) places in code points that bear loss; `repeated` the
    number of turns at the window's start that were in earlier windows; `window` orders them.
    `tokens` counts a turn's escaped text, in the column `body`.
    """
    role = F.replace(escaped(F.coalesce(F.col("role"), F.lit(""))), F.lit("\n"), F.lit("&nl;"))
    rows = turns.select("conv_id", "turn", role.alias("role"), escaped(text_of()).alias("body"))
    count = tokens if tokens is not None else estimated_tokens(F.col("body"))
    conv = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    before = conv.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy("conv_id")
    numbered = rows.withColumn("tokens", count + TURN_OVERHEAD).withColumn("at", F.row_number().over(conv))
    is_system = (F.col("at") == 1) & (F.col("role") == "system")
    system_tokens = F.coalesce(F.max(F.when(is_system, F.col("tokens"))).over(everyone), F.lit(0))
    room = F.greatest(F.lit(budget // 4), F.lit(budget - history) - F.col("system_tokens"))
    summed = (
        numbered.withColumns({"is_system": is_system, "system_tokens": system_tokens})
        .withColumns(
            {
                "room": room,
                "from": F.coalesce(F.sum(F.when(F.col("is_system"), 0).otherwise(F.col("tokens"))).over(before), F.lit(0)),
            }
        )
        .withColumn("to", F.col("from") + F.when(F.col("is_system"), 0).otherwise(F.col("tokens")))
    )
    block = F.expr("`from` div room")
    crosses = F.expr("(greatest(`to`, 1) - 1) div room") > block
    # Spans are ordered: a block's inner turns, then the turn that crosses its end.
    spanned = summed.withColumn("span", 2 * block + F.when(crosses & ~F.col("is_system"), 1).otherwise(0))
    span_start = F.min("from").over(Window.partitionBy("conv_id", "span"))
    spanned = spanned.withColumn("span_start", span_start)
    # A turn is repeated in the later spans that start within `history` of its own start.
    ahead = Window.partitionBy("conv_id").orderBy("from").rangeBetween(1, history)
    later = F.array_distinct(
        F.filter(
            F.collect_set(F.struct(F.col("span_start").alias("s"), F.col("span").alias("w"))).over(ahead),
            lambda x: (x["w"] > F.col("span")) & (x["s"] - F.col("from") <= history),
        )
    )
    # The system turn goes to every window, by way of the first turn of its span.
    system = F.max(F.when(F.col("is_system"), F.struct("role", "body"))).over(everyone)
    leads = F.row_number().over(Window.partitionBy("conv_id", "span").orderBy("at")) == 1
    laid = spanned.withColumns({"later": later, "leads": leads, "first_span": F.min("span").over(everyone)}).withColumn("system", system)
    # Ranks order a window: system turn, then turns by place.
    own = F.struct(
        F.col("span").alias("window"), F.col("at").alias("rank"), F.lit(False).alias("again"),
        F.col("role").alias("role"), F.col("body").alias("body"), F.col("tokens").alias("tokens"),
    )
    again = F.transform(
        F.when(F.col("is_system"), F.array().cast("array<struct<s:bigint,w:bigint>>")).otherwise(F.col("later")),
        lambda x: F.struct(
            x["w"].alias("window"), F.col("at").alias("rank"), F.lit(True).alias("again"),
            F.col("role").alias("role"), F.col("body").alias("body"), F.col("tokens").alias("tokens"),
        ),
    )
    with_system = F.when(
        F.col("leads") & F.col("system").isNotNull() & (F.col("span") > F.col("first_span")),
        F.array(
            F.struct(
                F.col("span").alias("window"), F.lit(0).alias("rank"), F.lit(True).alias("again"),
                F.col("system.role").alias("role"), F.col("system.body").alias("body"), F.col("system_tokens").alias("tokens"),
            )
        ),
    )
    pieces = laid.select(
        "conv_id",
        F.inline(F.concat(F.array(own), again, F.coalesce(with_system, F.array().cast("array<struct<window:bigint,rank:int,again:boolean,role:string,body:string,tokens:bigint>>")))),
    )
    listed = pieces.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("rank", "again", "role", "body"))).alias("turns"),
        F.sum("tokens").alias("tokens"),
    )

    def head(t: Column) -> Column:
        return F.concat(F.lit(START), t["role"], F.lit("\n"))

    marked = F.transform("turns", lambda t: F.concat(head(t), t["body"], F.lit(END)))
    lengths = F.transform(
        "turns",
        lambda t: F.struct(
            F.char_length(head(t)).alias("head"), F.char_length(t["body"]).alias("body"),
            (~t["again"] & (t["role"] == "assistant")).alias("target"),
        ),
    )
    none = F.array().cast("array<struct<start:int,end:int>>")
    loss = F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda a, t: F.struct(
            (a["at"] + t["head"] + t["body"] + len(END)).alias("at"),
            F.when(
                t["target"],
                F.concat(
                    a["spans"],
                    F.array(F.struct((a["at"] + t["head"]).alias("start"), (a["at"] + t["head"] + t["body"]).alias("end"))),
                ),
            ).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return listed.select(
        "conv_id", "window", F.array_join(marked, "").alias("text"), loss.alias("loss"),
        F.size(F.filter("turns", lambda t: t["again"])).alias("repeated"), "tokens",
        (F.col("tokens") > budget).alias("over_budget"),
    )


def read_turns(text: Column, skip: Column | int = 0) -> Column:
    """The turns (role, text) that a formatted text holds, without the first `skip`."""
    parts = F.slice(F.split(text, F.lit(r"<\|im_start\|>")), skip + F.lit(2), F.size(F.split(text, F.lit(r"<\|im_start\|>"))))

    def turn(part: Column) -> Column:
        cut = F.instr(part, "\n")
        body = F.substring(part, cut + 1, F.char_length(part) - cut - len(END))
        role = F.replace(F.substring(part, F.lit(1), cut - 1), F.lit("&nl;"), F.lit("\n"))
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(parts, turn)


def read_loss(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(loss, lambda s: unescaped(F.substring(text, s["start"] + 1, s["end"] - s["start"]))), ""
    )
