"""Multi-party perspective rotation for chat training data.

For every participant of a conversation the dialogue is rendered with that speaker as assistant and the
others as named users; the mask marks what the assistant says. Messages of a system role stay system
messages, are never an assistant's, and make no participant.

A dialogue is rendered in blocks of BLOCK turn numbers, so a conversation of any length comes out whole, as
rows (conversation, perspective, block) of a bounded size. If a turn number is repeated so often that a block
has more than MESSAGES messages, the block is dealt to further parts, numbered by ``part``; nothing is left out.

Messages are ordered by turn (null first), then role, then text. A null role is the participant ``unknown``, a
null text is empty, null turns form block null, a null conversation id is a conversation. Repeated
rows are repeated messages. Conversations that have only system messages have no participant and no row. Other
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 256
MESSAGES = 1_024
SYSTEM = ("system",)


def _name(speaker: Column) -> Column:
    """What may stand in a header: letters, digits, dots, dashes and underscores."""
    return F.regexp_replace(speaker, r"[^\p{L}\p{N}._-]", "_")


def rotate(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    system: tuple[str, ...] = SYSTEM, block: int = BLOCK, most: int = MESSAGES,
) -> DataFrame:
    """conversation, perspective, block, part, messages (array), text, spans (array of start, end in characters of ``text``)."""
    rows = turns.select(
        F.col(conversation).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("content"),
    ).withColumn("block", F.floor(F.col("turn") / block))
    counts = rows.groupBy("conv", "block").agg(F.count("*").alias("n")).filter(F.col("n") > most)
    parts = counts.select(F.col("conv").alias("c"), F.col("block").alias("b"), F.ceil(F.col("n") / most).alias("parts"))
    same = F.col("conv").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b"))
    dealt = rows.join(parts, same, "left").withColumn(
        "part", F.when(F.col("parts").isNull(), F.lit(0).cast("long")).otherwise(F.monotonically_increasing_id() % F.col("parts"))
    )
    message = F.struct("turn", "speaker", "content")
    blocks = dealt.groupBy("conv", "block", "part").agg(F.sort_array(F.collect_list(message)).alias("said"))
    people = rows.filter(~F.col("speaker").isin(*system)).select(F.col("conv").alias("p_conv"), F.col("speaker").alias("perspective")).distinct()
    each = blocks.join(people, F.col("conv").eqNullSafe(F.col("p_conv")))

    def shown(m: Column) -> Column:
        mine = m["speaker"] == F.col("perspective")
        kind = F.when(mine, F.lit("assistant")).when(m["speaker"].isin(*system), F.lit("system")).otherwise(F.lit("user"))
        head = F.concat(
            F.lit("<|im_start|>"), kind, F.when(kind == "user", F.concat(F.lit(" name="), _name(m["speaker"]))).otherwise(F.lit("")), F.lit("\n")
        )
        return F.struct(
            m["turn"].alias("turn"), kind.alias("role"), m["speaker"].alias("name"), head.alias("head"), F.concat(m["content"], F.lit("<|im_end|>\n")).alias("body"), mine.alias("train")
        )

    shown_rows = each.withColumn("messages", F.transform("said", shown))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, m: Column) -> Column:
        body = state["at"] + F.length(m["head"])
        end = body + F.length(m["body"])
        more = F.when(m["train"], F.array(F.struct(body.alias("start"), (end - 1).alias("end")))).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
        return F.struct(end.alias("at"), F.concat(state["spans"], more).alias("spans"))

    return shown_rows.select(
        F.col("conv").alias(conversation),
        "perspective",
        "block",
        "part",
        F.transform("messages", lambda m: F.struct(m["turn"].alias("turn"), m["role"].alias("role"), m["name"].alias("name"), m["train"].alias("train"))).alias("messages"),
        F.array_join(F.transform("messages", lambda m: F.concat(m["head"], m["body"])), "").alias("text"),
        F.aggregate("messages", start, step)["spans"].alias("spans"),
    )
