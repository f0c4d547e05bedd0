"""Conversations as one training text each, with a loss mask and an exact way back. Spark expressions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of common chat templates, fixed values. Inside texts they are escaped, together with all marks `<|name|>`.
CONTROL_TAILS = r"\|[A-Za-z0-9_]+\|>|/?s>|</?SYS>>|/?INST\]"


@dataclass(frozen=True)
class ChatTemplate:
    """Marks around blocks. Every mark has the form `<|name|>`, so escaping keeps them out of texts."""

    role: str = "<|role|>"
    says: str = "<|says|>"
    turn: str = "<|turn|>"
    end: str = "<|end|>"
    loss_roles: tuple[str, ...] = ("assistant",)


def escape(text: Column) -> Column:
    r"""A backslash after the first character of every control string, and one more where there are some already."""
    return F.regexp_replace(text, rf"([<\[])(\\*)({CONTROL_TAILS})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({CONTROL_TAILS})", "$1$2$3")


def format_conversations(turns: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row per conv_id: formatted text, loss spans, and the number of turns and blocks.

    `turns` has conv_id, turn, role, text; other columns are ignored. Turns are ordered by turn, role and text, NULL first,
    so ties give one defined order and repeated rows stay. A NULL text or role counts as empty, rows with a NULL conv_id
    form one conversation, and an empty table gives no rows. Adjacent turns of one role share a block. `loss_spans` has,
    for each turn of a loss role, its start and length in characters (code points) of `formatted`.
    """
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    collected = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    blocks = _merged_blocks(F.col("turns"))
    pieces = F.flatten(F.transform("blocks", lambda block: _pieces(block, template)))
    placed = _placed(F.col("pieces"))
    return (
        collected.select("conv_id", F.size("turns").cast("long").alias("n_turns"), blocks.alias("blocks"))
        .select("conv_id", "n_turns", F.size("blocks").cast("long").alias("n_blocks"), pieces.alias("pieces"))
        .select("conv_id", "n_turns", "n_blocks", placed.alias("placed"))
        .select(
            "conv_id",
            "n_turns",
            "n_blocks",
            F.concat_ws("", "placed.parts").alias("formatted"),
            F.col("placed.spans").alias("loss_spans"),
        )
    )


def read_turns(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """The turns of a formatted text as an array of (role, text): the way back from `format_conversations`."""
    blocks = F.filter(_split(formatted, template.end), lambda block: block != "")

    def turns_of(block: Column) -> Column:
        header = _split(block, template.says)
        role = unescape(F.substring(header[0], len(template.role) + 1, 2**31 - 1))
        return F.transform(
            _split(header[1], template.turn), lambda text: F.struct(role.alias("role"), unescape(text).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns_of))


def read_loss(formatted: Column, loss_spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(loss_spans, lambda span: unescape(F.substring(formatted, span["start"] + 1, span["length"])))


def _split(text: Column, mark: str) -> Column:
    return F.split(text, rf"\Q{mark}\E", -1)


def _merged_blocks(turns: Column) -> Column:
    """Adjacent turns of one role as (role, texts)."""

    def add(blocks: Column, turn: Column) -> Column:
        last = F.element_at(blocks, -1)
        new = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        grown = F.struct(
            last["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts")
        )
        same = (F.size(blocks) > 0) & (F.try_element_at(blocks, F.lit(-1))["role"] == turn["role"])
        return F.when(
            same, F.concat(F.slice(blocks, 1, F.greatest(F.size(blocks) - 1, F.lit(0))), F.array(grown))
        ).otherwise(F.concat(blocks, F.array(new)))

    return F.aggregate(turns, F.expr("CAST(array() AS array<struct<role: string, texts: array<string>>>)"), add)


def _pieces(block: Column, template: ChatTemplate) -> Column:
    """(text, in loss) of a block: opening, its texts with marks between them, and the end."""
    learned = block["role"].isin(*template.loss_roles)

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    opening = piece(F.concat(F.lit(template.role), escape(block["role"]), F.lit(template.says)), F.lit(False))
    texts = F.transform(
        block["texts"],
        lambda text, i: F.array(
            piece(F.when(i > 0, template.turn).otherwise(""), F.lit(False)), piece(escape(text), learned)
        ),
    )
    return F.concat(F.array(opening), F.flatten(texts), F.array(piece(F.lit(template.end), F.lit(False))))


def _placed(pieces: Column) -> Column:
    """The pieces' texts, and the spans of those in the loss."""
    zero = F.expr(
        "named_struct('at', 0L, 'spans', CAST(array() AS array<struct<start: bigint, length: bigint>>))"
    )

    def add(state: Column, piece: Column) -> Column:
        length = F.char_length(piece["text"]).cast("long")
        span = F.struct(state["at"].alias("start"), length.alias("length"))
        spans = F.when(piece["loss"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + length).alias("at"), spans.alias("spans"))

    spans = F.aggregate(pieces, zero, add)["spans"]
    return F.struct(F.transform(pieces, lambda piece: piece["text"]).alias("parts"), spans.alias("spans"))
