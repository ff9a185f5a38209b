"""Training examples from conversations: one per assistant reply, with its prefix.

Template: every turn is `<s>[INST]role[/INST]text</s>`. Inside roles and texts each
control string gets a backslash after its first character, and one that already
holds such backslashes gets one more, so the original comes back exactly and the
formatted text can be cut at control strings without any look at the escapes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, ROLE, TEXT, END = "<s>", "[INST]", "[/INST]", "</s>"
# what follows the first character of a control string
_REST = r"(s>|/s>|INST\]|/INST\])"
TRAINED = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _REST, r"$1$2\\$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _REST, "$1$2$3")


def rendered(role: Column, text: Column) -> Column:
    parts = [BEGIN + ROLE, escaped(role), TEXT, escaped(text), END]
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def parsed(formatted: Column) -> Column:
    """Turns of a formatted text: array<struct(role, text)>, unescaped."""
    pieces = F.split(formatted, END)  # the last piece is what follows the last turn
    whole = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    head = len(BEGIN + ROLE)

    def turn(piece: Column) -> Column:
        inside = F.substring(piece, head + 1, 1 << 30)
        return F.struct(
            unescaped(F.substring_index(inside, TEXT, 1)).alias("role"),
            unescaped(F.substring_index(inside, TEXT, -1)).alias("text"),
        )

    return F.transform(whole, turn)


def _alone(conversation: Column) -> Column:
    """`alone`: tells rows without a conversation apart, null for all others."""
    return F.when(conversation.isNull(), F.monotonically_increasing_id()).alias("alone")


def format_examples(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Every assistant turn as an example of its own; all turns before it are context.

    Returns (`conv_col`, `example` int from 0, `n_turns` int, `formatted` string,
    `loss_start` int, `loss_chars` int): the characters [loss_start, loss_start +
    loss_chars) of `formatted` are the escaped reply, the only trained text. The
    turns after the last assistant turn, or a conversation without one, come as one
    more example of the whole conversation with nothing trained (loss_start null, 0
    characters), so the last example of a conversation always holds all of it.

    Turns are ordered by `turn_col`, nulls first, then by role and text, so ties and
    repeated rows have one order. Null roles and texts count as empty. Each row with a
    null conversation is a conversation of its own. Other columns are not read. An
    example is one row, so a conversation has to fit a row; the rows before it are never
    copied more often than there are replies after them, which is what the method asks.
    """
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    rows = turns.select(F.col(conv_col).alias("conv"), _alone(F.col(conv_col)), turn.alias("turn"))
    talks = rows.groupBy("conv", "alone").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    size = F.size("turns")
    replies = F.filter(
        F.sequence(F.lit(1), size),
        lambda k: (F.element_at("turns", k)["role"] == TRAINED) | (k == size),
    )
    examples = talks.select("conv", "turns", F.posexplode(replies).alias("example", "n_turns"))
    prefix = F.transform(
        F.slice("turns", F.lit(1), F.col("n_turns")), lambda t: rendered(t["role"], t["text"])
    )
    last = F.element_at("turns", F.col("n_turns"))
    trained = last["role"] == TRAINED
    loss = F.when(trained, F.length(escaped(last["text"]))).otherwise(0)
    formatted = F.array_join(prefix, "")
    return examples.select(
        F.col("conv").alias(conv_col),
        "example",
        "n_turns",
        formatted.alias("formatted"),
        loss.alias("loss_chars"),
        trained.alias("_trained"),
    ).select(
        conv_col,
        "example",
        "n_turns",
        "formatted",
        F.when(
            F.col("_trained"), F.length("formatted") - len(END) - F.col("loss_chars")
        ).alias("loss_start"),
        "loss_chars",
    )


def read_examples(examples: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Conversations read back from their examples.

    Returns (`conv_col`, `turns` array<struct(role, text)>, `loss` array<string>: the
    trained texts in order, unescaped, `formatted_chars` bigint over all examples). An
    example without a conversation is one of its own, as it has one turn.
    """
    under_mask = unescaped(
        F.substring("formatted", F.col("loss_start") + 1, F.col("loss_chars"))
    )
    loss = F.when(
        F.col("loss_start").isNotNull(),
        F.struct("example", under_mask.alias("text")),
    )
    return (
        examples.withColumns({"conv": F.col(conv_col), "alone": _alone(F.col(conv_col))})
        .groupBy("conv", "alone")
        .agg(
            F.max_by("formatted", "example").alias("whole"),
            F.sort_array(F.collect_list(loss)).alias("loss"),  # nulls are not collected
            F.sum(F.length("formatted")).cast("bigint").alias("formatted_chars"),
        )
        .select(
            F.col("conv").alias(conv_col),
            parsed(F.col("whole")).alias("turns"),
            F.col("loss.text").alias("loss"),
            "formatted_chars",
        )
    )
