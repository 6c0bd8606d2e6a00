r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, and its text
as the only trainable part. A conversation that does not end with an assistant turn (or has none)
gives one more example without a trainable part, so that no turn is lost.

A turn is written as `<s>[INST]role[/INST]text</s>`. Inside roles and texts a control string gets
a backslash after its first character, and one that already has backslashes there gets one more;
reading takes one away again, so every text comes back unchanged.

An example is one row and holds its conversation up to its target, so examples of long
conversations are long; the rows of a conversation meet in one task for that reason only, and its
examples are streamed out of it one by one.

Defined results: null roles and texts are empty; rows are in order of turn (null first), then of
their written form; repeated rows are turns of their own; null conversation ids are one
conversation; an empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from imagelab.llm.common import col

OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
_CONTROL = r"(/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _CONTROL, r"$1$2$3")


def expand_prefixes(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    target_role: str = "assistant",
) -> DataFrame:
    """(conversation, example, examples, formatted, loss_start, loss_chars).

    `example` counts from 1 to `examples`; `loss_start` and `loss_chars` give the trainable span
    in code points of `formatted`, from 0.
    """
    name, said = F.coalesce(col(role), F.lit("")), escape(F.coalesce(col(text), F.lit("")))
    written = F.concat(F.lit(OPEN), escape(name), F.lit(MIDDLE), said, F.lit(CLOSE))
    span = F.when(name == target_role, F.length(said))  # null for turns that are only context
    turns = df.select(
        col(conversation).alias("conversation"),
        F.struct(col(turn).alias("turn"), written.alias("written"), span.alias("span")).alias("t"),
    )
    whole = turns.groupBy("conversation").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    numbers = F.sequence(F.lit(1), F.size("turns"))
    ends = F.filter(
        numbers, lambda i: (i == F.size("turns")) | F.element_at(F.col("turns"), i)["span"].isNotNull()
    )
    parts = whole.select("conversation", ends.alias("ends"), F.col("turns.written").alias("parts"), F.col("turns.span").alias("spans"))
    examples = parts.select(
        "conversation", "parts", "spans", F.size("ends").alias("examples"), F.posexplode("ends").alias("at", "end")
    )
    span = F.element_at("spans", F.col("end"))
    formatted = F.array_join(F.slice("parts", F.lit(1), F.col("end")), "")
    return examples.select(
        "conversation",
        (F.col("at") + 1).alias("example"),
        "examples",
        formatted.alias("formatted"),
        F.coalesce(span, F.lit(0)).alias("loss_chars"),
    ).withColumn("loss_start", F.length("formatted") - F.col("loss_chars") - F.lit(len(CLOSE)))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of the turns of a formatted example."""
    pieces = F.split(formatted, F.lit(CLOSE), -1)
    head = len(OPEN)

    def read(piece: Column) -> Column:
        middle = F.instr(piece, MIDDLE)
        role = F.substring(piece, F.lit(head + 1), middle - head - 1)
        text = F.substring(piece, middle + len(MIDDLE), F.length(piece))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), read)


def trainable(formatted: Column, loss_start: Column, loss_chars: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescape(F.substring(formatted, loss_start + 1, loss_chars))


def read_back(examples: DataFrame) -> DataFrame:
    """(conversation, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from formatted examples.

    Turns are read from the last example of a conversation, which holds them all.
    """
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    is_last = F.col("example") == F.col("examples")
    loss = trainable(F.col("formatted"), F.col("loss_start"), F.col("loss_chars"))
    read = examples.select(
        "conversation",
        F.when(is_last, parse(F.col("formatted"))).alias("turns"),
        F.length("formatted").alias("chars"),
        F.struct("example", loss.alias("text")).alias("loss"),
    ).select(
        "conversation",
        "chars",
        "loss",
        F.size("turns").alias("n"),
        F.sha2(F.array_join(lines, ""), 256).alias("sha"),
    )
    told = F.array_join(F.col("losses.text"), "")
    return (
        read.groupBy("conversation")
        .agg(
            F.max("n").cast("long").alias("n_turns"),
            F.max("sha").alias("turns_sha256"),
            F.array_sort(F.collect_list("loss")).alias("losses"),
            F.sum(F.col("chars").cast("long")).alias("formatted_chars"),
        )
        .select(
            "conversation",
            "n_turns",
            "turns_sha256",
            F.length(told).cast("long").alias("loss_chars"),
            F.sha2(told, 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
