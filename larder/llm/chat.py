"""Chat formatting by prefix-target expansion, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import only

#: Marks of the template. Escaping removes every "<" from texts and roles, so a mark never comes from a text.
TURN, BODY, END = "<|turn|>", "<|text|>", "<|end|>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))


def escape(text: Column) -> Column:
    """Replace what control strings are made of; ``unescape`` is its exact inverse."""
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def expand_prefix_targets(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    trained_role: str = "assistant",
) -> DataFrame:
    """One example per turn of ``trained_role``: all turns before it as context, and only its text trainable.

    Returns conv_id, example (from 0), n_turns, formatted, loss_start and loss_end (code points of ``formatted``, end
    excluded) and last. A conversation that does not end in a trained turn gets one more example over all its turns with a null
    loss span, so that no turn is lost.

    Nulls: a null text or role is empty, rows of a null conv_id form one conversation, a null turn sorts first. Rows of equal turn
    are ordered by role, then text; repeated rows stay repeated turns. Empty texts are formatted and, in a trained turn,
    trained on with length zero. An empty table gives no rows. Other columns are ignored. A conversation is put
    together in one row, since its examples are whole conversations by definition; the prefixes are
    built one output row at a time.
    """
    rows = only(turns, conv_id=conv_id, turn=turn, role=role, text=text).select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    parts = whole.select(
        "conv_id",
        F.transform("t", lambda t: F.concat(F.lit(TURN), escape(t.role), F.lit(BODY), escape(t.text), F.lit(END))).alias("parts"),
        F.transform("t", lambda t: t.role == trained_role).alias("trained"),
    )
    ends = F.filter(F.sequence(F.lit(1), F.size("parts")), lambda k: F.element_at("trained", k) | (k == F.size("parts")))
    examples = parts.select("conv_id", "parts", "trained", F.posexplode(ends).alias("example", "n"))
    formatted = examples.select(
        "conv_id",
        F.col("example").cast("long").alias("example"),
        F.col("n").cast("long").alias("n_turns"),
        F.array_join(F.slice("parts", F.lit(1), F.col("n")), "").alias("formatted"),
        F.char_length(F.element_at("parts", F.col("n"))).alias("tail"),
        F.element_at("trained", F.col("n")).alias("trains"),
        (F.col("n") == F.size("parts")).alias("last"),
    )
    length = F.char_length("formatted")
    start = length - F.col("tail") + len(TURN) + F.char_length(escape(F.lit(trained_role))) + len(BODY)
    return formatted.select(
        "conv_id", "example", "n_turns", "formatted",
        F.when(F.col("trains"), start.cast("long")).alias("loss_start"),
        F.when(F.col("trains"), (length - len(END)).cast("long")).alias("loss_end"),
        "last",
    )


def loss_text(formatted: str = "formatted", start: str = "loss_start", end: str = "loss_end") -> Column:
    """The text under an example's loss mask, unescaped; null where nothing is trained."""
    span = F.substring(F.col(formatted), (F.col(start) + 1).cast("int"), (F.col(end) - F.col(start)).cast("int"))
    return F.when(F.col(start).isNotNull(), unescape(span))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example as an array of (role, text)."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring_index(F.substring(p, len(TURN) + 1, 2147483647), BODY, 1)).alias("role"),
            unescape(F.substring_index(p, BODY, -1)).alias("text"),
        ),
    )


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: the digest of all turns and of all trained text.

    Only a conversation's last example is parsed into turns, as it holds all of them; each example adds its own loss span.
    """
    turns = F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    read = examples.select(
        "conv_id", "example", "n_turns", loss_text().alias("trained"), F.char_length("formatted").cast("long").alias("chars"),
        F.when(F.col("last"), F.sha2(F.array_join(turns, "").cast("binary"), 256)).alias("turns_sha256"),
        F.when(F.col("last"), F.size(turns).cast("long")).alias("read_turns"),
    )
    loss = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("trained").isNotNull(), F.struct("example", "trained")))), lambda x: x.trained), ""
    )
    return (
        read.groupBy("conv_id")
        .agg(F.max("read_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"), loss.alias("loss"),
             F.sum("chars").alias("formatted_chars"))
        .select(
            "conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"),
            F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
        )
    )
