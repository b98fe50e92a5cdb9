"""Chat formatting with a grammar round trip: what is rendered is parsed again, and content that the
parser would mistake for control strings is escaped until the turns come back identical."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def _escaped(text: Column) -> Column:
    """One more backslash between < and |, wherever there are none or some: no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def _unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role_out(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n"))


def _role_back(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def render(turns: Column, escape: bool) -> Column:
    """turns: array of struct(role, text)."""
    one = lambda role, text: F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))
    return F.array_join(F.transform(turns, lambda t: one(_escaped(_role_out(t["role"])), _escaped(t["text"])) if escape else one(t["role"], t["text"])), "")


def parse(formatted: Column) -> Column:
    """The grammar, read from left to right: START role newline text END newline, any number of times.
    An array of struct(role, text), unescaped; what follows a turn's first END is not part of it."""

    def turn(piece: Column) -> Column:
        body = F.substring_index(piece, END, 1)
        role = F.substring_index(body, "\n", 1)
        return F.struct(_role_back(_unescaped(role)).alias("role"), _unescaped(F.substring(body, F.length(role) + 2, F.length(body))).alias("text"))

    pieces = F.split(formatted, r"<\|im_start\|>")
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces) - 1), turn)


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, escaped, turns from `turns` (conv_id, turn, role, text; others are ignored).

    Turns go by turn, then role and text (nulls first); repeated rows are turns of their own; null
    roles and texts count as empty; a null conv_id is a conversation. `turns` is what the parser reads
    back from `formatted`, and `escaped` says whether escaping was needed for that to be the source.
    An empty table gives an empty one. A conversation is one row, as its formatted text must be."""
    clean = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    convs = clean.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"))
    convs = convs.withColumn("plain", render(F.col("source"), False))
    convs = convs.withColumn("escaped", parse(F.col("plain")) != F.col("source"))
    convs = convs.withColumn("formatted", F.when(F.col("escaped"), render(F.col("source"), True)).otherwise(F.col("plain")))
    return convs.select("conv_id", "formatted", "escaped", parse(F.col("formatted")).alias("turns"))


def digest(chats: DataFrame, learner: str = "assistant") -> DataFrame:
    """What was read back, as numbers and digests; the loss mask covers the texts of `learner`."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == learner), lambda t: t["text"]), "")
    return chats.withColumn("_loss", loss).select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
