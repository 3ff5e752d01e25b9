r"""Operator 7: chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, and its text as the
only part under the loss mask. A conversation that does not end with an assistant turn has one more
example without a target, so that no turn is lost.

A turn is written ``<s>role[INST]text[/INST]</s>``. In roles and texts a backslash becomes ``\e``, ``<``
becomes ``\l`` and ``[`` becomes ``\b``, so control strings occur as marks only, and the text can be read
back. The span under the loss mask is that of the escaped text; marks are never under it.

Turns are ordered by turn, role and text; repeated rows are turns of their own. A null text or role counts
as empty; a null conversation id is a conversation. Other columns play no part. An empty table gives no
rows. A conversation is one document and is put together in one task; its examples are then built one
row at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the template.
OPEN, MIDDLE, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))


def escape(c: Column) -> Column:
    for plain, coded in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def examples(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``example`` (from 0), ``turns`` (in it), ``whole`` (all turns are in it), ``formatted``, and
    the mask ``loss_start``, ``loss_end`` (characters; null without a target)."""
    empty = F.lit("")
    rows = turns.select("conv_id", F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).withColumn("n", F.size("t"))
    head = lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(MIDDLE))
    ends = F.transform("t", lambda t, i: F.when((t["role"] == "assistant") | (i == F.col("n") - 1), i + 1))
    each = whole.select("conv_id", "n", "t", F.posexplode(F.array_compact(ends)).alias("example", "turns"))
    last = F.element_at("t", F.col("turns"))
    context = F.array_join(F.transform(F.slice("t", F.lit(1), F.col("turns") - 1), lambda t: F.concat(head(t), escape(t["text"]), F.lit(CLOSE + END))), "")
    built = each.select("conv_id", "example", "turns", (F.col("turns") == F.col("n")).alias("whole"), (last["role"] == "assistant").alias("target"), context.alias("context"), head(last).alias("head"), escape(last["text"]).alias("text"))
    start = F.char_length("context") + F.char_length("head")
    return built.select(
        "conv_id", "example", "turns", "whole",
        F.concat("context", "head", "text", F.lit(CLOSE + END)).alias("formatted"),
        F.when(F.col("target"), start).alias("loss_start"),
        F.when(F.col("target"), start + F.char_length("text")).alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of an example as an array of ``role``, ``text``, read back from its marks."""
    parts = F.filter(F.split(formatted, END), lambda x: x != "")
    cut = len(OPEN) + 1
    body = lambda x: F.substring(x, F.lit(cut), F.char_length(x))
    role = lambda x: F.substring_index(body(x), MIDDLE, 1)
    text = lambda x: F.substring(x, F.char_length(role(x)) + cut + len(MIDDLE), F.char_length(x) - F.char_length(role(x)) - len(OPEN + MIDDLE + CLOSE))
    return F.transform(parts, lambda x: F.struct(unescape(role(x)).alias("role"), unescape(text(x)).alias("text")))


def digests(turns: DataFrame) -> DataFrame:
    made = examples(turns)
    loss = unescape(F.substring("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    own = F.when(F.col("whole"), read_turns(F.col("formatted")))
    said = F.array_join(F.transform("own", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    sha = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    each = made.select("conv_id", "example", F.char_length("formatted").cast("long").alias("chars"), loss.alias("loss"), own.alias("own"))
    each = each.select("conv_id", "example", "chars", "loss", F.size("own").alias("n"), sha(said).alias("turns_sha256"))
    per = each.groupBy("conv_id").agg(
        F.max(F.when(F.col("turns_sha256").isNotNull(), F.col("n"))).cast("long").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.sort_array(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))).alias("losses"),
        F.sum("chars").alias("formatted_chars"),
    )
    text = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    return per.withColumn("text", text).select("conv_id", "n_turns", "turns_sha256", F.char_length("text").cast("long").alias("loss_chars"), sha(F.col("text")).alias("loss_sha256"), "formatted_chars")
