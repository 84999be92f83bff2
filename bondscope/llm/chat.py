"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted. Neighbouring turns of one role
become one block; inside it the turns are told apart by a separator, so that nothing is lost:

    <|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n

Control strings inside texts are escaped: a backslash is doubled, and ``<|`` becomes ``<\\|``. A line
break in a role becomes ``<\\n``. ``parse_chats`` reads the turns back.

The loss mask is run-length coded: ``loss_runs`` lists the lengths of the formatted text in code points,
each with whether it is trained on. Texts of the trained roles are under the mask, markers are not.

Nulls: a null text or role is empty, a null turn sorts first, rows with a null conversation are one
conversation. Rows that tie in the turn are ordered by role and text; equal rows are turns of their own.
An empty table gives no rows. Extra columns are not read. A conversation is one row of the output, so its
text is what one task holds; no other group is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def format_chats(
    turns: DataFrame,
    trained_roles: tuple[str, ...] = ("assistant",),
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: ``conversation``, ``formatted``, ``loss_runs``."""
    said = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    collected = turns.groupBy(F.col(conversation)).agg(F.sort_array(F.collect_list(said)).alias("_turns"))

    def parts(this: Column, at: Column) -> Column:
        before = F.get(F.col("_turns"), at - 1)["role"]
        after = F.get(F.col("_turns"), at + 1)["role"]
        opens = ~before.eqNullSafe(this["role"])
        closes = ~after.eqNullSafe(this["role"])
        return F.struct(
            F.when(opens, F.concat(F.lit(START), escape_role(this["role"]), F.lit("\n")))
            .otherwise(F.lit(SEPARATOR))
            .alias("head"),
            escape(this["text"]).alias("body"),
            F.when(closes, F.lit(END)).otherwise(F.lit("")).alias("tail"),
            this["role"].isin(*trained_roles).alias("trained"),
        )

    def runs(part: Column) -> Column:
        return F.array(
            _run(F.lit(False), F.length(part["head"])),
            _run(part["trained"], F.length(part["body"])),
            _run(F.lit(False), F.length(part["tail"])),
        )

    laid = collected.withColumn("_parts", F.transform("_turns", parts))
    whole = F.transform("_parts", lambda p: F.concat(p["head"], p["body"], p["tail"]))
    return laid.select(
        F.col(conversation),
        F.array_join(whole, "").alias("formatted"),
        F.filter(F.flatten(F.transform("_parts", runs)), lambda r: r["length"] > 0).alias("loss_runs"),
    )


def parse_chats(chats: DataFrame) -> DataFrame:
    """Formatted conversations with the ``turns`` read back from them: role and text in order."""
    blocks = F.split("formatted", _literal(END))
    closed = F.slice(blocks, 1, F.size(blocks) - 1)

    def block_turns(block: Column) -> Column:
        role = F.substring_index(F.substring(block, len(START) + 1, 1 << 30), "\n", 1)
        body = F.substring(block, F.lit(len(START) + 2) + F.length(role), F.lit(1 << 30))
        return F.transform(
            F.split(body, _literal(SEPARATOR)),
            lambda t: F.struct(unescape_role(role).alias("role"), unescape(t).alias("text")),
        )

    return chats.withColumn("turns", F.flatten(F.transform(closed, block_turns)))


def trained_text(chats: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """All text under the loss mask, unescaped and in order: ``conversation``, ``loss_text``."""
    runs = chats.select(conversation, F.posexplode("loss_runs").alias("_at", "_run"))
    so_far = Window.partitionBy(conversation).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = (F.sum("_run.length").over(so_far) - F.col("_run.length") + 1).cast("int")
    placed = runs.withColumn("_from", begins).where("_run.loss")
    span = F.struct("_from", F.col("_run.length").cast("int").alias("_length"))
    spans = placed.groupBy(conversation).agg(F.sort_array(F.collect_list(span)).alias("_spans"))
    known = spans.withColumnRenamed(conversation, "_conversation")
    both = chats.join(known, F.col(conversation).eqNullSafe(F.col("_conversation")), "left")
    pieces = F.transform("_spans", lambda s: unescape(F.substring(F.col("formatted"), s["_from"], s["_length"])))
    return both.select(conversation, F.coalesce(F.array_join(pieces, ""), F.lit("")).alias("loss_text"))


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def _run(loss: Column, length: Column) -> Column:
    return F.struct(loss.alias("loss"), length.cast("long").alias("length"))


def _literal(marker: str) -> str:
    return "\\Q" + marker + "\\E"
