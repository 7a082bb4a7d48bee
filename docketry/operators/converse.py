"""Conversations: messages with conv_id, turn, role and text.

Multipart content is `array<struct<type,text,url>>`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.functions.text import escape_braces, trim_all
from docketry.operators.ordered import joined_in_order

HISTORY_MESSAGES = 30


def last_messages(messages: DataFrame, n: int = HISTORY_MESSAGES) -> DataFrame:
    """The last n messages of each conversation."""
    by = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    return (
        messages.withColumn("from_end", F.row_number().over(by))
        .where(F.col("from_end") <= n)
        .drop("from_end")
    )


def history_text(messages: DataFrame, n: int = HISTORY_MESSAGES) -> DataFrame:
    """`Role: text` lines of the last n messages, those of the system left out."""
    lines = last_messages(messages, n).where(F.col("role") != "system").withColumn(
        "line", F.concat(F.initcap("role"), F.lit(": "), F.coalesce("text", F.lit("")))
    )
    listed = F.sort_array(F.collect_list(F.struct("turn", "line")))
    return lines.groupBy("conv_id").agg(listed.alias("xs")).select(
        "conv_id", F.array_join(F.transform("xs", lambda e: e["line"]), "\n").alias("history")
    )


def combined_query(messages: DataFrame, last_n: int | None = None, part_rows: int | None = None) -> DataFrame:
    """User texts in order joined by ". ", the asked one last: all, or the last_n before it.

    One row per conversation; with part_rows one per part, see `joined_in_order`.
    """
    users = messages.where(F.col("role") == "user")
    if last_n is not None:
        users = last_messages(users, last_n + 1)
    return joined_in_order(users, ["conv_id"], "turn", "text", ". ", part_rows)


def drop_empty_answers(messages: DataFrame) -> DataFrame:
    """Leaves out assistant messages with nothing in them."""
    empty = (F.col("role") == "assistant") & (trim_all(F.coalesce("text", F.lit(""))) == "")
    return messages.where(~empty)


def last_user_turn(messages: DataFrame) -> DataFrame:
    """The last user message of each conversation: conv_id, turn, text."""
    return (
        messages.where(F.col("role") == "user")
        .groupBy("conv_id")
        .agg(F.max_by(F.struct("turn", "text"), "turn").alias("m"))
        .select("conv_id", "m.turn", "m.text")
    )


def split_request(messages: DataFrame) -> dict[str, DataFrame]:
    """The last user message is the `query`, the rest `history`; braces are doubled in both."""
    kept = drop_empty_answers(messages)
    query = last_user_turn(kept)
    asked = query.select("conv_id", F.col("turn").alias("asked_turn"))
    history = kept.join(asked, "conv_id", "left").where(
        F.col("asked_turn").isNull() | (F.col("turn") != F.col("asked_turn"))
    )
    escaped = escape_braces(F.col("text"))
    return {
        "query": query.select("conv_id", escaped.alias("query")),
        "history": history.select("conv_id", "turn", "role", escaped.alias("text")),
    }


def system_prompt(messages: DataFrame, base: str) -> DataFrame:
    """The base prompt followed by the system messages in order, one row per conversation.

    A conversation without system messages has the base prompt alone.
    """
    said = joined_in_order(messages.where(F.col("role") == "system"), ["conv_id"], "turn", "text", " ")
    every = messages.select("conv_id").distinct().join(said, "conv_id", "left")
    return every.select("conv_id", F.concat_ws(" ", F.lit(base), "text").alias("prompt"))


def question_answer_text(pairs: DataFrame, part_rows: int | None = None) -> DataFrame:
    """Question and answer blocks in order, three line breaks between: conv_id, pos, question, answer."""
    block = pairs.withColumn(
        "block", F.concat(F.lit("Question: "), "question", F.lit("\nAnswer: "), "answer")
    )
    return joined_in_order(block, ["conv_id"], "pos", "block", "\n\n\n", part_rows)


def question_answer_pairs(messages: DataFrame) -> DataFrame:
    """Each user message with the assistant message that follows it."""
    asked = messages.where(F.col("role") == "user").select(
        "conv_id", F.col("turn").alias("pos"), F.col("text").alias("question")
    )
    replied = messages.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("pos"), F.col("text").alias("answer")
    )
    return asked.join(replied, ["conv_id", "pos"])


# ---------------------------------------------------------------- multipart content


def content_text(parts: Column) -> Column:
    """Text parts joined by a blank."""
    texts = F.filter(parts, lambda p: p["type"] == "text")
    return F.array_join(F.transform(texts, lambda p: F.coalesce(p["text"], F.lit(""))), " ")


def content_query(parts: Column) -> Column:
    """Texts and picture addresses in order, a blank line between; empty ones left out."""
    values = F.transform(
        parts,
        lambda p: F.when(p["type"] == "text", trim_all(p["text"])).when(p["type"] == "image_url", p["url"]),
    )
    return F.array_join(F.filter(values, lambda v: v != ""), "\n\n")


def has_image(parts: Column) -> Column:
    return F.coalesce(F.exists(parts, lambda p: p["type"] == "image_url"), F.lit(False))
