"""Chat formatting by perspective rotation.

Every participant of a conversation gets a rendering of the whole dialogue in which that
participant is the assistant and everyone else is a named user; the training mask covers the
assistant's turns. A rendering is a set of rows, one per turn, that concatenate in turn order,
so a conversation of any length never sits in one row or one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"  # instructions, not a participant
UNNAMED = "unknown"


def escaped(text: Column) -> Column:
    """Text that holds no control token; replacing "<||" by "<|" restores it."""
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def perspectives(conversations: DataFrame) -> DataFrame:
    """Per turn and participant: conv_id, perspective, turn, role, name, rendered, mask_start, mask_end.

    ``rendered`` is the turn in chat markup; [mask_start, mask_end) are the characters of it that
    train the assistant (the content and its end token), 0 and 0 for other turns. A participant
    is a distinct role of the conversation other than null and "system". A system turn stays one
    in every rendering. A turn with a null role is by an unnamed user and nobody's perspective. A
    null text is empty. Turns of a conversation without participants, or with a null conv_id,
    come back once with a null perspective. Repeated rows stay repeated; turns with equal numbers
    keep that number. Other columns are ignored.

    The participants of each conversation are found with map-side combination and joined to the
    turns; a hot conversation is split by the adaptive skew join, as its participants are few.
    """
    turns = conversations.select("conv_id", "turn", F.col("role").cast("string").alias("speaker"),
                                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    people = (turns.where(F.col("speaker").isNotNull() & (F.col("speaker") != SYSTEM))
              .select("conv_id", F.col("speaker").alias("perspective")).distinct())
    rotated = turns.join(people, "conv_id", "left")
    mine = F.coalesce(F.col("speaker") == F.col("perspective"), F.lit(False))
    system = F.coalesce(F.col("speaker") == SYSTEM, F.lit(False))
    role = F.when(system, SYSTEM).when(mine, "assistant").otherwise("user")
    name = F.when(~system & ~mine, F.regexp_replace(F.coalesce("speaker", F.lit(UNNAMED)), r"[\s<>|]+", "_"))
    head = F.concat(F.lit(START), "role", F.coalesce(F.concat(F.lit(" name="), "name"), F.lit("")), F.lit("\n"))
    body = F.concat(escaped(F.col("text")), F.lit(END))
    return (rotated.withColumns({"role": role, "name": name})
            .withColumns({"head": head, "body": body})
            .select("conv_id", "perspective", "turn", "role", "name",
                    F.concat("head", "body", F.lit("\n")).alias("rendered"),
                    F.when(F.col("role") == "assistant", F.length("head")).otherwise(0).cast("long").alias("mask_start"),
                    F.when(F.col("role") == "assistant", F.length("head") + F.length("body")).otherwise(0)
                    .cast("long").alias("mask_end")))


SQL = r"""
WITH people AS (SELECT DISTINCT conv_id, role AS perspective FROM conversations
                WHERE role IS NOT NULL AND role <> 'system'),
rotated AS (SELECT c.conv_id, p.perspective, c.turn, c.role AS speaker, coalesce(c.text, '') AS text,
                   CASE WHEN c.role = 'system' THEN 'system' WHEN c.role = p.perspective THEN 'assistant'
                        ELSE 'user' END AS role
            FROM conversations c LEFT JOIN people p ON c.conv_id = p.conv_id),
named AS (SELECT *, CASE WHEN role = 'user'
                         THEN regexp_replace(coalesce(speaker, 'unknown'), '[\s<>|]+', '_', 'g') END AS name
          FROM rotated),
parts AS (SELECT *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) AS head,
                 replace(text, '<|', '<||') || '<|im_end|>' AS body FROM named)
SELECT conv_id, perspective, turn, role, name, head || body || chr(10) AS rendered,
       CAST(CASE WHEN role = 'assistant' THEN length(head) ELSE 0 END AS BIGINT) AS mask_start,
       CAST(CASE WHEN role = 'assistant' THEN length(head) + length(body) ELSE 0 END AS BIGINT) AS mask_end
FROM parts
"""
