"""Chat formatting with DataFrame expressions only.

A conversation's turns are collected as structs and sorted; a turn opens a new
block when its role differs from the previous one's, else it follows a
separator mark inside the same block, so adjacent turns of one role are merged
and can still be told apart. A block is

    <|im_start|>ROLE<|im_role|>TEXT(<|im_sep|>TEXT)*<|im_end|>

Inside roles and texts every control string gets one backslash after its first
character, and one that already has backslashes there gets one more. No raw
control string is left in a text, and taking one backslash away restores it.

All steps are linear in a conversation's length: lambdas only refer to their
own variables, so no array is built again for each turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

START, ROLE, SEP, END = "<|im_start|>", "<|im_role|>", "<|im_sep|>", "<|im_end|>"
# The tails (after "<" or "[") of this template's marks and of the
# control strings of common chat templates.
CONTROL_TAILS = (r"\|im_start\|>", r"\|im_role\|>", r"\|im_sep\|>", r"\|im_end\|>", r"\|endoftext\|>",
                 r"\|startoftext\|>", r"s>", r"/s>", r"<SYS>>", r"</SYS>>", r"INST\]", r"/INST\]")
TAILS = "(" + "|".join(CONTROL_TAILS) + ")"
MARKS = r"<\|im_(?:start|role|sep|end)\|>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, rf"([<\[])(\\*){TAILS}", r"$1$2\\$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, rf"([<\[])\\(\\*){TAILS}", "$1$2$3")


def format_chats(turns: DataFrame, key: str = "conv_id", trained_role: str = "assistant") -> DataFrame:
    """(key, turn, role, text) -> key, formatted, loss_mask.

    ``loss_mask`` has one boolean for each piece of ``formatted`` between marks
    (``split(formatted, MARKS)``): true for the texts of ``trained_role``.
    Rows are ordered by turn, equal turns by role, then text; a null turn comes
    first; null role and text are empty; repeated rows are turns of their own;
    rows with a null key form one conversation; an empty table gives no rows;
    extra columns are ignored. One conversation is one training example and one
    row, so a row's size is bounded by the example, as in any formatter."""
    t = turns.select(F.col(key).alias("_key"),
                     F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                              F.coalesce("text", F.lit("")).alias("text")).alias("_t"))
    conv = t.groupBy("_key").agg(F.array_sort(F.collect_list("_t")).alias("_turns"))
    before = F.concat(F.array(F.lit(None).cast("string")), F.transform("_turns", lambda x: x["role"]))
    conv = conv.withColumn("_turns", F.zip_with(
        "_turns", F.slice(before, 1, F.size("_turns")),
        lambda x, prev: F.struct(
            F.concat(F.when(prev.isNull(), F.lit(START + "")).when(prev == x["role"], F.lit(SEP))
                     .otherwise(F.lit(END + START)),
                     F.when(prev.eqNullSafe(x["role"]), F.lit("")).otherwise(F.concat(escape(x["role"]), F.lit(ROLE))),
                     escape(x["text"])).alias("out"),
            prev.eqNullSafe(x["role"]).alias("follows"), (x["role"] == trained_role).alias("loss"))))
    return conv.select(
        F.col("_key").alias(key),
        F.concat(F.array_join(F.transform("_turns", lambda x: x["out"]), ""), F.lit(END)).alias("formatted"),
        F.concat(F.flatten(F.transform("_turns", lambda x: F.when(x["follows"], F.array(x["loss"]))
                                       .otherwise(F.array(F.lit(False), F.lit(False), x["loss"])))),
                 F.array(F.lit(False))).alias("loss_mask"))


def parse_chats(formatted: Column) -> Column:
    """The turns read back from the output: array of (role, text)."""
    body = F.regexp_replace(formatted, r"^<\|im_start\|>|<\|im_end\|>$", "")
    blocks = F.split(body, r"<\|im_end\|><\|im_start\|>")
    parts = F.transform(blocks, lambda b: F.split(b, r"<\|im_role\|>", 2))
    return F.flatten(F.transform(parts, lambda p: F.transform(
        F.split(F.element_at(p, 2), r"<\|im_sep\|>"),
        lambda x: F.struct(unescape(F.element_at(p, 1)).alias("role"), unescape(x).alias("text")))))


def loss_text(formatted: Column, loss_mask: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    pieces = F.zip_with(F.split(formatted, MARKS), loss_mask,
                        lambda p, on: F.when(on, unescape(p)).otherwise(F.lit("")))
    return F.array_join(pieces, "")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted and read back."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kinds = dict(turns.dtypes)
    said = F.lit("</s>[INST] ok [/INST]")
    probe = (spark.range(1).select(F.explode(F.array(
        *[F.struct(F.lit(-1).cast(kinds["conv_id"]).alias("conv_id"), F.lit(i).cast(kinds["turn"]).alias("turn"),
                   F.lit(r).alias("role"), said.alias("text")) for i, r in enumerate(("user", "assistant"))])).alias("r"))
             .select("r.*"))
    out = format_chats(turns.unionByName(probe))
    out = out.select("conv_id", "formatted", parse_chats(F.col("formatted")).alias("turns"),
                     loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""),
               256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


# Formatted length without formatting: texts and roles with their escapes, and the marks of each turn.
OP8_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), o AS (
  SELECT *, row_number() OVER w AS k, lag(role) OVER w AS prev FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), e AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(@TAILS@)', '\1\2\\\3', 'g')) AS text_len,
         length(regexp_replace(role, '([<\[])(\\*)(@TAILS@)', '\1\2\\\3', 'g')) AS role_len
  FROM o
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY k), '')) AS loss_sha256,
       CAST(10 + sum(text_len + CASE WHEN prev IS NULL THEN 12 + role_len + 11
                                WHEN prev = role THEN 10 ELSE 10 + 12 + role_len + 11 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""".replace("@TAILS@", "|".join(CONTROL_TAILS))
