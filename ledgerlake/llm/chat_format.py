"""Chat formatting with Spark expressions only.

A conversation becomes one string of blocks, one per run of turns of one role:

    <|start|>role\\n text [<|turn|> text ...] <|end|>\\n

Turns are collected as structs and sorted by (turn, role, text); a turn whose
neighbour has the same role joins that neighbour's block.  Inside texts every
``<`` that, after any number of backslashes, meets ``|`` gets one more
backslash, so no text can hold a marker; removing one backslash undoes it.
Roles are percent-encoded where they hold ``%``, ``<`` or a newline.

Defined results: null text or role is empty; rows with a null conv_id form one
conversation of their own; equal turns keep the order (role, text); a null turn
sorts first; repeated rows are turns of their own; an empty table gives no
conversations; only conv_id, turn, role and text are read, so further columns
never clash.  All work is linear in the length of a conversation, which is one
output value and so meets in one task by nature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, TURN = "<|start|>", "<|end|>\n", "<|turn|>"
LOSS_ROLE = "assistant"


def escape(x: Column) -> Column:
    return F.regexp_replace(x, r"<(\\*)\|", r"<\\$1|")


def unescape(x: Column) -> Column:
    return F.regexp_replace(x, r"<\\(\\*)\|", r"<$1|")


def _swap(x: Column, *pairs: tuple[str, str]) -> Column:
    for a, b in pairs:
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def format_chats(df: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_runs): one row per conversation.

    ``loss_runs`` has one (skip, take) pair of code-point lengths for each piece
    of ``formatted`` that a marker opens: ``take`` characters after ``skip``
    are trained on, all others are masked.
    """
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    chats = (df.select("conv_id", turn.alias("t")).groupBy("conv_id")
             .agg(F.sort_array(F.collect_list("t")).alias("ts")))

    def piece(t, i):
        opens = (i == 0) | (F.get("ts", i - 1)["role"] != t["role"])
        closes = F.coalesce(F.get("ts", i + 1)["role"] != t["role"], F.lit(True))
        role = _swap(t["role"], ("%", "%25"), ("\n", "%0A"), ("<", "%3C"))
        return F.struct(F.when(opens, F.concat(F.lit(START), role, F.lit("\n"))).otherwise(F.lit(TURN)).alias("head"),
                        escape(t["text"]).alias("body"),
                        F.when(closes, F.lit(END)).otherwise(F.lit("")).alias("tail"),
                        (t["role"] == LOSS_ROLE).alias("loss"))

    chats = chats.select("conv_id", F.transform("ts", piece).alias("ps"))
    runs = F.flatten(F.transform("ps", lambda p: F.concat(
        F.array(F.struct(F.char_length(p["head"]).alias("skip"),
                         F.when(p["loss"], F.char_length(p["body"])).otherwise(0).alias("take"))),
        F.when(p["tail"] != "", F.array(F.struct(F.char_length(p["tail"]).alias("skip"), F.lit(0).alias("take"))))
        .otherwise(F.expr("cast(array() as array<struct<skip:int,take:int>>)")))))
    return chats.select("conv_id",
                        F.array_join(F.transform("ps", lambda p: F.concat(p["head"], p["body"], p["tail"])), "")
                        .alias("formatted"), runs.alias("loss_runs"))


def read_chats(df: DataFrame) -> DataFrame:
    """``format_chats`` output plus what it says: ``turns`` (role, text) and
    ``loss_text``, the unescaped text under the loss mask."""
    parts = F.split("formatted", r"<\|start\|>")
    blocks = F.slice(parts, F.lit(2), F.size(parts))

    def turns(b):
        role = F.substring_index(b, "\n", 1)
        body = F.substring(b, F.char_length(role) + 2, F.char_length(b) - F.char_length(role) - 1 - len(END))
        name = _swap(role, ("%3C", "<"), ("%0A", "\n"), ("%25", "%"))
        return F.transform(F.split(body, r"<\|turn\|>"),
                           lambda x: F.struct(name.alias("role"), unescape(x).alias("text")))

    masked = F.zip_with(F.split("formatted", r"(?=<\|)"), "loss_runs",
                        lambda p, r: unescape(F.substring(p, r["skip"] + 1, r["take"])))
    return df.select("*", F.flatten(F.transform(blocks, turns)).alias("turns"),
                     F.array_join(masked, "").alias("loss_text"))


def digest(df: DataFrame) -> DataFrame:
    """One row per conversation, read back from the formatted strings."""
    back = read_chats(format_chats(df))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
                       F.char_length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


#: the conversation that the registered query adds: control strings of a common template
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
