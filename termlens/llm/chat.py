"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A conversation is the rows of one ``conv_id`` ordered by turn (ties: role, then text).
Every assistant turn becomes one example: all preceding turns and the turn's own header are
the context, only the reply is trainable.  Turns after the last reply (or a conversation
without one) give one more example without a trainable part, so that no turn is lost.

Template of a turn: ``### role:\\n`` + text + ``</turn>\\n``.  Inside roles and texts ``\\``,
``#`` and ``<`` are written ``\\\\``, ``\\h`` and ``\\l`` (in roles also ``:`` as ``\\c``), so
neither control string can occur in a text, and the original is read back exactly.

Defined results: null text or role is empty; a null turn sorts first; rows of a null
``conv_id`` form one conversation; repeated rows are repeated turns; no rows, no examples; a very
long text is formatted whole; columns other than the four named are not read.

Scale: one shuffle on the conversation gathers its turns (a conversation is one digest, so
it must meet in one row); examples are exploded and read back in the same stage.  The
expansion repeats prefixes by its nature: an example is as long as what precedes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", "</turn>\n"
TARGET_ROLE = "assistant"


def escape(c: Column) -> Column:
    for plain, code in (("\\", "\\\\"), ("#", "\\h"), ("<", "\\l")):
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    """Inverse of ``escape`` (and of the role's ``\\c``): cut at escaped backslashes, so a
    single one that is left always begins a code."""
    parts = F.split(c, r"\\\\")

    def plain(part: Column) -> Column:
        for code, char in (("\\h", "#"), ("\\l", "<"), ("\\c", ":")):
            part = F.replace(part, F.lit(code), F.lit(char))
        return part

    return F.array_join(F.transform(parts, plain), "\\")


def with_probe(conversations: DataFrame, spark: SparkSession) -> DataFrame:
    """Conversation -7: a user and an assistant row whose text is made of control strings."""
    text = "\\### Assistant: </turn> ok"
    probe = spark.range(1).select(
        F.explode(F.array(
            F.struct(F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role")),
            F.struct(F.lit(1).cast("long").alias("turn"), F.lit("assistant").alias("role")),
        )).alias("r")
    ).select(F.lit(-7).cast("long").alias("conv_id"), "r.turn", "r.role", F.lit(text).alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


def expand_prefixes(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, example, is_last, formatted, loss_start, loss_chars): one row per example.
    The trainable part is ``substring(formatted, loss_start + 1, loss_chars)``; an example
    without a reply has ``loss_chars`` null."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    role = F.coalesce(F.col(role_col), F.lit(""))
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), role.alias("role"), body.alias("text")).alias("t"),
    )
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    made = convs.select("conv_id", F.transform("ts", lambda t: F.struct(
        (t["role"] == TARGET_ROLE).alias("reply"),
        F.concat(F.lit(OPEN), F.replace(escape(t["role"]), F.lit(":"), F.lit("\\c")), F.lit(":\n")).alias("head"),
        escape(t["text"]).alias("body"),
    )).alias("ts"))
    # the positions that end an example: every reply, and the last turn
    picked = made.select("conv_id", "ts", F.explode(F.filter(
        F.sequence(F.lit(1), F.size("ts")),
        lambda i: F.element_at("ts", i)["reply"] | (i == F.size("ts")))).alias("example"))
    target = F.element_at("ts", F.col("example"))
    before = F.array_join(F.transform(F.slice("ts", 1, F.col("example") - 1),
                                      lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    return picked.select(
        "conv_id", "example", (F.col("example") == F.size("ts")).alias("is_last"),
        target.alias("target"), F.concat(before, target["head"]).alias("context"),
    ).select(
        "conv_id", "example", "is_last",
        F.concat("context", F.col("target.body"), F.lit(CLOSE)).alias("formatted"),
        F.length("context").alias("loss_start"),
        F.when(F.col("target.reply"), F.length("target.body")).alias("loss_chars"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the formatted examples alone: turns, trained texts, sizes."""
    turns = F.transform(
        F.filter(F.split("formatted", CLOSE), lambda s: s != ""),
        lambda s: F.struct(
            unescape(F.substring_index(F.substr(s, F.lit(len(OPEN) + 1)), ":\n", 1)).alias("role"),
            unescape(F.substr(s, F.instr(s, ":\n") + F.lit(2))).alias("text")))
    reply = unescape(F.substr(F.col("formatted"), F.col("loss_start") + F.lit(1), F.col("loss_chars")))
    parts = examples.select(
        "conv_id", "example", F.length("formatted").cast("long").alias("chars"),
        F.when(F.col("is_last"), turns).alias("turns"),
        F.when(F.col("loss_chars").isNotNull(), reply).alias("reply"))
    # the examples of a conversation are already in one partition: no further exchange
    got = parts.groupBy("conv_id").agg(
        F.first("turns", ignorenulls=True).alias("turns"),
        F.sort_array(F.collect_list(F.struct("example", "reply"))).alias("replies"),
        F.sum("chars").alias("formatted_chars"),
        F.count("reply").alias("n_targets"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return got.select("conv_id", F.size("turns").cast("long").alias("n_turns"), said.alias("said"),
                      F.array_join("replies.reply", "").alias("trained"), "formatted_chars", "n_targets")
