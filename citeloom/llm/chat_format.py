"""Prefix-target expansion of conversations into training examples.

Every assistant turn becomes an example of its own: all preceding turns are
its context and only its own text is trainable. A conversation whose last turn
is not the assistant's, or that has no assistant turn, gives one further
example without a target (``trainable`` false), so that no turn is lost.

Template: ``<|start|>role\\ntext<|end|>\\n`` for each turn. Inside roles and
texts a backslash is doubled and ``<|`` becomes ``<\\|``; in roles a line break
becomes ``<\\n``. A marker can so never come from a text, and the escape is
undone exactly: a single backslash between ``<`` and ``|`` (or ``n``) is always
an escape, as literal ones come in pairs.

Plan: one exchange by conversation; the turns of one conversation are gathered
in one row, as its examples are that row's prefixes. Turns of equal number are
ordered by role and text. Examples are made by a generator one at a time, so
the text of only one prefix is in memory. All expressions are Spark's own.

Defined results: null roles and texts are empty; null turn numbers come first;
rows with a null conversation id are one conversation; repeated rows are turns
of their own; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|start|>", "<|end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def prefix_examples(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", target_role: str = "assistant"
) -> DataFrame:
    """One row per example.

    Columns: conversation id, ``example`` (0-based), ``is_last`` (holds all
    turns of the conversation), ``trainable``, ``text`` (formatted), and the
    mask ``loss_start``, ``loss_end`` as code points of ``text``, end exclusive.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv_col).alias("_c"), F.struct(F.col(turn_col).alias("n"), empty(role_col).alias("r"), empty(text_col).alias("t")).alias("_t"))
    convs = rows.groupBy("_c").agg(F.sort_array(F.collect_list("_t")).alias("_ts"))
    formed = F.transform(
        "_ts",
        lambda x: F.struct(
            F.concat(F.lit(START), escape_role(x["r"]), F.lit("\n")).alias("head"),
            F.concat(escape(x["t"]), F.lit(END)).alias("tail"),
            (x["r"] == target_role).alias("hit"),
        ),
    )
    # running end of each turn in code points, then one cut per target turn
    ends = F.aggregate(
        "_f", F.array().cast("array<long>"), lambda acc, x: F.array_append(acc, F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + F.length(x["head"]) + F.length(x["tail"]))
    )
    cut = F.transform(
        "_f",
        lambda x, i: F.struct(
            i.alias("turn"), x["hit"].alias("trainable"), F.get("_e", i).alias("end"), (F.get("_e", i) - F.length(x["tail"])).alias("start")
        ),
    )
    convs = (
        convs.withColumn("_f", formed)
        .withColumn("_e", ends)
        .withColumn("_full", F.array_join(F.transform("_f", lambda x: F.concat(x["head"], x["tail"])), ""))
        .withColumn("_cut", F.filter(cut, lambda x: x["trainable"] | (x["turn"] == F.size("_e") - 1)))
        .select("_c", "_full", F.size("_cut").alias("_n"), F.posexplode_outer("_cut").alias("example", "_x"))
    )
    return convs.select(
        F.col("_c").alias(conv_col),
        "example",
        (F.col("example") == F.col("_n") - 1).alias("is_last"),
        F.col("_x.trainable").alias("trainable"),
        F.substring("_full", F.lit(1), F.col("_x.end").cast("int")).alias("text"),
        F.col("_x.start").alias("loss_start"),
        F.when(F.col("_x.trainable"), F.col("_x.end") - len(END)).otherwise(F.col("_x.start")).alias("loss_end"),
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted text as array<struct<role, text>>."""
    parts = F.filter(F.split(text, r"<\|start\|>"), lambda x, i: i > 0)
    role = lambda x: F.substring_index(x, "\n", 1)
    return F.transform(
        parts,
        lambda x: F.struct(
            unescape_role(role(x)).alias("role"),
            unescape(F.substring(x, F.length(role(x)) + 2, F.length(x) - F.length(role(x)) - 1 - len(END))).alias("text"),
        ),
    )


def conversation_digests(examples: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Digests of what the examples say, read back from their texts and masks."""
    target = F.when(F.col("trainable"), unescape(F.substring("text", (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))))
    back = F.when(F.col("is_last"), read_turns(F.col("text")))
    each = examples.select(
        F.col(conv_col).alias("_c"),
        F.struct("example", target.alias("t")).alias("_t"),
        F.when(F.col("is_last"), F.size(back)).cast("long").alias("_n"),
        F.when(F.col("is_last"), F.sha2(F.array_join(F.transform(back, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256)).alias("_s"),
        F.when(F.col("is_last"), F.length("text")).cast("long").alias("_l"),
    )
    loss = F.array_join(F.transform(F.sort_array(F.collect_list("_t")), lambda x: x["t"]), "")
    return (
        each.groupBy("_c")
        .agg(F.max("_n").alias("n_turns"), F.max("_s").alias("turns_sha256"), loss.alias("_loss"), F.max("_l").alias("formatted_chars"))
        .select(
            F.col("_c").alias(conv_col), "n_turns", "turns_sha256", F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"), "formatted_chars"
        )
    )
