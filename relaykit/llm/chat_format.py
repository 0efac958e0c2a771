"""Chat formatting with prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
context, and only its text is trainable. A conversation that does not end with
an assistant turn has one more example, of all its turns, with nothing to
train on, so that the output holds every turn.

Template: a turn is ``<|im_start|>role`` newline text ``<|im_end|>`` newline.
Within roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``, so no
text can open or close a turn, and taking one backslash off each pair gives the
text back. A newline in a role becomes ``\\n``.

Only whole turns of one conversation meet in a row; conversations are grouped
by id. Built-in functions format and read back.

Defined results: a null text or role is empty; turns go by number, then role,
then text, a null number first; repeated rows are turns each; rows with a null
conversation id are one conversation; an empty table gives no examples; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TARGET_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """Takes the leading backslash off each pair, left to right."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # pairs first become a control pair that no escaped role holds
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
             target_role: str = TARGET_ROLE) -> DataFrame:
    """(conv_id, example, formatted, mask_start, mask_end, last): ``example``
    from 0; the trainable code points of ``formatted`` are mask_start to
    mask_end (equal: none); ``last`` marks the example with all turns."""
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    pieces = F.transform("t", lambda t: F.struct(
        F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"),
        (t["role"] == target_role).alias("target")))
    n = F.size("p")
    ends = F.filter(F.transform("p", lambda p, i: F.when(p["target"] | (i == n - 1), i).otherwise(-1)), lambda i: i >= 0)
    out = (convs.select("conv_id", pieces.alias("p")).select("conv_id", "p", n.alias("n"), F.posexplode(ends).alias("example", "i")))
    before = F.concat(F.array_join(F.transform(F.slice("p", F.lit(1), F.col("i")), lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n"))), ""),
                      F.get("p", F.col("i"))["head"])
    out = out.select("conv_id", "example", before.alias("before"), F.get("p", F.col("i"))["body"].alias("body"),
                     F.get("p", F.col("i"))["target"].alias("target"), (F.col("i") == F.col("n") - 1).alias("last"))
    start = F.length("before").cast("long")
    return out.select("conv_id", "example", F.concat("before", "body", F.lit(END + "\n")).alias("formatted"), start.alias("mask_start"),
                      F.when(F.col("target"), start + F.length("body")).otherwise(start).alias("mask_end"), "last")


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) that a formatted example holds."""
    # what follows a start marker is one turn; texts hold no marker
    turns = F.slice(F.split(formatted, r"\Q" + START + r"\E"), 2, 2 ** 30)
    return F.transform(turns, lambda t: F.struct(
        unescape_role(F.substring_index(t, "\n", 1)).alias("role"),
        unescape(F.substring(t, F.locate("\n", t) + 1, F.length(t) - F.locate("\n", t) - len(END) - 1)).alias("text")))


def summary(made: DataFrame) -> DataFrame:
    """Digest of each conversation, read back from its examples."""
    loss = F.substring(F.col("formatted"), F.col("mask_start").cast("int") + 1, (F.col("mask_end") - F.col("mask_start")).cast("int"))
    read = made.select("conv_id", "example", F.length("formatted").cast("long").alias("chars"), unescape(loss).alias("loss"),
                       F.when(F.col("last"), read_turns(F.col("formatted"))).alias("turns"))
    per = read.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("l"), F.sum("chars").alias("formatted_chars"),
                                     F.max("turns").alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    losses = F.array_join(F.transform("l", lambda x: x["loss"]), "")
    return per.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                      F.length(losses).cast("long").alias("loss_chars"), F.sha2(losses.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
