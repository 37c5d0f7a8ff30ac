"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Each assistant turn becomes an example of its own: all turns before it as context, then that reply,
which alone is trainable. A turn reads

    ### role: text </turn>

and a line feed. Inside texts and roles `\\`, `#`, `<` (and `:` in roles) are written as a backslash
and a letter, so neither `### ` nor ` </turn>` can come out of them, and reading back is exact. The
loss mask is a span of code points in the formatted string: the reply's text as written, without
header and end mark.

A conversation that doesn't end with an assistant turn gets one more example that holds all of it
and has an empty span, so that no turn is lost. NULL text and NULL role count as empty, rows of a
NULL conversation belong together. Turns go by number (NULL first), then role, then text; repeated
rows are repeated turns. An example is as long as its conversation up to there: that is the format,
not a choice of plan. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ASSISTANT = "assistant"
HEAD, MIDDLE, TAIL = "### ", ": ", " </turn>\n"
#: What is written instead; the backslash first when writing, last when reading.
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))


def escape(text: Column, table: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, written in table:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, table: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, written in reversed(table):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def prefix_targets(turns: DataFrame) -> DataFrame:
    """turns: conv_id, turn, role, text. A row per example: conv_id, example_no (from 1), target_turn, formatted, loss_start (from 0), loss_chars."""
    known = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = turns.select("conv_id", known.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    written = whole.select("conv_id", F.transform("t", lambda t: F.struct(
        t["turn"].alias("turn"), (t["role"] == ASSISTANT).alias("target"),
        F.concat(F.lit(HEAD), escape(t["role"], ROLE_ESCAPES), F.lit(MIDDLE)).alias("head"), escape(t["text"]).alias("body"),
    )).alias("t"))
    last = F.size("t")
    ends = F.filter(F.sequence(F.lit(1), last), lambda k: F.element_at("t", k)["target"] | (k == last))
    example = written.select("conv_id", "t", F.posexplode(ends).alias("no", "k"))
    target = F.element_at("t", F.col("k"))
    turn = lambda t: F.concat(t["head"], t["body"], F.lit(TAIL))
    context = F.array_join(F.transform(F.slice("t", F.lit(1), F.col("k") - 1), turn), "")
    return example.select(
        "conv_id", (F.col("no") + 1).alias("example_no"), F.when(target["target"], target["turn"]).alias("target_turn"),
        F.concat(context, turn(target)).alias("formatted"),
        F.when(target["target"], F.char_length(context) + F.char_length(target["head"])).otherwise(F.char_length(context)).alias("loss_start"),
        F.when(target["target"], F.char_length(target["body"])).otherwise(0).alias("loss_chars"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example as an array of (role, text)."""
    parts = F.filter(F.split(formatted, TAIL), lambda p: p != "")
    at = lambda p: F.instr(p, MIDDLE)
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring(p, F.lit(len(HEAD) + 1), at(p) - (len(HEAD) + 1)), ROLE_ESCAPES).alias("role"),
        unescape(F.substring(p, at(p) + len(MIDDLE), F.char_length(p))).alias("text"),
    ))


def read_loss(formatted: Column, start: Column, chars: Column) -> Column:
    """The trainable text of an example."""
    return unescape(F.substring(formatted, start + 1, chars))
