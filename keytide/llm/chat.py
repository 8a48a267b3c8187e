"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A conversation is written once. Every assistant turn becomes an example of its own: the text up to the end
of that turn, its prefix as context and the reply as target, of which only the reply is trained on. What is
trained on is read from these examples. Each holds its prefix, so a conversation's examples come to its length times its
replies; they are made row by row where the conversation lies and never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# The template: <|turn|>role<|says|>text<|end|>
TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
# A control string inside a text gets one tilde after its bracket; strings that have tildes there one more.
# Control strings of other common templates are kept apart in the same way.
_TOO = r"<(~*)(\|(?:turn|says|end)\||/?s|/?INST)>"
_SQUARE = r"\[(~*)(/?INST)\]"
_MARKED = r"<~(~*)(\|(?:turn|says|end)\||/?s|/?INST)>"
_MARKED_SQUARE = r"\[~(~*)(/?INST)\]"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, _TOO, "<~$1$2>"), _SQUARE, "[~$1$2]")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, _MARKED, "<$1$2>"), _MARKED_SQUARE, "[$1$2]")


def formatted(
    turns: DataFrame,
    *,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained: str = "assistant",
) -> DataFrame:
    """Per conversation: conv_id, text (all turns in the template) and spans of the trained replies.

    ``spans`` holds start and length (code points, from 0) of each reply of the role ``trained``, in order. Turns are
    ordered by number, nulls first, then role and text. Null roles and texts are empty. Rows with a null
    conversation id form one conversation. Other columns are not looked at; empty tables give no rows. A
    conversation is one row, so its text must stay below Spark's 2 GB for a string.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    rows = turns.select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        role.alias("role"),
        text.alias("said"),
    )
    opened = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(SAYS))
    rows = rows.select(
        "*", opened.alias("opened"), F.concat(opened, escaped(F.col("said")), F.lit(END)).alias("written")
    )
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "said").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum(F.length("written")).over(before), F.lit(0)))
    span = F.struct(
        (F.col("start") + F.length("opened")).cast("int").alias("start"),
        (F.length("written") - F.length("opened") - len(END)).alias("length"),
        (F.col("role") == trained).alias("target"),
    )
    turn = F.struct("start", "written", span.alias("span"))
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    spans = F.filter("turns.span", lambda s: s["target"])
    return held.select(
        "conv_id",
        F.array_join("turns.written", "").alias("text"),
        F.transform(spans, lambda s: F.struct(s["start"], s["length"])).alias("spans"),
    )


def examples(conversations: DataFrame, *keep: str, outer: bool = False) -> DataFrame:
    """One row per reply: conv_id, the columns ``keep``, example, prefix (the conversation up to the reply), target (the
    reply as it stands in the text, with the mark that ends it), prefix_chars (of both together: how much of the conversation the
    example is), loss_start, loss_chars and loss (what the example's text, prefix and target, has under the loss mask).

    With ``outer`` a conversation without replies has one row with nulls. A null conversation id stays null; an empty
    reply has an empty loss, and its target is the mark alone.
    """
    explode = F.posexplode_outer if outer else F.posexplode
    whole = F.col("text").alias("_whole")
    rows = conversations.select("conv_id", *keep, whole, explode("spans").alias("example", "_span"))
    start, length = F.col("_span.start"), F.col("_span.length")
    told = rows.select(
        "*",
        F.substring("_whole", F.lit(1), start).alias("prefix"),
        F.substring("_whole", start + 1, length + len(END)).alias("target"),
    )
    return told.select(
        "conv_id",
        *keep,
        "example",
        "prefix",
        "target",
        (F.length("prefix") + F.length("target")).alias("prefix_chars"),
        start.alias("loss_start"),
        length.alias("loss_chars"),
        F.substring(F.concat("prefix", "target"), start + 1, length).alias("loss"),
    )


def example_texts(conversations: DataFrame) -> DataFrame:
    """The examples as one text each: conv_id, example, text, loss_start, loss_chars."""
    text = F.concat("prefix", "target").alias("text")
    return examples(conversations).select("conv_id", "example", text, "loss_start", "loss_chars")


def read_back(conversations: DataFrame) -> DataFrame:
    """What the formatted conversations say, from their texts and spans alone: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars.

    Turns are found by the template's marks and unescaped. The loss is what the examples have under their masks, one after
    the other, unescaped. A conversation's examples lie where it lies, so nothing moves.
    """
    turns = F.slice(F.split("text", TURN.replace("|", r"\|")), F.lit(2), F.size(F.split("text", TURN.replace("|", r"\|"))))
    told = F.transform(turns, lambda t: F.split(F.regexp_replace(t, r"<\|end\|>\z", ""), r"<\|says\|>"))
    lines = F.transform(told, lambda t: F.concat(unescaped(t[0]), F.lit("\n"), unescaped(t[1]), F.lit("\n")))
    kept = ["n_turns", "turns_sha256", "formatted_chars"]
    rows = conversations.select(
        "conv_id", "text", "spans", F.size(told).cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"), F.length("text").cast("long").alias("formatted_chars"),
    )
    reply = F.struct("example", unescaped(F.col("loss")).alias("loss"))
    whole = examples(rows, *kept, outer=True).groupBy("conv_id", *kept).agg(F.sort_array(F.collect_list(reply)).alias("replies"))
    loss = whole.select("conv_id", *kept, F.array_join("replies.loss", "").alias("loss"))
    return loss.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
