"""Chat formatting of typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor
goes through them in order. A text part becomes its (escaped) text; any other
becomes a numbered placeholder ``<|image:0|>``, and the turn records what it
stands for: kind, reference and the tokens that it expands to in the model.

Format: each turn is ``<|turn|>``, the role, a line feed, the body, ``<|end|>``
and a line feed. Inside roles and texts every control string gets a backslash
after its first character (one more if it has some already), so the markers
that remain are the template's own and unescaping gives the text back. The loss
mask covers the bodies of the assistant's turns.

SQL functions only; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.spans import let, running_sums

TURN, END, FEED = "<|turn|>", "<|end|>", "<|feed|>"
# The start of this template's markers, and the control strings of common ones.
CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\]|/?<?/?SYS>)"
ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\]|/?<?/?SYS>)"
PART = "struct<kind:string,text:string,ref:string,units:int>"
#: Tokens that an attachment expands to: a fixed number and as many again for each unit (tile, second, page).
EXPANSION = {"image": (85, 170), "audio": (0, 25), "document": (2, 600)}


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def text_parts(text: Column) -> Column:
    """The parts of a plain text: one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(0).alias("units")))


def _expanded(part: Column) -> Column:
    out = F.lit(0)
    for kind, (base, each) in EXPANSION.items():
        out = F.when(part["kind"] == kind, base + each * F.coalesce(part["units"], F.lit(1))).otherwise(out)
    return out.cast("int")


def visited(parts: Column) -> tuple[Column, Column]:
    """The body of a turn and its attachments in order. Unknown kinds are
    attachments of no expansion; a null list has no parts, null texts are empty."""
    parts = F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    attached = F.filter(parts, lambda p: ~p["kind"].eqNullSafe(F.lit("text")))
    number = lambda i: F.size(F.filter(F.slice(parts, F.lit(1), i), lambda p: ~p["kind"].eqNullSafe(F.lit("text"))))
    body = F.concat_ws("", F.transform(parts, lambda p, i: F.when(p["kind"].eqNullSafe(F.lit("text")), escape(F.coalesce(p["text"], F.lit("")))).otherwise(
        F.concat(F.lit("<|"), escape(F.regexp_replace(F.coalesce(p["kind"], F.lit("unknown")), r"[^a-z]", "")), F.lit(":"), number(i).cast("string"), F.lit("|>")))))
    refs = F.transform(attached, lambda p, i: F.struct(i.cast("int").alias("nth"), p["kind"].alias("kind"), p["ref"].alias("ref"), _expanded(p).alias("tokens")))
    return body, refs


def format_chats(messages: DataFrame) -> DataFrame:
    """``messages`` (conv_id, turn, role, parts) -> conv_id, formatted, loss
    (turn number, start and end of each stretch under the loss mask, in code
    points), attachments.

    One row per conversation; rows without a conv_id form one. Turns are in the
    order of ``turn``, null first; equal turns by role, then body, and repeated
    rows are turns of their own. A null role is empty.
    """
    body, refs = visited(F.col("parts"))
    turns = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), body.alias("body"), refs.alias("refs"))
    head = F.concat(F.lit(TURN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit(FEED)), F.lit("\n"))
    turns = turns.withColumn("head", head).withColumn("size", F.length("head") + F.length("body") + len(END) + 1)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    turns = turns.withColumn("nth", F.row_number().over(order)).withColumn("before", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    start = (F.col("before") + F.length("head")).cast("long")
    one = F.struct("nth", F.concat("head", "body", F.lit(END + "\n")).alias("text"), F.when(F.col("role") == "assistant", F.struct(F.col("nth").alias("nth"), start.alias("start"), (start + F.length("body")).alias("end"))).alias("loss"), "refs")
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    return chats.select(
        "conv_id", F.concat_ws("", F.transform("turns", lambda t: t["text"])).alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["loss"]), lambda x: x.isNotNull()).alias("loss"),
        F.flatten(F.transform("turns", lambda t: F.transform(t["refs"], lambda r: F.struct(t["nth"].alias("nth_turn"), r["nth"].alias("nth"), r["kind"].alias("kind"), r["ref"].alias("ref"), r["tokens"].alias("tokens"))))).alias("attachments"))


def _read_turn(piece: Column) -> Column:
    """Role and text of one formatted turn."""
    inner = F.substring(piece, F.lit(len(TURN) + 1), F.length(piece) - (len(TURN) + len(END) + 1))
    role = F.substring_index(inner, "\n", 1)
    return F.struct(unescape(F.replace(role, F.lit(FEED), F.lit("\n"))).alias("role"), unescape(F.substring(inner, F.length(role) + 2, F.length(inner))).alias("text"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """The output of ``format_chats`` read back, a row for each conversation:
    conv_id, formatted_chars, turns (role, text), learned (the unescaped
    stretches under the loss mask)."""
    pieces = F.filter(F.split("formatted", r"(?=<\|turn\|>)", -1), lambda p: p != "")
    placed = let(pieces, lambda ps: F.struct(ps.alias("text"), running_sums(F.transform(ps, F.length)).alias("at")))
    cut = formatted.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), "loss", placed.alias("pieces"))

    def stretch(p: Column, s: Column) -> Column:
        text, at = F.get(p["text"], s["nth"] - 1), F.get(p["at"], s["nth"] - 1)
        return unescape(F.substring(text, (s["start"] - at + 1).cast("int"), (s["end"] - s["start"]).cast("int")))

    # A lambda's name spares that the pieces are made again for every stretch.
    learned = let(F.struct("pieces", "loss"), lambda x: F.transform(x["loss"], lambda s: stretch(x["pieces"], s)))
    return cut.select("conv_id", "formatted_chars", F.transform("pieces.text", _read_turn).alias("turns"), learned.alias("learned"))


def chat_digests(messages: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    all read back from the formatted conversations."""
    back = read_chats(format_chats(messages))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    back = back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), said.alias("said"), F.concat_ws("", "learned").alias("learned"), "formatted_chars")
    return back.select("conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars")
