"""Chat formatting with a grammar round trip, in DataFrame functions only.

A turn is rendered as ``### role``, a line break, its text, ``</turn>`` and a line break. The grammar
allows neither ``###`` nor ``</turn>`` inside a turn, and a backslash quotes what follows it, so a
conversation can be parsed by splitting alone. Each turn is first rendered as it is and parsed again;
where the recovered turn differs from its source (or does not parse) it is rendered with broken-up
control strings, and where that still differs with quoted backslashes too. The last level always comes
back identical, and a turn that did not would fail the job.

Turns are put together in two steps, blocks of ``BLOCK`` turn numbers and then conversations, so
that a conversation with very many turns does not arrive row by row in one task. Its formatted text
is one cell by nature.

Defined results: a null text or role is empty; rows of one conversation are ordered by turn (null
first), then role, then text, so that repeated turn numbers have a fixed order; a null ``conv_id`` is a
conversation of its own; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, MARK = "### ", "</turn>\n", "</turn>"
BLOCK = 64


def escape(text: Column, level: int) -> Column:
    """Level 0 leaves a text as it is, 1 breaks up control strings, 2 also quotes backslashes."""
    if level == 2:
        text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    if level:
        text = F.replace(text, F.lit("##"), F.lit("#\\#"))
        text = F.replace(text, F.lit(MARK), F.lit("<\\/turn>"))
    return text


def unescape(text: Column) -> Column:
    r"""Undo every level: ``\\`` is a backslash, ``\N`` a line break, any other backslash goes."""
    parts = F.transform(
        F.split(text, r"\\\\"),
        lambda x: F.replace(F.replace(x, F.lit("\\N"), F.lit("\n")), F.lit("\\"), F.lit("")))
    return F.when(F.contains(text, F.lit("\\")), F.array_join(parts, "\\")).otherwise(text)


def _header(role: Column, level: int) -> Column:
    role = escape(role, level)
    return F.concat(F.lit(OPEN), F.replace(role, F.lit("\n"), F.lit("\\N")) if level else role, F.lit("\n"))


def render(role: Column, text: Column, level: int) -> Column:
    return F.concat(_header(role, level), escape(text, level), F.lit(CLOSE))


def _split_turn(inner: Column) -> Column:
    """(role, text) of what stands between the opening and the closing mark."""
    cut = F.instr(inner, "\n")
    return F.struct(unescape(F.substring(inner, F.lit(1), cut - 1)).alias("role"),
                    unescape(F.substring(inner, cut + 1, F.length(inner))).alias("text"))


def recovered(turn: Column) -> Column:
    """(role, text) of a rendered turn, null when it does not follow the grammar."""
    inner = F.substring(turn, F.lit(len(OPEN) + 1), F.length(turn) - len(OPEN) - len(CLOSE))
    fits = F.startswith(turn, F.lit(OPEN)) & F.endswith(turn, F.lit(CLOSE)) & F.contains(inner, F.lit("\n"))
    fits = fits & ~F.contains(inner, F.lit("###")) & ~F.contains(inner, F.lit(MARK))
    return F.when(fits, _split_turn(inner))


def _same(turn: Column) -> Column:
    back = recovered(turn)
    return F.coalesce((back["role"] == F.col("role")) & (back["text"] == F.col("text")), F.lit(False))


def render_turns(rows: DataFrame) -> DataFrame:
    """Add ``level`` (the least that comes back identical), ``turn_text`` and ``body_at`` to (role, text)."""
    role, text = F.col("role"), F.col("text")
    rows = rows.withColumn("plain", render(role, text, 0))
    rows = rows.withColumn("level", F.when(_same(F.col("plain")), 0))
    rows = rows.withColumn("plain", F.when(F.col("level") == 0, F.col("plain")).otherwise(render(role, text, 1)))
    rows = rows.withColumn("level", F.when(F.col("level") == 0, 0).when(_same(F.col("plain")), 1).otherwise(2))
    rows = rows.withColumn("turn_text", F.when(F.col("level") < 2, F.col("plain")).otherwise(render(role, text, 2)))
    checked = F.when((F.col("level") < 2) | _same(F.col("turn_text")), F.col("level")).otherwise(
        F.raise_error(F.lit("a turn does not come back from its rendering")).cast("int"))
    head = F.when(F.col("level") == 0, _header(role, 0)).when(F.col("level") == 1, _header(role, 1)).otherwise(_header(role, 2))
    return rows.withColumns({"level": checked, "body_at": F.length(head)}).drop("plain")


def format_conversations(rows: DataFrame, trained_role: str = "assistant", block: int = BLOCK) -> DataFrame:
    """One row per conversation: ``formatted``, and the loss mask both per turn and as spans.

    ``loss_mask`` says for each turn whether its text is trained on; ``loss_spans`` are the code
    point ranges (end exclusive) of those texts in ``formatted``, as they stand there.
    """
    none = F.lit("")
    rows = rows.select(
        "conv_id", "turn", F.coalesce(F.col("role"), none).alias("role"), F.coalesce(F.col("text"), none).alias("text"))
    rows = render_turns(rows)
    size = F.length("turn_text")
    rows = rows.select(
        "conv_id", "turn", F.floor(F.col("turn") / block).alias("block"), "role", "text", "turn_text", size.alias("size"),
        "body_at", (size - F.col("body_at") - len(CLOSE)).alias("body"), (F.col("role") == trained_role).alias("loss"))
    in_block = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(in_block), F.lit(0))
    rows = rows.select("conv_id", "block", "turn_text", "size", "loss", "body_at", "body", start.alias("start"))
    blocks = rows.groupBy("conv_id", "block").agg(
        F.sum("size").alias("size"),
        F.sort_array(F.collect_list(F.struct("start", "turn_text", "loss", "body_at", "body"))).alias("turns"))
    blocks = blocks.select(
        "conv_id", "block", "size", F.array_join(F.transform("turns", lambda t: t["turn_text"]), "").alias("part"),
        F.transform("turns", lambda t: t["loss"]).alias("mask"),
        F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(
            (t["start"] + t["body_at"]).alias("start"), (t["start"] + t["body_at"] + t["body"]).alias("end"))).alias("spans"))
    in_conv = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("start", F.coalesce(F.sum("size").over(in_conv), F.lit(0)))
    convs = blocks.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "part", "mask", "spans"))).alias("parts"))
    moved = F.transform("parts", lambda p: F.transform(p["spans"], lambda s: F.struct(
        (s["start"] + p["start"]).alias("start"), (s["end"] + p["start"]).alias("end"))))
    return convs.select(
        "conv_id", F.array_join(F.transform("parts", lambda p: p["part"]), "").alias("formatted"),
        F.flatten(F.transform("parts", lambda p: p["mask"])).alias("loss_mask"), F.flatten(moved).alias("loss_spans"))


def parse_conversations(formatted: DataFrame) -> DataFrame:
    """Read (conv_id, formatted, loss_mask) back: ``turns`` as (role, text), and ``loss_text``."""
    pieces = F.split("formatted", CLOSE)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    turns = F.transform(pieces, lambda p: _split_turn(F.substring(p, F.lit(len(OPEN) + 1), F.length(p))))
    out = formatted.withColumn("turns", turns)
    trained = F.filter("turns", lambda t, i: F.get(F.col("loss_mask"), i))
    return out.withColumn("loss_text", F.array_join(F.transform(trained, lambda t: t["text"]), ""))


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what is read back from the formatted conversations."""
    back = parse_conversations(formatted)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
