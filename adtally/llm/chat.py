"""Chat formatting from event logs, in DataFrame functions only.

``fold_events`` rebuilds messages from a log: events are partitioned by conversation,
sorted by sequence number, and folded. ``message`` starts a message with its text,
``delta`` appends streamed text, ``edit`` replaces the text so far, ``regenerate``
throws the answer away and starts anew (with its text, if it has any). ``render`` writes
each conversation as one string with a loss mask, and ``read_back`` undoes it.

Template: ``<turn>``, role, line feed, text, ``</turn>``, line feed. Inside roles and texts ``&``
becomes ``&amp;`` and ``<`` becomes ``&lt;``, in roles also a line feed ``&#10;``; so no text can
hold a mark, and the escapes can be undone in the opposite order.

A conversation becomes one value of one row; that is the result asked for, so its turns
meet in one task. Nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn>", "</turn>\n"
RESETS = ("message", "edit", "regenerate")


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit("\n"), F.lit("&#10;")) if role else out


def unescape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("&#10;"), F.lit("\n")) if role else text
    return F.replace(F.replace(out, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def events_of_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A log with one ``message`` event per row: rows by turn, ties by role and text. Repeated rows are turns of their own."""
    order = Window.partitionBy(conv).orderBy(F.col(turn).asc_nulls_first(), F.col(role).asc_nulls_first(), F.col(text).asc_nulls_first())
    return turns.select(
        F.col(conv).alias("conv_id"), F.row_number().over(order).cast("long").alias("seq"), F.lit("message").alias("kind"), F.col(role).alias("role"), F.col(text).alias("text")
    ).withColumn("message", F.col("seq"))


def fold_events(events: DataFrame) -> DataFrame:
    """Messages (conv_id, message, position, role, text) from events (conv_id, seq, message, kind, role, text).

    Messages stand where their first event stands; the role is that of the last event that names
    one. Events of an unknown kind count as ``delta``. Null texts and roles are empty. Equal
    sequence numbers are ordered by kind (starts before deltas), role and text.
    """
    reset = F.coalesce(F.col("kind").isin(*RESETS), F.lit(False))
    group = Window.partitionBy("conv_id", "message")
    order = group.orderBy(F.col("seq").asc_nulls_first(), (~reset).asc(), F.col("kind").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    numbered = events.withColumn("nth", F.row_number().over(order)).withColumn("position", F.min("seq").over(group))
    started = numbered.withColumn("from", F.max(F.when(reset, F.col("nth"))).over(group))
    folded = started.groupBy("conv_id", "message").agg(
        F.min("position").alias("position"),
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("nth"))).alias("role"),
        F.array_sort(F.collect_list(F.when(F.col("nth") >= F.coalesce("from", F.lit(1)), F.struct("nth", F.coalesce("text", F.lit("")).alias("text"))))).alias("parts"),
    )
    return folded.select("conv_id", "message", "position", F.coalesce("role", F.lit("")).alias("role"), F.array_join("parts.text", "").alias("text"))


def render(messages: DataFrame, trained_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``formatted``, ``n_turns`` and ``mask`` per conversation.

    ``mask`` lists the trained stretches in order: turn (from 0), where the turn starts, and start and
    end of its text, all in code points of ``formatted``.
    """
    role, text = escape(F.col("role"), role=True), escape(F.col("text"))
    turns = messages.select("conv_id", "position", "message", F.col("role").isin(*trained_roles).alias("trained"), role.alias("role"), text.alias("text"))
    turns = turns.withColumn("out", F.concat(F.lit(OPEN), "role", F.lit("\n"), "text", F.lit(CLOSE)))
    order = Window.partitionBy("conv_id").orderBy("position", "message")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.select(
        "conv_id", "trained", "out", (F.row_number().over(order) - 1).alias("turn"), F.coalesce(F.sum(F.length("out")).over(before), F.lit(0)).cast("long").alias("turn_start"),
        (F.length("role") + len(OPEN) + 1).alias("lead"), F.length("text").alias("size"),
    )
    start = F.col("turn_start") + F.col("lead")
    stretch = F.struct("turn", "turn_start", start.alias("start"), (start + F.col("size")).alias("end"))
    return placed.groupBy("conv_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("turn", "out")))["out"], "").alias("formatted"),
        F.count("*").alias("n_turns"),
        F.array_sort(F.collect_list(F.when(F.col("trained"), stretch))).alias("mask"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns`` (role, text) and ``trained`` (the texts under the mask), both unescaped."""
    pieces = F.split("formatted", CLOSE, -1)
    cut = formatted.withColumn("_pieces", F.slice(pieces, F.lit(1), F.size(pieces) - 1))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        text = F.substring(piece, F.length(role) + F.lit(2), F.length(piece))
        return F.struct(unescape(F.substring(role, F.lit(len(OPEN) + 1), F.length(role)), role=True).alias("role"), unescape(text).alias("text"))

    def under(m: Column) -> Column:
        piece = F.element_at("_pieces", (m["turn"] + 1).cast("int"))
        return unescape(F.substring(piece, (m["start"] - m["turn_start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int")))

    return cut.withColumns({"turns": F.transform("_pieces", turn), "trained": F.transform("mask", under)}).drop("_pieces")
