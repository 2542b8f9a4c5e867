"""Chat formatting from an event log.

A conversation arrives as events: ``message`` opens a message with a role and
first text, ``delta`` appends streamed text, ``edit`` replaces the text so far,
``regenerate`` starts the message again and discards the messages after it that
were opened before. Events are folded per message first (so the work of a very
long conversation is spread), then the messages of a conversation are rendered in
order into one string with the places of the text that carries loss.

Template: an assistant message is ``<s>text</s>``, any other
``[INST] role<newline>text [/INST]``. Inside roles and texts a backslash is
doubled and one is put into each control string (``<s>`` becomes ``<\\s>``), so
control strings in the output are the template's own and reading back is exact.

Edge cases: null text and role are empty; null conversation ids are one
conversation, null turns come first; events of equal sequence number are taken
in the order of their text; deltas without an opening message make a message of
empty role; rows repeated in a conversation table are messages of their own; an
empty log gives no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The template's control strings as they are found in texts, and when read back.
CONTROL = r"([<\[])(/?(?:s>|INST\]))"
TURN = r"((?s)<s>.*?</s>|\[INST\] .*?\[/INST\])"
OPENING = ("message", "edit", "regenerate")


def escape(text: Column) -> Column:
    """Reversible: no control string is left in the result."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def rows_to_events(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """Events of a table with one message per row: each row opens a message and
    streams its text. Rows of one conversation and turn are numbered."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    same = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    plain = rows.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    numbered = plain.withColumn("target", F.struct("turn", F.row_number().over(same).alias("part")))
    events = F.array(F.struct(F.lit(0).alias("seq"), F.lit("message").alias("kind"), F.lit("").alias("text")),
                     F.struct(F.lit(1).alias("seq"), F.lit("delta").alias("kind"), F.col("text")))
    return numbered.select("conv_id", "target", "role", F.explode(events).alias("e")).select(
        "conv_id", "target", F.struct("target", "e.seq").alias("seq"), "e.kind", "role", "e.text")


def fold(events: DataFrame) -> DataFrame:
    """``events(conv_id, seq, kind, target, role, text)`` -> final messages
    ``(conv_id, target, role, text)``; ``target`` and ``seq`` of any ordered type."""
    text = F.coalesce(F.col("text"), F.lit(""))
    opens = F.col("kind").isin(*OPENING)
    opened = F.col("kind").isin("message", "regenerate")
    messages = events.groupBy("conv_id", "target").agg(
        F.max(F.when(opens, F.struct("seq"))).alias("base"), F.max(F.when(opened, F.struct("seq"))).alias("opened"),
        F.max(F.when(F.col("kind") == "regenerate", F.struct("seq"))).alias("again"),
        F.min(F.when(F.col("kind") == "message", F.struct("seq", F.coalesce("role", F.lit("")).alias("role")))).alias("first"),
        F.sort_array(F.collect_list(F.struct(F.struct("seq").alias("at"), text.alias("text")))).alias("log"))
    since = F.filter("log", lambda e: F.col("base").isNull() | (e["at"] >= F.col("base")))
    whole = messages.select("conv_id", "target", "opened", "again",
                            F.coalesce("first.role", F.lit("")).alias("role"),
                            F.array_join(F.transform(since, lambda e: e["text"]), "").alias("text"))
    before = Window.partitionBy("conv_id").orderBy("target").rowsBetween(Window.unboundedPreceding, -1)
    cut = F.max("again").over(before)
    return (whole.withColumn("cut", cut).filter(F.col("cut").isNull() | F.col("opened").isNull()
                                                | (F.col("opened") > F.col("cut")))
            .select("conv_id", "target", "role", "text"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``loss_spans``
    (code point ranges of the escaped texts that carry loss)."""
    loss = F.col("role") == loss_role
    role = F.replace(F.replace(F.col("role"), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    body = escape(F.col("text"))
    piece = F.when(loss, F.concat(F.lit("<s>"), body, F.lit("</s>"))).otherwise(
        F.concat(F.lit("[INST] "), escape(role), F.lit("\n"), body, F.lit(" [/INST]")))
    pieces = messages.select("conv_id", "target", loss.alias("loss"), piece.alias("piece"))
    before = Window.partitionBy("conv_id").orderBy("target").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("at", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0).cast("long")))
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("target", "at", "loss", "piece"))).alias("all"))
    spans = F.transform(F.filter("all", lambda p: p["loss"]), lambda p: F.struct(
        (p["at"] + 3).alias("start"), (p["at"] + F.length(p["piece"]) - 4).alias("stop")))
    return gathered.select("conv_id", F.array_join(F.transform("all", lambda p: p["piece"]), "").alias("formatted"),
                           spans.alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation, as structs of role and text."""

    def turn(t: Column) -> Column:
        inner = F.substring(t, F.lit(8), F.length(t) - 15)
        role = F.substring_index(inner, "\n", 1)
        name = F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))
        text = F.substring(inner, F.length(role) + 2, F.length(inner))
        return F.when(t.startswith("<s>"), F.struct(
            F.lit("assistant").alias("role"), unescape(F.substring(t, F.lit(4), F.length(t) - 7)).alias("text"))
        ).otherwise(F.struct(name.alias("role"), unescape(text).alias("text")))

    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN)), turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(
        formatted, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")))), "")
