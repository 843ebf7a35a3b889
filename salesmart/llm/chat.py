"""Chat transcripts rebuilt from event logs, rendered with a template, and read back.

A log row is one event of a conversation: a sequence number, the index of the message it
is about, a kind, a role and a text.

- ``start``: message ``message`` begins with ``text``. Any message with a higher index, and any
  earlier version of this one, is gone.
- ``delta``: ``text`` is appended.
- ``edit``: the message's text so far is replaced by ``text``.
- ``regenerate``: the message's text so far is discarded and so are all messages after it; the
  deltas that follow build it anew.

The fold needs no loop: an event counts unless a later one overrides it, and that is a minimum
over the events after it. So conversations are hashed to tasks, sorted by sequence number, and the
two overriding conditions are window functions. Sorting spills; nothing is collected but the
rendered conversation, which is one value by definition.

Everything here is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """Text in which no control string can occur.

    Every ``<``, run of backslashes, ``|`` gets one backslash more, so ``<|`` never occurs;
    ``unescape`` takes one away again.
    """
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role on one line."""
    return F.regexp_replace(F.regexp_replace(escape(role), "%", "%25"), "\n", "%0A")


def unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(F.regexp_replace(role, "%0A", "\n"), "%25", "%"))


def final_messages(events: DataFrame) -> DataFrame:
    """Final messages, one row each: conv_id, message, role, text.

    ``events``: conv_id, seq, message, kind, role, text. The role is that of the last ``start``
    of the message, or of its first surviving event if it has none; a ``regenerate`` has no text. Null texts and roles are empty. A null
    conv_id is a conversation of its own; a null seq sorts first, and events with equal seq
    are taken in the order of message, kind, role, text. Exact repeats of a
    delta row are two deltas. Messages all of whose events are overridden are absent.
    """
    whole = Window.partitionBy("conv_id").orderBy(
        F.col("seq").desc_nulls_last(), F.col("message").desc(), F.col("kind").desc(), F.col("role").desc(), F.col("text").desc()
    )
    later = whole.rowsBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy("conv_id", "message").orderBy("turn_back").rowsBetween(Window.unboundedPreceding, -1)
    any_of_it = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    restarts = F.col("kind").isin("start", "regenerate")
    resets = F.col("kind").isin("start", "regenerate", "edit")
    said = F.when(F.col("kind") == "regenerate", F.lit("")).otherwise(F.coalesce("text", F.lit("")))
    kept = (
        events.select(
            "conv_id", "seq", "message", "kind", F.coalesce("role", F.lit("")).alias("role"), said.alias("text")
        )
        .withColumn("turn_back", F.row_number().over(whole))
        .withColumn("lowest_restart", F.min(F.when(restarts, F.col("message"))).over(later))
        .where(F.col("lowest_restart").isNull() | (F.coalesce("message", F.lit(-1)) <= F.col("lowest_restart")))
        .withColumn("was_reset", F.coalesce(F.max(resets).over(same), F.lit(False)))
        .withColumn("started_as", F.first(F.when(F.col("kind") == "start", F.col("role")), ignorenulls=True).over(any_of_it))
    )
    return (
        kept.where(~F.col("was_reset"))
        .groupBy("conv_id", "message")
        .agg(
            F.sort_array(F.collect_list(F.struct((-F.col("turn_back")).alias("at"), "text", "role"))).alias("parts"),
            F.first("started_as").alias("started_as"),
        )
        .select(
            "conv_id",
            "message",
            F.coalesce("started_as", F.element_at(F.col("parts").getField("role"), 1)).alias("role"),
            F.array_join(F.col("parts").getField("text"), "").alias("text"),
        )
    )


def fold_events(events: DataFrame) -> DataFrame:
    """``final_messages`` of each conversation: conv_id, messages = array of (message, role, text) in order of ``message``."""
    one = F.struct("message", "role", "text")
    return final_messages(events).groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("messages"))


def render(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Rendered conversations (conv_id, messages as of ``fold_events``): conv_id, formatted, text_spans.

    Each message becomes ``<|im_start|>role``, a line break, the escaped text, ``<|im_end|>`` and a
    line break. ``text_spans`` has, for every message in order, the start (from 0) and length, in code points of ``formatted``,
    of its text, and ``loss``: whether it is a text of ``loss_role``, which bears loss. A conversation without messages is empty text.
    """
    rows = conversations.select("conv_id", F.posexplode_outer("messages").alias("message", "one"))
    return _rendered(rows.select("conv_id", "message", "one.role", "one.text"), loss_role)


def format_log(events: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``final_messages``, rendered as by ``render``."""
    return _rendered(final_messages(events), loss_role)


def _rendered(messages: DataFrame, loss_role: str) -> DataFrame:
    """Positions are running sums over the rows of a conversation, so that the work is linear in its messages."""
    tail = f"{END}\n"
    present = F.col("role").isNotNull()
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    pieces = messages.select(
        "conv_id",
        "message",
        F.when(present, F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))).alias("head"),
        escape(F.col("text")).alias("body"),
        (F.col("role") == F.lit(loss_role)).alias("loss"),
    ).withColumn("at", F.coalesce(F.sum(F.length("head") + F.length("body") + F.lit(len(tail))).over(before), F.lit(0)))
    start = (F.col("at") + F.length("head")).cast("int").alias("start")
    span = F.struct(start, F.length("body").alias("length"), "loss").alias("span")
    one = F.when(F.col("head").isNotNull(), F.struct("message", F.concat("head", "body", F.lit(tail)).alias("piece"), span))
    parts = F.sort_array(F.collect_list(one))
    return (
        pieces.groupBy("conv_id")
        .agg(parts.alias("parts"))
        .select(
            "conv_id",
            F.array_join(F.col("parts").getField("piece"), "").alias("formatted"),
            F.col("parts").getField("span").alias("text_spans"),
        )
    )


def _segments(formatted: Column) -> Column:
    """One per message: all between its ``<|im_start|>`` and the next."""
    return F.filter(F.split(formatted, r"<\|im_start\|>"), lambda s, i: i > 0)


def _body(segment: Column) -> Column:
    """The escaped text of a segment."""
    line = F.instr(segment, "\n")
    return F.substring(segment, line + 1, F.instr(segment, END) - line - 1)


def read_back(formatted: Column) -> Column:
    """Messages of a rendered conversation: array of (role, text), unescaped."""

    def message(segment: Column) -> Column:
        role = F.substring(segment, F.lit(1), F.instr(segment, "\n") - 1)
        return F.struct(unescape_role(role).alias("role"), unescape(_body(segment)).alias("text"))

    return F.transform(_segments(formatted), message)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, one span after another.

    The rendered text is split once and its messages meet their spans in order, as cutting each span out of the whole would
    search it from the start every time. A span that does not have its message's length is an error.
    """

    def under(segment: Column, span: Column) -> Column:
        body = _body(segment)
        return F.when(F.length(body).eqNullSafe(span["length"]), F.when(span["loss"], unescape(body)).otherwise("")).otherwise(
            F.raise_error(F.lit("the spans are not those of this text"))
        )

    return F.array_join(F.zip_with(_segments(formatted), spans, under), "")
