"""Chat formatting from an event log.

A log row says what happened to a conversation, in the order of ``seq``: text was streamed to a message
(``delta``), a message was rewritten (``edit``), or a turn was thrown away to be answered anew
(``regenerate``; later messages go too). The log is partitioned by message, the deltas of each are
folded in order, and the messages left are rendered per conversation:

    ### role:
    text
    </turn>

``\\``, ``<`` and ``#`` of a text are written ``\\s``, ``\\l`` and ``\\h``, so no text holds a control string or
another text's escape, and each formatted conversation can be read back exactly.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DELTA, EDIT, REGENERATE = "delta", "edit", "regenerate"
HEAD, AFTER_ROLE, END = "### ", ":\n", "\n</turn>\n"
# fixed values: characters and how they are written
_TEXT_ESCAPES = [("\\", "\\s"), ("<", "\\l"), ("#", "\\h")]
_ROLE_ESCAPES = [*_TEXT_ESCAPES, (":", "\\c"), ("\n", "\\n")]


def escaped(text: Column, escapes=None) -> Column:
    for plain, written in escapes or _TEXT_ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column, escapes=None) -> Column:
    """What ``escaped`` was given. The backslash comes last: what it becomes isn't read again."""
    for plain, written in reversed(escapes or _TEXT_ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def messages(events: DataFrame) -> DataFrame:
    """The final messages: conv_id, turn, role, text.

    Reads conv_id, seq, kind, turn, role, text. Rows equal in all six are one event. A message is what
    was streamed since its last edit or regeneration, or since the last regeneration of an earlier
    turn, whichever is latest; a message with nothing since a regeneration is gone. Events of one seq
    count in the order of kind, role and text. A null text is empty, a null role ``""``; events with a
    null or unknown kind are ignored. The role is that of the message's last event. Texts of any length are
    joined whole. An empty log has no messages.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    log = events.select("conv_id", "seq", "kind", "turn", role.alias("role"), text.alias("text")).distinct()
    log = log.filter(F.col("kind").isin(DELTA, EDIT, REGENERATE))
    event = F.struct("seq", "kind", "role", "text")
    own = log.groupBy("conv_id", "turn").agg(
        F.sort_array(F.collect_list(event)).alias("events"),
        F.max(F.when(F.col("kind") == REGENERATE, F.col("seq"))).alias("regenerated"),
    )
    before = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    own = own.select("conv_id", "turn", "events", F.max("regenerated").over(before).alias("thrown"))
    live = F.filter("events", lambda e: F.col("thrown").isNull() | (e["seq"] > F.col("thrown")))
    own = own.select("conv_id", "turn", live.alias("live"))
    # the fold: all that counts begins with the last event that is no delta
    starts = F.transform("live", lambda e, i: F.when(e["kind"] != DELTA, i))
    begin = F.coalesce(F.array_max(starts), F.lit(0))
    own = own.select("conv_id", "turn", F.slice("live", begin + 1, F.size("live")).alias("tail"))
    told = F.filter("tail", lambda e: e["kind"] != REGENERATE)
    return own.select("conv_id", "turn", "tail", told.alias("told")).filter(F.size("told") > 0).select(
        "conv_id", "turn", F.element_at("tail", -1)["role"].alias("role"),
        F.array_join(F.col("told")["text"], "").alias("text"),
    )


def render(chat: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Per conversation: conv_id, formatted, loss_spans (start and length in characters).

    Reads conv_id, turn, role, text as ``messages`` gives them; equal turns go by role and text. The
    spans lie on the escaped texts of ``loss_role``. Conversations with a null conv_id are one. No messages,
    no conversations.
    """
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    head = F.concat(F.lit(HEAD), escaped(F.col("role"), _ROLE_ESCAPES), F.lit(AFTER_ROLE))
    turns = chat.select(
        "conv_id", "turn", "role", "text", head.alias("head"), escaped(F.col("text")).alias("body")
    ).withColumn("size", F.char_length("head") + F.char_length("body") + len(END))
    earlier = F.coalesce(F.sum("size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    span = F.struct((earlier + F.char_length("head")).alias("start"), F.char_length("body").cast("bigint").alias("length"))
    piece = F.struct(
        F.row_number().over(order).alias("k"), F.concat("head", "body", F.lit(END)).alias("written"),
        F.when(F.col("role") == loss_role, span).alias("span"),
    )
    parts = turns.select("conv_id", piece.alias("piece")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("piece")).alias("pieces")
    )
    return parts.select(
        "conv_id",
        F.array_join(F.col("pieces")["written"], "").alias("formatted"),
        F.filter(F.col("pieces")["span"], lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    turns = F.filter(F.split(formatted, END), lambda t: t != "")
    return F.transform(turns, lambda t: F.struct(
        unescaped(F.substring_index(F.substring(t, F.lit(len(HEAD) + 1), F.char_length(t)), AFTER_ROLE, 1), _ROLE_ESCAPES).alias("role"),
        unescaped(F.substring(t, F.instr(t, AFTER_ROLE) + len(AFTER_ROLE), F.char_length(t))).alias("text"),
    ))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    masked = F.transform(spans, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return F.array_join(masked, "")


def events_of_rows(rows: DataFrame) -> DataFrame:
    """Rows by turn as a log that streams them: every text comes in two deltas, every second turn is
    first answered by a draft that is regenerated, and the others are edited into their final text.

    Each row is a message of its own; rows of one turn follow each other by role and text.
    """
    text = F.coalesce("text", F.lit(""))
    place = F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "role", "text"))
    placed = rows.select("conv_id", place.cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    first, second = F.substring("text", F.lit(1), half), F.substring("text", half + 1, F.char_length("text"))
    event = lambda k, kind, t: F.struct((F.col("turn") * 4 + k).alias("seq"), F.lit(kind).alias("kind"), t.alias("text"))
    drafted = F.array(event(0, DELTA, first), event(1, REGENERATE, F.lit("")), event(2, DELTA, first), event(3, DELTA, second))
    edited = F.array(event(0, DELTA, second), event(1, EDIT, first), event(2, DELTA, second))
    log = placed.select("conv_id", "turn", "role", F.inline(F.when(F.col("turn") % 2 == 0, drafted).otherwise(edited)))
    return log.select("conv_id", "seq", "kind", "turn", "role", "text")
