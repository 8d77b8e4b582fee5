"""Chat formatting by event-sourced reconstruction (operator 7, native).

A log of events is grouped by conversation, sorted by sequence and folded into
the final messages, which are then rendered with a template:

* ``message``: a whole message;
* ``delta``: a piece of text appended to the message that is being streamed;
* ``edit``: replaces the text of its turn;
* ``regenerate``: drops what its turn had so far and starts it anew.

The fold is declarative: per (conversation, turn) the last ``message``,
``edit`` or ``regenerate`` event restarts the text and later deltas append.
Every event takes this fold, whole messages too: their sequence numbers come
from a window per conversation, whose shuffle also serves the fold and the
offsets. A conversation's turns then meet in one row, which is the output.

Template: ``<|start|>role\\ntext<|end|>\\n`` per turn. Every control string
starts with ``<`` or ``[``; inside roles and texts each of these and each
backslash gets a backslash behind it, so no control string can appear there,
and removing that backslash gives the text back exactly. A line end in a role
is written ``<n>``.

Defined cases: null text is empty, null role is the role ``null_role``, a null
turn sorts first as a turn of its own, events that agree in conversation, turn
and sequence order by event, role and text, a null sequence number sorts first;
``messages_as_events`` keeps rows that share a turn, exact repeats too, apart by
the turn key ``part``; null conversation ids form one conversation; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|start|>", "<|end|>"
LOSS_ROLES = ("assistant",)
NULL_ROLE = "unknown"
#: a line end inside a role; no escaped text has a "<" without a backslash behind it
NEWLINE = "<n>"


def escaped(col):
    """Reversibly free of control strings."""
    col = F.replace(col, F.lit("\\"), F.lit("\\\\"))
    for c in "<[":
        col = F.replace(col, F.lit(c), F.lit(c + "\\"))
    return col


def unescaped(col):
    for c in "<[":
        col = F.replace(col, F.lit(c + "\\"), F.lit(c))
    return F.replace(col, F.lit("\\\\"), F.lit("\\"))


def messages_as_events(messages: DataFrame, conv: str = "conv_id", turn: str = "turn",
                       role: str = "role", text: str = "text") -> DataFrame:
    """One ``message`` event per row, numbered in its conversation; ``part`` keeps rows that share a turn apart."""
    rows = messages.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                           F.lit("message").alias("event"), F.col(role).alias("role"), F.col(text).alias("text"))
    rows = rows.withColumn("seq", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long"))
    return rows.select("conv_id", "turn", "seq", "event", "role", "text", F.col("seq").alias("part"))


def final_messages(events: DataFrame) -> DataFrame:
    """Columns conv_id, turn, role, text: the state after all events (conv_id, turn, seq, event, role, text).

    A turn is a (conv_id, turn), or a (conv_id, turn, part) where the events have that column.
    """
    key = ["conv_id", "turn", *(["part"] if "part" in events.columns else [])]
    ordered = events.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(
        F.col("seq"), F.coalesce("event", F.lit("message")).alias("event"), F.col("role"),
        F.coalesce("text", F.lit("")).alias("text")))).alias("log"))
    folded = ordered.withColumn("state", F.expr("""aggregate(log,
        named_struct('role', cast(NULL AS STRING), 'text', ''),
        (s, e) -> named_struct('role', coalesce(e.role, s.role),
                               'text', CASE WHEN e.event = 'delta' THEN concat(s.text, e.text) ELSE e.text END))"""))
    return folded.select("conv_id", "turn", F.col("state.role").alias("role"), F.col("state.text").alias("text"))


def render(messages: DataFrame, loss_roles=LOSS_ROLES, null_role: str = NULL_ROLE) -> DataFrame:
    """One row per conversation: conv_id, formatted and loss_spans (start and length in code points, 0-based)."""
    turns = messages.select("conv_id", "turn", F.coalesce("role", F.lit(null_role)).alias("role"),
                            escaped(F.coalesce("text", F.lit(""))).alias("body"))
    turns = turns.withColumn("head", F.concat(F.lit(START), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit(NEWLINE)), F.lit("\n")))
    size = F.char_length("head") + F.char_length("body") + F.lit(len(END) + 1)
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "body").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(size).over(before), F.lit(0)))
    log = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "role", "head", "body"))).alias("turns"))
    wanted = ", ".join(f"'{r}'" for r in loss_roles)
    return log.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: F.concat(t.head, t.body, F.lit(END + "\n"))), "").alias("formatted"),
        F.expr(f"""transform(filter(turns, t -> t.role IN ({wanted})), t -> named_struct(
            'start', t.at + char_length(t.head), 'length', cast(char_length(t.body) AS LONG)))""").alias("loss_spans"))


def format_chats(events: DataFrame, **params) -> DataFrame:
    return render(final_messages(events), **params)


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with the parsed turns (role, text) and loss_texts: what the loss mask covers, unescaped."""
    parsed = formatted.withColumn("turns", F.split("formatted", START.replace("|", "[|]")))
    parsed = parsed.withColumn("turns", F.expr(
        f"""transform(slice(turns, 2, greatest(size(turns) - 1, 0)), x -> named_struct(
            'role', substring_index(x, '\\n', 1),
            'text', substr(x, char_length(substring_index(x, '\\n', 1)) + 2,
                           char_length(x) - char_length(substring_index(x, '\\n', 1)) - 2 - {len(END)})))"""))
    parsed = parsed.withColumn("turns", F.transform("turns", lambda t: F.struct(
        unescaped(F.replace(t.role, F.lit(NEWLINE), F.lit("\n"))).alias("role"), unescaped(t.text).alias("text"))))
    return parsed.withColumn("loss_texts", F.transform("loss_spans", lambda s: unescaped(
        F.substring("formatted", (s.start + 1).cast("int"), s.length.cast("int")))))
