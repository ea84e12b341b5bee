"""Operator 5: chat formatting by event-sourced reconstruction.

A conversation is a log of events. The log is parted by message, each message's events
are sorted by sequence and folded to its final text, and the messages of a conversation
are sorted and rendered. All of it is built-in expressions.

Template: ``<|im_start|>`` role newline text ``<|im_end|>`` newline. Inside roles and
texts every ``<``, any number of ``!``, ``|`` gets one more ``!``, so no control string
can appear there and taking one ``!`` away restores them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
#: Events that begin a message's text anew: ``message`` opens it, ``edit`` replaces it,
#: ``regenerate`` throws away what was streamed. A ``delta`` adds to it.
RESETS = ("message", "edit", "regenerate")
LOSS_ROLE = "assistant"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(!*)\|", "<!$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<!(!*)\|", "<$1|")


def fold_messages(log: DataFrame) -> DataFrame:
    """``log(conv_id, msg, seq, kind, role, text)`` -> ``(conv_id, first_seq, msg, role, text)``.

    ``seq`` may have any type that sorts; events of one message with equal ``seq`` go by
    kind, role and text. Text is that of the last event of RESETS and all deltas after
    it; the role is the last one given. Null texts and roles count as empty, null ids
    are ids, unknown kinds count as deltas. Only one message's events meet in a row.
    """
    events = F.array_sort(F.collect_list(F.struct("seq", "kind", "role", "text")))
    last = F.coalesce(F.array_max(F.transform("events", lambda e, i: F.when(e["kind"].isin(*RESETS), i))), F.lit(0))
    live = F.slice("events", F.col("last") + 1, F.size("events"))
    roles = F.filter("events", lambda e: e["role"].isNotNull())
    return (log.groupBy("conv_id", "msg").agg(events.alias("events")).withColumn("last", last)
            .select("conv_id", F.col("events")[0]["seq"].alias("first_seq"), "msg",
                    F.coalesce(F.try_element_at(roles, F.lit(-1))["role"], F.lit("")).alias("role"),
                    F.array_join(F.transform(live, lambda e: F.coalesce(e["text"], F.lit(""))), "").alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, formatted, loss_mask)`` for each conversation.

    ``loss_mask`` has a struct (turn, start, stop) for each assistant message: code
    points inside the block of that turn, end exclusive. Messages go by their first
    sequence, then role, text and id. The one row of a conversation is its string.
    """
    header = F.concat(F.lit(START), F.replace(escape(F.col("role")), F.lit("\n"), F.lit(NEWLINE)), F.lit("\n"))
    parts = messages.select("conv_id", "first_seq", "msg", "role", header.alias("header"),
                            escape(F.col("text")).alias("body"))
    blocks = parts.select("conv_id", F.struct(
        "first_seq", "role", F.concat("header", "body", F.lit(END + "\n")).alias("block"), "msg",
        F.char_length("header").alias("start"), F.char_length("body").alias("length")).alias("turn"))
    mask = F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == LOSS_ROLE, F.struct(
        i.alias("turn"), t["start"].alias("start"), (t["start"] + t["length"]).alias("stop")))),
        lambda s: s.isNotNull())
    return (blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.array_join(F.transform("turns", lambda t: t["block"]), "").alias("formatted"),
                    mask.alias("loss_mask")))


def format_chats(log: DataFrame) -> DataFrame:
    """Fold a log and render it; see :func:`fold_messages` and :func:`render`."""
    return render(fold_messages(log))


def parse(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text) and ``loss_texts``, read back from ``formatted`` and its mask."""
    blocks = F.slice(F.split("formatted", START.replace("|", r"\|")), F.lit(2), F.col("n_turns").cast("int"))

    def turn(b: Column) -> Column:
        role = F.substring_index(b, "\n", 1)
        size = F.char_length(role)
        text = b.substr(size + 2, F.char_length(b) - size - (len(END) + 2))
        return F.struct(unescape(F.replace(role, F.lit(NEWLINE), F.lit("\n"))).alias("role"),
                        unescape(text).alias("text"))

    masked = F.transform("loss_mask", lambda m: unescape(F.get("blocks", m["turn"]).substr(
        m["start"] - len(START) + 1, m["stop"] - m["start"])))
    return (formatted.withColumn("blocks", blocks).withColumn("turns", F.transform("blocks", turn))
            .withColumn("loss_texts", masked).drop("blocks"))


def log_of_turns(conversations: DataFrame, chunk: int = 512) -> DataFrame:
    """Rows by turn -> a log as a chat service would write it.

    Another role's turn is a ``message`` with a draft and an ``edit`` to its text. An
    assistant's turn is an empty ``message``, a ``delta`` that does not last, a
    ``regenerate`` and the text in ``delta`` events of ``chunk`` code points. Drafts are at
    most ``chunk`` code points. Each row is a message of its own, also where
    (conv_id, turn) repeats.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    streamed = F.coalesce(F.col("role") == LOSS_ROLE, F.lit(False))
    last = F.when(streamed, 2 + F.ceil(F.char_length(text) / F.lit(chunk))).otherwise(1).cast("int")
    rows = conversations.select("conv_id", "turn", "role", text.alias("text"), streamed.alias("streamed"),
                                last.alias("last"), F.monotonically_increasing_id().alias("msg"))
    step, draft = F.col("step"), F.reverse(F.left("text", F.lit(chunk)))
    kind = (F.when(step == 0, "message").when(~F.col("streamed"), "edit").when(step == 2, "regenerate").otherwise("delta"))
    part = (F.when(F.col("streamed"), F.when(step == 1, draft).when(step < 3, F.lit("")).otherwise(
        F.col("text").substr((step - 3) * chunk + 1, F.lit(chunk)))).otherwise(F.when(step == 0, draft).otherwise(F.col("text"))))
    return (rows.withColumn("step", F.explode(F.sequence(F.lit(0), F.col("last"))))
            .select("conv_id", "msg", F.struct("turn", "step").alias("seq"), kind.alias("kind"),
                    F.when(step == 0, F.col("role")).alias("role"), part.alias("text")))
