"""Conversations from event logs, folded and rendered with DataFrame functions only.

A log holds events of messages: `delta` appends text, `edit` sets the text anew, and
`regenerate` throws away what was streamed so far. The logs are dealt by conversation
and by blocks of messages, sorted by sequence and folded into final messages, which
are rendered into parts with a loss mask. A long conversation is many parts, so that no
task holds more than a block of it in memory while folding and rendering; many messages of one
place are sorted and cut into parts of a block's size.

Template of a message: `<turn>### role`, a line end, the text, `</turn>` and a line end.
In role and text a backslash becomes `\\b`, `<` becomes `\\l` and `#` becomes `\\h`, in the
role also a line end `\\n`; so no marker can occur inside, and reading undoes it exactly.

Defined cases
- A null role or text counts as empty; an unknown kind of event is a delta. A message
  without text keeps its markers. Messages of the same place are ordered by
  role and text.
- A null conversation id is a conversation of its own; null places come first.
- Of events of a message with equal sequence the deltas come first, then by text; repeated
  deltas are all appended. Other columns take no part. An empty log gives no parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factpanel.llm.common import stored

BLOCK_MESSAGES = 64
OPEN, CLOSE = "<turn>### ", "</turn>\n"
LEARNED_ROLE = "assistant"


def _replace(text: Column, what: str, by: str) -> Column:
    return F.replace(text, F.lit(what), F.lit(by))


def escape(text: Column) -> Column:
    return _replace(_replace(_replace(text, "\\", "\\b"), "<", "\\l"), "#", "\\h")


def unescape(text: Column) -> Column:
    return _replace(_replace(_replace(text, "\\l", "<"), "\\h", "#"), "\\b", "\\")


def escape_role(role: Column) -> Column:
    return _replace(escape(role), "\n", "\\n")


def unescape_role(role: Column) -> Column:
    return unescape(_replace(role, "\\n", "\n"))


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, block, place, role, text): the final messages.

    events: conv_id, place (number of the message in its conversation), message (key of
    the message), role, sequence (of any type that can be sorted), kind, text.
    """
    kind, text = F.coalesce("kind", F.lit("delta")), F.coalesce("text", F.lit(""))
    resets = kind.isin("edit", "regenerate")
    own = events.select(
        "conv_id", "place", "message", F.coalesce("role", F.lit("")).alias("role"),
        F.floor(F.col("place") / BLOCK_MESSAGES).alias("block"),
        F.struct("sequence", resets.alias("resets"), F.when(kind != "regenerate", text).otherwise("").alias("text")).alias("event"),
    )
    by_message = own.repartition("conv_id", "block").groupBy("conv_id", "block", "place", "message", "role")
    last = F.max(F.when(F.col("event.resets"), F.struct("event.sequence", "event.resets")))
    folded = by_message.agg(F.sort_array(F.collect_list("event")).alias("events"), last.alias("last"))
    alive = F.filter("events", lambda e: F.col("last").isNull() | (F.struct(e["sequence"], e["resets"]) >= F.col("last")))
    text = F.array_join(F.transform(alive, lambda e: e["text"]), "")
    return folded.select("conv_id", "block", "place", "message", "role", text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, block, part, formatted, loss): one row per part of a conversation, blocks in
    order and parts in blocks, each of BLOCK_MESSAGES messages at most; loss has the spans (start, length, in code points) of the learned texts."""
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    in_block = Window.partitionBy("conv_id", "block").orderBy("place", "role", "text", "message")
    number = F.row_number().over(in_block)
    shown = messages.withColumn("number", number).select(
        "conv_id", "block", F.floor((F.col("number") - 1) / BLOCK_MESSAGES).alias("part"), "number", "role",
        head.alias("head"), escape(F.col("text")).alias("body"),
    )
    turn = F.struct(
        "number", "role",
        F.concat("head", "body", F.lit(CLOSE)).alias("turn"),
        F.length("head").alias("skip"), F.length("body").alias("n"),
    )
    parts = shown.groupBy("conv_id", "block", "part").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    empty = "CAST(array() AS ARRAY<STRUCT<start: BIGINT, length: BIGINT>>)"
    # at most one block of messages is folded here, so the array that grows stays small
    loss = F.expr(
        f"""aggregate(turns, named_struct('at', 0L, 'spans', {empty}),
          (s, t) -> named_struct(
            'at', s.at + t.skip + t.n + {len(CLOSE)}L,
            'spans', CASE WHEN t.role = '{LEARNED_ROLE}'
              THEN concat(s.spans, array(named_struct('start', s.at + t.skip, 'length', CAST(t.n AS BIGINT))))
              ELSE s.spans END),
          s -> s.spans)"""
    )
    formatted = F.array_join(F.transform("turns", lambda t: t["turn"]), "")
    return parts.select("conv_id", "block", "part", formatted.alias("formatted"), loss.alias("loss"))


def read_turns(parts: DataFrame) -> DataFrame:
    """(conv_id, block, part, formatted_chars, turns, learned): what the formatted text says.
    turns: role and text of each message, learned: the texts under the mask, unescaped."""
    raw = F.expr(f"filter(split(formatted, '{CLOSE.strip()}\\n'), t -> t <> '')")
    inner = F.transform(raw, lambda t: F.substr(t, F.lit(len(OPEN) + 1)))
    turns = F.transform(
        inner,
        lambda t: F.struct(
            unescape_role(F.substring_index(t, "\n", 1)).alias("role"),
            unescape(F.substr(t, F.instr(t, "\n") + 1)).alias("text"),
        ),
    )
    masked = F.transform(
        "loss",
        lambda s: unescape(F.substr("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))),
    )
    return parts.select(
        "conv_id", "block", "part", F.length("formatted").cast("long").alias("formatted_chars"),
        turns.alias("turns"), masked.alias("learned"),
    )


def digests(parts: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars. A digest needs its whole text in one value; before that, each part
    has become two strings."""
    read = read_turns(parts)
    plain = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    per_part = read.select(
        "conv_id", "formatted_chars", F.size("turns").alias("n"),
        F.length(learned).alias("loss_chars"),
        F.struct("block", "part", plain.alias("plain"), learned.alias("learned")).alias("part"),
    )
    whole = per_part.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sum("loss_chars").alias("loss_chars"),
        F.sum("formatted_chars").alias("formatted_chars"),
        F.sort_array(F.collect_list("part")).alias("parts"),
    )
    joined = {c: F.array_join(F.col(f"parts.{c}"), "") for c in ("plain", "learned")}
    return whole.select(
        "conv_id", "n_turns",
        F.sha2(joined["plain"], 256).alias("turns_sha256"), "loss_chars",
        F.sha2(joined["learned"], 256).alias("loss_sha256"), "formatted_chars",
    )


def events_of_rows(rows: DataFrame, chunk: int = 512) -> DataFrame:
    """The log that leads to the given messages (conv_id, turn, role, text): texts arrive
    as deltas of `chunk` characters. An assistant first streams its opening and then
    regenerates; other roles send a draft and edit it. The messages are stored with their
    keys, so that a repeated task finds the same ones."""
    text = F.coalesce("text", F.lit(""))
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    first = F.coalesce(F.get("chunks", F.lit(0)), F.lit(""))

    def event(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"))

    later = F.transform(F.slice("chunks", 2, F.greatest(F.size("chunks"), F.lit(1))), lambda c: event("delta", c))
    streamed = F.array(event("delta", first), event("regenerate", F.lit("")), event("delta", first))
    edited = F.array(event("delta", F.lit("...")), event("edit", first))
    learned = F.coalesce(F.col("role") == LEARNED_ROLE, F.lit(False))
    keyed = rows.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("message"))
    logged = stored(keyed, "messages").select(
        "conv_id", F.col("turn").alias("place"), "message", "role", chunks.alias("chunks"),
    )
    events = F.concat(F.when(learned, streamed).otherwise(edited), later)
    return logged.select("conv_id", "place", "message", "role", F.posexplode(events).alias("sequence", "event")).select(
        "conv_id", "place", "message", "role", "sequence", "event.kind", "event.text"
    )


def format_conversations(rows: DataFrame) -> DataFrame:
    """Parts with loss masks of the conversations in rows (conv_id, turn, role, text), by way
    of their event logs."""
    return render(fold_events(events_of_rows(rows)))


def written_and_read(rows: DataFrame) -> DataFrame:
    """Digests of the conversations, read back from the formatted output."""
    return digests(stored(format_conversations(rows), "conversations"))
