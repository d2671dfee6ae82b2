"""Chat formatting from event logs.

A conversation is a log of events (conv_id, seq, kind, turn, role, text):

* ``message`` starts a message in the slot ``turn`` with a role and a text;
* ``delta`` appends text to the slot's newest message, as streams do;
* ``edit`` replaces the text of the slot's newest message, its role stays;
* ``regenerate`` takes back the slot's messages and all that came in later
  slots up to then; what follows in the log fills the slots anew.  Its role and
  text, if it has any, open the new message.

A log is dealt out by conversation and slot and sorted by sequence, so a task folds
one slot at a time and a long conversation spreads over many tasks.  What a
``regenerate`` takes back in later slots is one number per slot, a running maximum
over the slots of those conversations that have such an event at all.

A message is rendered as ``START role MIDDLE text END``.  Every control string
begins with ``<|``, so inside roles and texts one backslash goes between ``<`` and
``|`` (behind any backslashes there already); taking one away restores the text.
The loss mask is the span of the text of each assistant message.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LEARNED = ("assistant",)
EVENTS = "conv_id bigint, seq bigint, kind string, turn bigint, role string, text string"
_KINDS = {"regenerate": 0, "message": 1, "edit": 2, "delta": 3}
_PLAIN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_SEGMENT = re.compile(re.escape(START) + "(.*?)" + re.escape(MIDDLE) + "(.*?)" + re.escape(END), re.S)


def escaped(text: Column) -> Column:
    """Text without control strings; undone by unescape()."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"<{m[1]}|", text)


def _floors(events: DataFrame) -> DataFrame:
    """(conv_id, turn, floor): events of the slot with a lower seq were taken back by an earlier slot."""
    again = events.where(F.col("kind") == "regenerate").select(F.coalesce("conv_id", F.lit(None)).alias("conv_id")).distinct()
    own = events.join(again, events["conv_id"].eqNullSafe(again["conv_id"]), "left_semi")
    slots = own.groupBy("conv_id", "turn").agg(F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("last"))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return slots.withColumn("floor", F.max("last").over(before)).where("floor is not null").select("conv_id", "turn", "floor")


MESSAGES = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("part", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages of slots whose events arrive in order; one slot is held at a time."""
    slot, held, done = None, [], []

    def closed() -> None:
        done.extend((*slot, i, role, "".join(parts)) for i, (role, parts) in enumerate(held))

    for batch in batches:
        for conv_id, turn, kind, role, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if slot != (conv_id, turn):
                if slot is not None:
                    closed()
                slot, held = (conv_id, turn), []
            if kind == 0:
                held = []
                if role is None and text is None:
                    continue
            elif kind in (2, 3) and held:
                if kind == 2:
                    held[-1][1].clear()
                held[-1][1].append(text or "")
                continue
            held.append((role or "", [text or ""]))
        if done:
            yield _rows(done)
            done.clear()
    if slot is not None:
        closed()
    if done:
        yield _rows(done)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*rows), MESSAGES)], MESSAGES)


def folded(events: DataFrame) -> DataFrame:
    """(conv_id, turn, part, role, text): the final messages of event logs with the columns of EVENTS.

    Null conv_ids are one conversation, null turns its first slot, null roles and
    texts empty.  A slot may hold several messages, numbered by ``part``.  Events of
    one sequence number are taken in the order regenerate, message, edit, delta, then
    by role and text; repeated rows count as often as they occur.  A delta or edit
    without a message starts one.  Unknown kinds are an error.  Other columns are not
    read; an empty log gives no rows.
    """
    events = events.select("conv_id", "seq", "kind", "turn", "role", "text")
    kind = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for k, i in _KINDS.items()], F.raise_error(F.lit("unknown kind of event")).cast("int"))
    floors = _floors(events).select(F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), "floor")
    own = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("turn").eqNullSafe(F.col("_turn"))
    kept = events.join(floors, own, "left").where(F.col("floor").isNull() | F.col("seq").isNull() | (F.col("seq") >= F.col("floor")))
    coded = kept.select("conv_id", "turn", "seq", kind.alias("kind"), "role", "text")
    dealt = coded.repartition("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "seq", "kind", "role", "text")
    return dealt.select("conv_id", "turn", "kind", "role", "text").mapInArrow(_fold, "conv_id long, turn long, part long, role string, text string")


def rendered(messages: DataFrame, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """messages with columns formatted, loss_start and loss_end (code points within formatted; null: not learned).

    The text of a conversation is its rows' ``formatted`` by turn and part, nothing
    between.  Null roles and texts are empty.
    """
    role, text = (escaped(F.coalesce(F.col(c), F.lit(""))) for c in ("role", "text"))
    head = F.concat(F.lit(START), role, F.lit(MIDDLE))
    taught = F.coalesce(F.col("role").isin(*learned), F.lit(False))
    return messages.withColumns(
        {
            "formatted": F.concat(head, text, F.lit(END)),
            "loss_start": F.when(taught, F.char_length(head)),
            "loss_end": F.when(taught, F.char_length(head) + F.char_length(text)),
        }
    )


def formatted(events: DataFrame, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """Event logs folded and rendered: a row per message with its part of the training text."""
    return rendered(folded(events), learned)


DIGESTS = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


class _Digest:
    def __init__(self):
        self.turns, self.loss, self.n, self.loss_chars, self.chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def add(self, text: str, start: int | None, end: int | None) -> None:
        """Read one rendered message back."""
        for match in _SEGMENT.finditer(text):
            role, own = map(unescape, match.groups())
            self.turns.update(f"{role}\n{own}\n".encode())
            self.n += 1
        if start is not None:
            learned = unescape(text[start:end])
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.chars += len(text)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, own, done = None, None, []

    def closed() -> tuple:
        return now, own.n, own.turns.hexdigest(), own.loss_chars, own.loss.hexdigest(), own.chars

    for batch in batches:
        for conv_id, text, start, end in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if own is None or conv_id != now:
                if own is not None:
                    done.append(closed())
                now, own = conv_id, _Digest()
            own.add(text, start, end)
    if own is not None:
        done.append(closed())
    if done:
        yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*done), DIGESTS)], DIGESTS)


def digests(messages: DataFrame) -> DataFrame:
    """One row per conversation, read back from the output of formatted().

    A digest of a whole conversation has to see its text in order, so a conversation
    passes through one task here, as a stream: nothing but the running digests is kept.
    """
    dealt = messages.select("conv_id", "turn", "part", "formatted", "loss_start", "loss_end").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "part")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return dealt.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(_digest, schema)
