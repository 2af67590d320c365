"""Chat formatting from event logs.

A conversation's log is a sequence of events: messages, streamed deltas, edits and regenerations.
The log is partitioned by conversation and sorted by sequence, so that one pass over a partition
folds it turn by turn. A message is final once the next one starts, unless a later event edits or
regenerates it; such events are brought to the message they change before the fold, by sorting on
(conversation, message, event). Memory is one message, however long the conversation.

Template: ``<|im_start|>role``, a line break, the text, ``<|im_end|>``, a line break. Control
strings inside roles and texts are broken by a backslash after their first character, backslashes
are doubled, and a line break in a role gets a backslash before it: a backslash thus always stands
before the character it protects, and removing it gives back what was there.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that a text must not smuggle in: this template's and other common ones.
CONTROL = [
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
]
_PROTECT = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_FREE = re.compile(r"\\(.)", re.S)
LOSS_ROLE = "assistant"
#: Events: the first of a message sets its role and text, a delta appends, an edit replaces the
#: text, a regeneration empties it for the deltas that follow, a deletion drops the message.
KINDS = ("message", "delta", "edit", "regenerate", "delete")


def escape(text: str) -> str:
    return _PROTECT.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _FREE.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its text stands in it."""
    head = START + escape(role).replace("\n", "\\\n") + "\n"
    body = escape(text)
    return head + body + END + "\n", len(head), len(head) + len(body)


_TURN = re.compile(
    re.escape(START) + r"((?:[^\\\n]|\\.)*)\n((?:(?!" + re.escape(END) + r").)*)" + re.escape(END) + r"\n", re.S
)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of an output."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        yield unescape(m[1]), unescape(m[2])
        at = m.end()


_FOLDED = "conv_id long, turn long, n long, formatted string, loss_start int, loss_end int"


def _fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted events (conv_id, turn, message, seq, kind, role, text) -> formatted turns."""
    open_message: list | None = None  # [conv_id, turn, message, role, parts, alive]
    last: tuple | None = None  # (conv_id, number) of the last turn given out
    rows: list[tuple] = []

    def close():
        nonlocal last
        if open_message and open_message[5]:
            conv, turn, _, role, parts, _ = open_message
            last = (conv, last[1] + 1 if last and last[0] == conv else 0)
            text, a, b = render(role, "".join(parts))
            rows.append((conv, turn, last[1], text, *((a, b) if role == LOSS_ROLE else (None, None))))

    def flush():
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32())
        rows.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            ["conv_id", "turn", "n", "formatted", "loss_start", "loss_end"],
        )

    for batch in batches:
        for conv, turn, message, _, kind, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if open_message is None or open_message[:3] != [conv, turn, message]:
                close()
                open_message = [conv, turn, message, role or "", [], True]
            if kind == "message":
                open_message[3:6] = role or "", [text or ""], True
            elif kind == "delta":
                open_message[4].append(text or "")
            elif kind in ("edit", "regenerate"):
                open_message[4] = [text or ""]
            elif kind == "delete":
                open_message[5] = False
        yield flush()
    close()
    yield flush()


def format_events(events: DataFrame) -> DataFrame:
    """Events (conv_id, turn, message, seq, kind, role, text) -> one formatted turn per row.

    ``turn`` orders a conversation's messages and ``message`` tells those of one turn apart; ``seq``
    orders the events of a message, ties by kind and text. Out come (conv_id, turn, n, formatted,
    loss_start, loss_end), n counting a conversation's turns from 0, the loss span being the
    escaped text of assistant turns. A conversation's turns are sorted within one partition; ids
    and turns may be null (nulls come first and are one conversation), as may role and text
    (empty). A message without a "message" event takes its first event's role. Unknown kinds have
    no effect. No events give no turns; other columns are ignored.
    """
    columns = ["conv_id", "turn", "message", "seq", "kind", "role", "text"]
    typed = [F.col(c).cast("string" if c in ("message", "kind", "role", "text") else "long").alias(c) for c in columns]
    order = F.coalesce(F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")), F.lit(0))
    return (
        events.select(*typed).repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "message", "seq", order, "role", "text")
        .mapInArrow(_fold, _FOLDED)
    )


def row_events(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as logs of one message event per row.

    Rows of one turn stay apart, equal rows too: a row that comes k times is k messages.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    ).groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("k"))
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("k"))).alias("copy")
    name = F.concat_ws(
        " ", F.coalesce("role", F.lit("")), F.hex(F.xxhash64("role", "text")), F.col("copy").cast("string")
    )
    return rows.select("*", copy).select(
        "conv_id", "turn", name.alias("message"), F.lit(0).alias("seq"), F.lit("message").alias("kind"), "role", "text"
    )


#: Pieces in which a text is streamed, at most, and what a superseded draft says.
PIECES = 4
DRAFT = "a draft <|im_end|> that must not stay"


def streamed_events(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as logs that lead to them, as a chat service would keep them.

    Every text is streamed: a first event and up to ``PIECES - 1`` deltas. By a hash of the message, a third of
    the messages are so from the start; a third begin with a streamed draft that is regenerated; and in a third
    an edit replaces the draft before the deltas go on. Nulls and repeats as in :func:`row_events`.
    """
    text = F.coalesce("text", F.lit(""))
    step = F.greatest(F.ceil(F.length(text) / PIECES), F.lit(1))
    starts = F.sequence(F.lit(1).cast("long"), F.greatest(F.length(text), F.lit(1)).cast("long"), step)
    pieces = F.transform(starts, lambda i: F.substring(text, i.cast("int"), step.cast("int")))

    def event(kind: str, said: Column | str | None, role: Column | None = None) -> Column:
        said = said if isinstance(said, Column) else F.lit(said).cast("string")
        role = F.lit(None).cast("string") if role is None else role
        return F.struct(F.lit(kind).alias("kind"), role.alias("role"), said.alias("text"))

    def streamed(some: Column) -> Column:
        return F.transform(some, lambda x: event("delta", x))

    role, rest = F.col("role").cast("string"), streamed(F.slice("pieces", 2, PIECES))
    ways = [
        F.concat(F.array(event("message", F.col("pieces")[0], role)), rest),
        F.concat(
            F.array(event("message", DRAFT, role), event("delta", DRAFT), event("regenerate", None)), streamed(F.col("pieces"))
        ),
        F.concat(F.array(event("message", DRAFT, role), event("edit", F.col("pieces")[0])), rest),
    ]
    way = F.pmod(F.xxhash64("conv_id", "turn", "message"), F.lit(len(ways)))
    log = F.when(way == 0, ways[0]).when(way == 1, ways[1]).otherwise(ways[2])
    messages = row_events(conversations).withColumn("pieces", pieces)
    events = messages.select("conv_id", "turn", "message", F.posexplode(log).alias("seq", "event"))
    return events.select("conv_id", "turn", "message", "seq", "event.*")


_READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Formatted turns in order -> digests of what can be read back from them."""
    conv: tuple | None = None
    state: list = []
    rows: list[tuple] = []

    def close():
        if conv is not None:
            turns, n, loss, loss_chars, chars = state
            rows.append((conv[0], n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

    def flush():
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = [x.split()[0] for x in _READ.split(", ")]
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        for at, _, _, formatted, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if conv != (at,):
                close()
                conv, state = (at,), [hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            for role, text in parse(formatted):
                state[0].update(f"{role}\n{text}\n".encode())
                state[1] += 1
            if a is not None:
                trained = unescape(formatted[a:b])
                state[2].update(trained.encode())
                state[3] += len(trained)
            state[4] += len(formatted)
        yield flush()
    close()
    yield flush()


def read_back(turns: DataFrame) -> DataFrame:
    """Per conversation of :func:`format_events` output, as it is partitioned and sorted: number
    and digest of the turns read back, the characters under the loss mask, and the length."""
    return turns.mapInArrow(_read, _READ)
