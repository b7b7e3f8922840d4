"""Chat formatting from event logs.

A conversation is a log of events, ordered by ``seq``, about its messages: ``open`` starts one with its role, ``delta``
appends streamed text, ``edit`` puts its text in place of what was there, ``regenerate`` throws the text away before it
is streamed again, ``delete`` takes the message back. Logs are dealt to tasks by ranges of (conversation, message), so a
conversation is one run of sorted events and a very large one spans several tasks; a task folds the events in one pass,
holding one message, and renders what is left.

The template is ``### <role>: <text></turn>\\n`` per message. Control strings inside roles and texts are escaped with a
backslash and a letter, so that they never occur where they are not control strings, and unescaping gives the text back.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.llm.common import stage

OPEN, SPLIT, CLOSE = "### ", ": ", "</turn>\n"
#: control string -> what stands for it inside texts; the backslash itself comes first
_ESCAPES = {"\\": "\\b", "### ": "\\h## ", "</turn>": "\\l/turn>"}
_ROLE_ESCAPES = _ESCAPES | {": ": "\\c "}
_UNESCAPE = re.compile(r"\\([bhlc])")
_LETTERS = {"b": "\\", "h": "#", "l": "<", "c": ":"}
LEARNED_ROLE = "assistant"

#: a formatted row closes at this many code points, so that no conversation has to fit one row
PART_CHARS = 1 << 20
#: code points of a streamed piece in :func:`conversation_log`, and the most pieces a text is cut into
DELTA_CHARS, MAX_DELTAS = 160, 64

_PART = "conv_id long, message string, n_turns long, formatted string, mask array<struct<start:long,end:long>>, whole boolean"


def escape(text: str, table: dict[str, str] = _ESCAPES) -> str:
    for control, stand_in in table.items():
        text = text.replace(control, stand_in)
    return text


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: _LETTERS[m[1]], text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The formatted message, and where its escaped text starts and ends."""
    head = f"{OPEN}{escape(role, _ROLE_ESCAPES)}{SPLIT}"
    body = escape(text)
    return f"{head}{body}{CLOSE}", len(head), len(head) + len(body)


def parse(formatted: str):
    """(role, text) of every message, exactly as it was rendered; raises on anything else."""
    at = 0
    while at < len(formatted):
        colon, close = formatted.find(SPLIT, at), formatted.find(CLOSE, at)
        if not formatted.startswith(OPEN, at) or colon < 0 or close < colon:
            raise ValueError(f"not a formatted turn at {at}")
        yield unescape(formatted[at + len(OPEN) : colon]), unescape(formatted[colon + len(SPLIT) : close])
        at = close + len(CLOSE)


def fold(events):
    """(conv_id, message, role, text) of every message that stands after ``events``, which come sorted; holds one message.

    A message stands from its ``open`` on until its ``delete``; other events of a message that does not stand, and
    unknown or null kinds, change nothing. Null roles and texts are empty.
    """
    key, role, parts = None, None, None
    for conv_id, message, kind, new_role, text in events:
        if (conv_id, message) != key:
            if parts is not None:
                yield *key, role, "".join(parts)
            key, parts = (conv_id, message), None
        if kind == "open":
            role, parts = new_role or "", []
        elif parts is None:
            continue
        elif kind == "delta":
            parts.append(text or "")
        elif kind == "edit":
            parts = [text or ""]
        elif kind == "regenerate":
            parts = []
        elif kind == "delete":
            parts = None
    if parts is not None:
        yield *key, role, "".join(parts)


def _rows(batches):
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batches(rows, schema: pa.Schema, weight, limit: int = 4 << 20):
    """Record batches of ``rows`` that close at ``limit`` by ``weight``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row) + 64
        if size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _parts(messages, part_chars: int):
    """Formatted rows of consecutive messages of one conversation.

    A row is ``whole`` if it surely holds its conversation, which the first and last ones of a task may share with others.
    """
    now, border = None, True
    for conv_id, message, role, text in messages:
        piece, start, end = render(role, text)
        if now is None or now[0] != conv_id or now[4] + len(piece) > part_chars:
            if now is not None:
                ended = now[0] != conv_id
                yield now[0], now[1], now[2], "".join(now[3]), now[5], ended and not border
                border = not ended
            now = [conv_id, message, 0, [], 0, []]
        if role == LEARNED_ROLE:
            now[5].append({"start": now[4] + start, "end": now[4] + end})
        now[2] += 1
        now[3].append(piece)
        now[4] += len(piece)
    if now is not None:
        yield now[0], now[1], now[2], "".join(now[3]), now[5], False


def format_conversations(log: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """``(conv_id, message, n_turns, formatted, mask, whole)`` from ``log (conv_id, message, seq, kind, role, text)``, stored.

    Messages stand in the order of their ``message`` strings (null first), events in that of ``seq`` (null first; equal
    ones by kind, role and text), so the rows of a conversation in the order of ``message`` make up its formatted text:
    one ``whole`` row, or others where it is beyond ``part_chars`` or at the border of a task. ``mask`` holds the spans, in
    code points of the row, of the escaped texts to learn from: those with role ``assistant``. A conversation without a
    standing message has no row; a null ``conv_id`` is a conversation of its own; repeated rows of the log count as
    often as they stand; other columns are ignored; an empty log gives no rows.
    """
    schema = pa.schema(
        [("conv_id", pa.int64()), ("message", pa.string()), ("n_turns", pa.int64()), ("formatted", pa.string())]
        + [("mask", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("whole", pa.bool_())]
    )

    def run(batches):
        yield from _batches(_parts(fold(_rows(batches)), part_chars), schema, lambda row: len(row[3]))

    order = ["conv_id", "message", "seq", "kind", "role", "text"]
    events = log.select(F.col("conv_id").cast("long"), F.col("message").cast("string"), "seq", "kind", "role", "text")
    dealt = events.repartitionByRange("conv_id", "message").sortWithinPartitions(*order).drop("seq")
    return stage(dealt.mapInArrow(run, _PART), "formatted-chats")


def _digests(parts):
    """One row for each conversation, from its formatted rows in order."""

    def told():
        return conv_id, turns, seen.hexdigest(), loss_chars, loss.hexdigest(), chars

    conv_id, turns = None, 0
    for row_id, formatted, mask in parts:
        if turns and row_id != conv_id:
            yield told()
            turns = 0
        if not turns:
            conv_id, seen, loss, loss_chars, chars = row_id, hashlib.sha256(), hashlib.sha256(), 0, 0
        for role, text in parse(formatted):
            turns += 1
            seen.update(f"{role}\n{text}\n".encode())
        for span in mask:
            learned = unescape(formatted[span["start"] : span["end"]])
            loss_chars += len(learned)
            loss.update(learned.encode())
        chars += len(formatted)
    if turns:
        yield told()


def chat_digests(formatted: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` read back from formatted rows.

    A digest runs over a conversation in order. Whole rows are read where they lie; the rows of another conversation go
    through one task, as a stream that holds a single row.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    schema = pa.schema(list(zip(names, types)))

    def run(batches):
        yield from _batches(_digests(_rows(batches)), schema, lambda row: 0)

    read = ["conv_id", "formatted", "mask"]
    dealt = formatted.where("NOT whole").select("message", *read).repartition("conv_id")
    ordered = dealt.sortWithinPartitions("conv_id", "message").select(*read)
    told = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.where("whole").select(*read).mapInArrow(run, told).union(ordered.mapInArrow(run, told))


def conversation_log(rows: DataFrame) -> DataFrame:
    """The events that lead to ``rows (conv_id, turn, role, text)``, as a chat front end would have logged them.

    Texts are streamed in pieces. By a hash of (conv_id, turn), one row in eight is regenerated after a first attempt,
    one is an edit of a shorter text, and one is followed by a message that is taken back. Turns are in order, null
    first; rows of one turn are ordered by role and the text's MD5. Nulls in role and text are empty.
    """
    text, number = F.coalesce("text", F.lit("")), F.col("turn").cast("decimal(20,0)") + F.expr("9223372036854775808BD")
    at = F.when(F.col("turn").isNull(), "0").otherwise(F.concat(F.lit("1"), F.lpad(number.cast("string"), 20, "0")))
    copy = F.monotonically_increasing_id().cast("string")
    message = F.concat_ws("|", at, F.coalesce("role", F.lit("")), F.md5(text), copy)
    case = F.pmod(F.crc32(F.concat_ws(":", "conv_id", "turn")), F.lit(8))
    plain = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), message.alias("message"), F.coalesce("role", F.lit("")).alias("role"),
        text.alias("text"), case.alias("case"), F.greatest(F.lit(DELTA_CHARS), F.ceil(F.length(text) / MAX_DELTAS)).cast("int").alias("size"),
    )

    def event(kind: str, text=None, suffix: str = ""):
        none = F.lit(None).cast("string")
        return F.struct(
            F.concat("message", F.lit(suffix)).alias("message"), F.lit(kind).alias("kind"),
            (F.col("role") if kind == "open" else none).alias("role"), (none if text is None else text).alias("text"),
        )

    steps = F.sequence(F.lit(0), F.floor(F.length("text") / F.col("size")).cast("int"))
    streamed = F.transform(steps, lambda i: event("delta", F.col("text").substr(i * F.col("size") + 1, F.col("size"))))
    first = event("delta", F.concat(F.substring("text", 1, 40), F.lit(" ...")))
    taken_back = [event(kind, F.lit("one moment"), "|later") for kind in ("open", "delta", "delete")]
    events = (
        F.when(F.col("case") == 1, F.concat(F.array(event("open"), first, event("regenerate")), streamed))
        .when(F.col("case") == 2, F.array(event("open"), first, event("edit", F.col("text"))))
        .when(F.col("case") == 3, F.concat(F.array(event("open")), streamed, F.array(*taken_back)))
        .otherwise(F.concat(F.array(event("open")), streamed))
    )
    return plain.select("conv_id", F.posexplode(events).alias("seq", "event")).select("conv_id", "seq", "event.*")
