"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events in order of sequence.  ``message`` starts a turn;
``delta`` adds text to the last turn; ``edit`` replaces the text of turn ``target``
(0 is the first; without a target, the last turn) and drops the turns after it, as a
user who edits a prompt starts over from there; ``regenerate`` empties the last turn,
whose new text follows in deltas.  Folding the events gives the final messages, which
are rendered with the template

    <s>role \\n text </s> \\n          (without the blanks)

Control strings inside roles and texts get one backslash more after their first
character, and reading takes one away, so that no text can end or begin a turn and
every text comes back exactly.  A line break in a role is written as a control
string of its own.

How it runs: logs are dealt by conversation and sorted by sequence in one shuffle; a
task reads them as a stream and renders turn by turn, into parts of bounded size.
Turns that an edit could still drop are held; a conversation without edits needs its
last turn in memory, whatever its length.  A conversation is one stream (its digest is
of its turns in order), but never one record in memory.

Defined cases: a null text is empty; a null role is empty; rows of equal sequence are
taken in order of role and text; a null sequence comes first; a delta, edit or
regenerate before any message starts an assistant turn; unknown events are messages;
a null conversation id is a conversation; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import batches, col, tuples

#: The template's control strings; [INST] and the like are those of common chat models.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<br>")
_CONTROL = re.compile(r"([<\[])(\\*)(?=(?:/?s>|/?INST\]|</?SYS>>|br>))")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(?=(?:/?s>|/?INST\]|</?SYS>>|br>))")
_TURN = re.compile(r"<s>(.*?)\n(.*?)</s>\n", re.S)
#: Characters of a part of the output, about.
PART_CHARS = 1 << 20
LEARNED_ROLE = "assistant"


def escaped(text: str) -> str:
    """``text`` with each control string marked; control strings that already carry
    backslashes get one more."""
    return _CONTROL.sub(r"\1\2\\", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its text begins and ends."""
    head = "<s>" + escaped(role).replace("\n", "<br>") + "\n"
    body = escaped(text)
    return head + body + "</s>\n", len(head), len(head) + len(body)


def read_turns(part: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a rendered part."""
    at = 0
    while at < len(part):
        m = _TURN.match(part, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        yield unescaped(m[1].replace("<br>", "\n")), unescaped(m[2])
        at = m.end()


def folded(events: Iterator[tuple[str | None, str | None, str | None, int | None]], hold: bool
           ) -> Iterator[tuple[str, str]]:
    """Final (role, text) turns of one conversation's events (kind, role, text, target).

    With ``hold`` (the log has edits) turns are kept until the end; otherwise each is
    given out when the next begins."""
    turns: list[list] = []
    for kind, role, text, target in events:
        text = text or ""
        if kind in ("delta", "edit", "regenerate") and not turns:
            turns.append([role or LEARNED_ROLE, []])
        if kind == "delta":
            turns[-1][1].append(text)
        elif kind == "regenerate":
            turns[-1][1] = [text]
        elif kind == "edit":
            if target is not None and 0 <= target < len(turns):
                del turns[target + 1:]
            turns[-1][1] = [text]
        else:
            if not hold and turns:
                yield turns[0][0], "".join(turns[0][1])
                turns.clear()
            turns.append([role or "", [text]])
    for role, pieces in turns:
        yield role, "".join(pieces)


_PARTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("formatted", pa.string()),
                    ("loss_spans", pa.list_(pa.int32()))])


def _format(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: events sorted by conversation and sequence -> rendered parts."""

    def rows():
        source = tuples(parts)
        row = next(source, None)
        while row is not None:
            conv, hold = row[0], bool(row[5])

            def own():
                nonlocal row
                while row is not None and row[0] == conv:
                    yield row[1:5]
                    row = next(source, None)

            number, pieces, spans, size = 0, [], [], 0
            for role, text in folded(own(), hold):
                turn, begin, end = rendered(role, text)
                if role == LEARNED_ROLE:
                    spans += [size + begin, size + end]
                pieces.append(turn)
                size += len(turn)
                if size >= PART_CHARS:
                    yield conv, number, "".join(pieces), spans
                    number, pieces, spans, size = number + 1, [], [], 0
            if pieces or not number:
                yield conv, number, "".join(pieces), spans

    yield from batches(rows(), _PARTS, 2048)


def format_chats(log: DataFrame, *, conv_id: str = "conv_id", sequence: str = "turn", role: str = "role",
                 text: str = "text", kind: str | None = None, target: str | None = None) -> DataFrame:
    """conv_id, part, formatted and loss_spans (begin and end, in characters, of the texts
    that are learned: those of the assistant) for every part of every conversation,
    parts of a conversation in order in one partition."""
    event: Column = F.lit("message") if kind is None else col(kind).cast("string")
    events = log.select(
        col(conv_id).cast("bigint").alias("conv_id"), event.alias("kind"), col(role).cast("string").alias("role"),
        col(text).cast("string").alias("text"),
        (F.lit(None) if target is None else col(target)).cast("int").alias("target"),
        col(sequence).cast("bigint").alias("sequence"))
    if kind is None:
        events = events.withColumn("edited", F.lit(False))
    else:
        edited = events.where("kind = 'edit'").select(F.col("conv_id").alias("c")).distinct()
        events = (events.join(edited, F.col("conv_id").eqNullSafe(F.col("c")) & F.lit(True), "left")
                  .withColumn("edited", F.col("c").isNotNull()).drop("c"))
    return (events.repartition("conv_id").sortWithinPartitions("conv_id", "sequence", "role", "text")
            .select("conv_id", "kind", "role", "text", "target", "edited")
            .mapInArrow(_format, "conv_id bigint, part int, formatted string, loss_spans array<int>"))


_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                   ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _read_back(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        conv, state = None, None
        for own, number, formatted, spans in tuples(parts):
            if state is None or own != conv:
                if state is not None:
                    yield _summary(conv, state)
                conv, state = own, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in read_turns(formatted):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for begin, end in zip(spans[::2], spans[1::2]):
                learned = unescaped(formatted[begin:end])
                state[2] += len(learned)
                state[3].update(learned.encode("utf-8", "surrogatepass"))
            state[4] += len(formatted)
        if state is not None:
            yield _summary(conv, state)

    yield from batches(rows(), _READ, 4096)


def _summary(conv, state):
    return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]


def chat_report(log: DataFrame, **options) -> DataFrame:
    """Per conversation, read back from the formatted output: turns and the digest of
    their roles and texts, learned text and its digest, characters of the output."""
    return format_chats(log, **options).mapInArrow(
        _read_back, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                    "loss_sha256 string, formatted_chars bigint")
