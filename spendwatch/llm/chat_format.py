"""Chat formatting by prefix-target expansion.

``format_turns`` renders a conversation's turns, in order, as one stream of
marked turns and gives each turn its place in that stream.  ``with_examples``
makes one example of every assistant turn: the context is everything before it,
written out as a whole string, and only the reply is trainable.  The contexts of
a conversation of n turns hold n^2 text by nature; they are streamed, some
megabytes at a time.  ``digests`` reads every example back: its context has to be
the stream up to its target.

The template is ``<turn role=ROLE>TEXT</turn>`` and a line end.  Inside ROLE
and TEXT a backslash becomes ``\\\\``, ``<`` becomes ``\\l`` and ``>`` becomes
``\\g``; so no control string can occur there, and the change is reversible.

Conversations are dealt by conv_id and sorted by turn; a task streams them and
holds one turn at a time, where contexts are made or read one conversation's text.

Defined cases: null roles and texts are empty; equal turn numbers go by role
and text; null turns come first; repeated rows are repeated turns; a null
conv_id is a conversation of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from spendwatch.llm.common import empty_if_null, trimmed

ASSISTANT = "assistant"
HEAD, MIDDLE, TAIL = "<turn role=", ">", "</turn>\n"
_ESCAPED = {"\\": "\\\\", "<": "\\l", ">": "\\g"}
_PLAIN = {v[1]: k for k, v in _ESCAPED.items()}
BATCH_CHARS = 1 << 22  # of text in a batch of examples
_TURN = re.compile(f"{HEAD}([^<>]*){MIDDLE}([^<>]*){TAIL}", re.S)


def escape(text: str) -> str:
    return re.sub(r"[\\<>]", lambda m: _ESCAPED[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN[m[1]], text)


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    m = _TURN.fullmatch(formatted)
    if m is None:
        raise ValueError("not a formatted turn")
    return unescape(m[1]), unescape(m[2])


def format_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 0), formatted, start, end, target_start, target_end (null unless trainable).

    Positions are code points in the conversation's stream; the rows of a
    conversation come out of one task, in order.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, place, at = object(), 0, 0
        for batch in batches:
            rows = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in (0, 1, 2))):
                if conv != current:
                    current, place, at = conv, 0, 0
                head = HEAD + escape(role) + MIDDLE
                body = escape(text)
                end = at + len(head) + len(body) + len(TAIL)
                target = (at + len(head), at + len(head) + len(body)) if role == ASSISTANT else (None, None)
                rows.append((conv, place, head + body + TAIL, at, end, *target))
                place, at = place + 1, end
            kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4]
            cols = zip(*rows) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["conv_id", "place", "formatted", "start", "end", "target_start", "target_end"])

    plain = trimmed(turns, "conv_id", "turn", "role", "text").select(
        "conv_id", empty_if_null("role").alias("role"), empty_if_null("text").alias("text"), "turn")
    return (plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(
        run, "conv_id long, place long, formatted string, start long, end long, target_start long, target_end long"))


def with_examples(formatted: DataFrame) -> DataFrame:
    """The turns in their stream, each assistant turn with its example; null for the other turns.

    An example is its context as a whole string, the target and their positions in the
    stream; takes the rows as ``format_turns`` gives them, in order.
    """
    names = ["conv_id", "place", "formatted", "start", "end", "target_start", "target_end"]
    places = ["context_end", "target_start", "target_end"]
    kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4,
             pa.struct([*((c, pa.int64()) for c in places), ("context", pa.string()), ("target", pa.string())])]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[*names, "example"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, before = object(), []
        for batch in batches:
            rows, chars = [], 0
            for turn in zip(*(batch.column(c).to_pylist() for c in range(7))):
                conv, _, text, start, _, lo, hi = turn
                if conv != current:
                    current, before = conv, []
                example = None
                if lo is not None:
                    before = ["".join(before)]
                    example = dict(zip(places, (lo, lo, hi)), context=before[0] + text[:lo - start], target=text[lo - start:hi - start])
                    chars += len(example["context"])
                before.append(text)
                rows.append((*turn, example))
                chars += len(text)
                if chars >= BATCH_CHARS:
                    yield batch_of(rows)
                    rows, chars = [], 0
            if rows:
                yield batch_of(rows)

    return formatted.select(*names).mapInArrow(
        run, "conv_id long, place long, formatted string, start long, end long, target_start long, target_end long, "
             "example struct<context_end: long, target_start: long, target_end: long, context: string, target: string>")


def examples(formatted: DataFrame) -> DataFrame:
    """One example per assistant turn: context [0, context_end) and target [target_start, target_end) with their texts."""
    return with_examples(formatted).where("example is not null").select("conv_id", "place", "example.*")


def expand(formatted: DataFrame) -> DataFrame:
    """conv_id, place, context, target as whole strings, straight from ``format_turns``."""
    return examples(formatted).select("conv_id", "place", "context", "target")


def digests(formatted: DataFrame) -> DataFrame:
    """What each conversation says, read back from its formatted turns, and what its examples train on.

    Every context is compared with the stream as read so far, so an example that misses a
    part of its prefix is an error.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        state: list | None = None
        stream: list[str] = []

        def row(s: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([s[0]], pa.int64()), pa.array([s[1]], pa.int64()), pa.array([s[2].hexdigest()]),
                pa.array([s[3]], pa.int64()), pa.array([s[4].hexdigest()]), pa.array([s[5]], pa.int64())],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        def merged(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if rows:
                yield from pa.Table.from_batches(rows).combine_chunks().to_batches()

        for batch in batches:
            done = []
            for conv, text, start, end, context, target in zip(*(batch.column(c).to_pylist() for c in range(6))):
                if state is None or conv != state[0]:
                    if state is not None:
                        done.append(row(state))
                    state, stream = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0], []
                role, said = parse_turn(text)
                state[1] += 1
                state[2].update(f"{role}\n{said}\n".encode())
                if target is not None:
                    # The context is the stream as read so far, up to the reply.
                    stream = ["".join(stream)]
                    if start != state[5] or context != stream[0] + text[:len(context) - start] or text[len(context) - start:] != target + TAIL:
                        raise ValueError("an example does not fit its stream")
                    target = unescape(target)
                    state[3] += len(target)
                    state[4].update(target.encode())
                stream.append(text)
                state[5] = end
            yield from merged(done)
        if state is not None:
            yield row(state)

    return with_examples(formatted).select("conv_id", "formatted", "start", "end", "example.context", "example.target").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
