"""Chat formatting by prefix-target expansion.

Every turn is written between two marks of its role. Every assistant turn becomes an
example of its own: all turns before it, then its text, and only that text is under the
loss mask. Turns after the last assistant turn (or all turns, if there is none) make a
last example without a target, so the output holds the whole conversation.

Control strings inside texts are escaped by a backslash before them; one that already
has n backslashes before it gets n + 1. Reading takes one away again, so any text comes
back as it was.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import shuffle_partitions

#: Fixed marks by role: opening and closing.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER = ("[ROLE]", "[/ROLE]")
TARGET = "assistant"
CONTROL = [m for pair in (*MARKS.values(), OTHER) for m in pair]
_CONTROL = re.compile(r"(\\*)(" + "|".join(map(re.escape, CONTROL)) + ")")
_ESCAPED = re.compile(r"\\(\\*(?:" + "|".join(map(re.escape, CONTROL)) + "))")
_OPEN = {pair[0]: (role, pair[1]) for role, pair in MARKS.items()} | {OTHER[0]: (None, OTHER[1])}

EXAMPLE = "example long, n_turns long, text string, loss_start long, loss_end long"


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """Opening, escaped text and closing of one turn; a role without marks of its own is written in the turn."""
    if role in MARKS:
        return f"{MARKS[role][0]} ", escape(text), f" {MARKS[role][1]}"
    return f"{OTHER[0]} {escape(role)} {OTHER[0]} ", escape(text), f" {OTHER[1]}"


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted string."""
    marks = [m for m in _CONTROL.finditer(formatted) if not m.group(1)]
    out, i = [], 0
    while i < len(marks):
        role, closing = _OPEN[marks[i].group(2)]
        start = marks[i].end()
        if role is None:
            i += 1
            role = unescape(formatted[start + 1 : marks[i].start() - 1])
            start = marks[i].end()
        if marks[i + 1].group(2) != closing:
            raise ValueError("marks do not pair")
        out.append((role, unescape(formatted[start + 1 : marks[i + 1].start() - 1])))
        i += 2
    return out


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by conversation and turn; only the prefix of the current conversation is held."""
    none = object()
    conv, prefix, size, turns, number, told = none, [], 0, 0, 0, 0
    rows: list[tuple] = []

    def rest():
        if conv is not none and turns > told:
            rows.append((conv, number, turns, "".join(prefix), size, size))

    def flushed(id_type):
        cols = list(zip(*rows)) or [()] * 6
        types = [id_type, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["conv_id", "example", "n_turns", "text", "loss_start", "loss_end"])
        rows.clear()
        return batch

    id_type = pa.int64()
    for batch in batches:
        id_type = batch.schema.field(0).type
        for c, role, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if conv is none or c != conv:
                rest()
                conv, prefix, size, turns, number, told = c, [], 0, 0, 0, 0
            begin, body, end = turn_parts(role or "", text or "")
            turns += 1
            prefix.append(begin + body + end)
            if role == TARGET:
                whole = "".join(prefix)
                prefix = [whole]
                rows.append((conv, number, turns, whole, size + len(begin), size + len(begin) + len(body)))
                number, told = number + 1, turns
                if sum(len(r[3]) for r in rows[-64:]) > 1 << 22:
                    yield flushed(id_type)
            size += len(begin) + len(body) + len(end)
        if rows:
            yield flushed(id_type)
    rest()
    if rows:
        yield flushed(id_type)


def chat_examples(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per example: (conv_id, example, n_turns, text, loss_start, loss_end).

    ``text[loss_start:loss_end]`` (code points) is the escaped reply, all that is
    trainable. Turns go by ``turn``, ties by role, then text; a null turn comes first; a
    null text or role is empty; null conversation ids are one conversation; repeated
    rows are turns of their own; an empty table gives no rows; other columns are ignored.
    A conversation is read in order as a stream; what is held is one example.
    """
    id_type = turns.schema[conv_col].dataType.simpleString()
    own = turns.select(F.col(conv_col).alias("conv_id"), "role", "text", "turn").repartition(shuffle_partitions(turns.sparkSession), "conv_id")
    ordered = own.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return ordered.mapInArrow(_expand, f"conv_id {id_type}, {EXAMPLE}")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none = object()
    conv, last, chars, loss_chars, loss = none, "", 0, 0, hashlib.sha256()
    out: list[tuple] = []
    id_type = pa.int64()

    def close():
        if conv is none:
            return
        turns = read_turns(last)
        every = hashlib.sha256()
        for role, text in turns:
            every.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        out.append((conv, len(turns), every.hexdigest(), loss_chars, loss.hexdigest(), chars))

    def flushed():
        types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 6, types)], names=names)
        out.clear()
        return batch

    for batch in batches:
        id_type = batch.schema.field(0).type
        cols = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("conv_id", "text", "loss_start", "loss_end")]
        for c, text, start, end in zip(*cols):
            if conv is none or c != conv:
                close()
                conv, chars, loss_chars, loss = c, 0, 0, hashlib.sha256()
            last = text
            chars += len(text)
            reply = unescape(text[start:end])
            loss_chars += len(reply)
            loss.update(reply.encode("utf-8", "surrogatepass"))
        if out:
            yield flushed()
    close()
    yield flushed()


def chat_digest(examples: DataFrame) -> DataFrame:
    """Digests per conversation, read back from ``chat_examples`` (whose order it needs): turns from the last
    example, which holds all of them, and the text under the mask from every example; ``formatted_chars`` is
    the length of all examples together."""
    id_type = examples.schema["conv_id"].dataType.simpleString()
    return examples.mapInArrow(_digest, f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
