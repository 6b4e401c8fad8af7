"""Chat formatting by columnar byte assembly."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lodestat.llm.common import in_batches, utf8

#: A turn is ``### role``, a new line, the text, ``</turn>`` and a new line. Inside roles
#: and texts ``\\``, ``\h`` and ``\l`` stand for a backslash, ``#`` and ``<``, and in roles ``\n`` for
#: a new line, so neither mark can occur there.
HEAD, FOOT = b"### ", b"</turn>\n"
LEARNED_ROLE = b"assistant"
#: A conversation longer than this goes out in several parts, in order.
PART_BYTES = 8 << 20
_TEXT_MARKS = np.zeros(256, bool)
_TEXT_MARKS[list(b"\\#<")] = True
_ROLE_MARKS = _TEXT_MARKS.copy()
_ROLE_MARKS[10] = True
_CODES = {ord("\\"): ord("\\"), ord("#"): ord("h"), ord("<"): ord("l"), 10: ord("n")}
_MEANINGS = {bytes([code]): bytes([sign]) for sign, code in _CODES.items()}


def _column(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column without nulls."""
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1]
    data = values.buffers()[2]
    held = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.empty(0, np.uint8)
    return held, (offsets - offsets[0]).astype(np.int64)


def _escaped(values: pa.Array, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes to write, each one's place within the escaped column, and the escaped offsets of the rows."""
    data, offsets = _column(values)
    before = np.concatenate(([0], np.cumsum(marks[data])))
    codes = np.arange(256, dtype=np.uint8)
    for sign in np.flatnonzero(marks).tolist():
        codes[sign] = _CODES[sign]
    return codes[data], np.arange(len(data)) + before[1:], offsets + before[offsets]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Formatted turns as one binary column, and where each text starts and ends in its turn.

    All segment lengths are computed first; one buffer is allocated, and headers, roles, texts and
    footers are scattered into it.
    """
    n = len(roles)
    role_data, role_at, role_off = _escaped(roles, _ROLE_MARKS)
    text_data, text_at, text_off = _escaped(texts, _TEXT_MARKS)
    role_len, text_len = np.diff(role_off), np.diff(text_off)
    text_start = len(HEAD) + role_len + 1
    ends = np.cumsum(text_start + text_len + len(FOOT))
    starts = np.concatenate(([0], ends))[:-1]
    out = np.full(int(ends[-1]) if n else 0, ord("\\"), np.uint8)
    for k, b in enumerate(HEAD):
        out[starts + k] = b
    out[starts + text_start - 1] = 10
    for k, b in enumerate(FOOT):
        out[starts + text_start + text_len + k] = b

    def scatter(data, at, offsets, raw, where):
        row = np.repeat(np.arange(n), np.diff(raw))
        out[where[row] + at - offsets[row]] = data

    scatter(role_data, role_at, role_off, _column(roles)[1], starts + len(HEAD))
    scatter(text_data, text_at, text_off, _column(texts)[1], starts + text_start)
    offsets = np.concatenate(([0], ends)).astype(np.int64)
    turns = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(out)])
    return turns, text_start, text_start + text_len


def _parts(batches):
    """Join neighbouring turns of one conversation; rows come in order."""
    held, spans, size, conv, part, turns = [], [], 0, None, 0, 0

    def row():
        return {"conv_id": conv, "part": part, "n_turns": turns, "formatted": b"".join(held), "loss": spans}

    for batch in batches:
        made = []
        formatted, first, behind = assemble(batch.column("role"), batch.column("body"))
        roles, ids = batch.column("role").to_pylist(), batch.column("conv_id").to_pylist()
        for i, c in enumerate(ids):
            if turns and (c != conv or size >= PART_BYTES):
                made.append(row())
                part = part + 1 if c == conv else 0
                held, spans, size, turns = [], [], 0, 0
            conv = c
            body = formatted[i].as_py()
            if roles[i] == LEARNED_ROLE:
                spans.append({"first": size + int(first[i]), "behind": size + int(behind[i])})
            held.append(body)
            size += len(body)
            turns += 1
        if made:
            yield made
    if turns:
        yield [row()]


def format_chats(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """``conv_id, part, n_turns, formatted, loss``: formatted bytes and the spans under the loss mask.

    Rows of a conversation are ordered by turn, then role and text; a null turn comes
    first, and a null role or text is empty. Repeated rows are turns of their own. A
    null conversation id is an id like any other. The mask covers the texts of
    assistant turns. Conversations over ``PART_BYTES`` come in several parts, numbered
    from 0, so no task ever holds more than one part; parts of a conversation follow each other
    in one partition. Other columns are not read; an empty table gives no rows.
    """
    slim = conversations.select(F.col(key).alias("conv_id"), F.col(turn).alias("turn"), utf8(role).alias("role"), utf8(text).alias("body"))
    ordered = slim.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "body")
    span = T.StructType([T.StructField("first", T.LongType()), T.StructField("behind", T.LongType())])
    schema = T.StructType([slim.schema["conv_id"], T.StructField("part", T.LongType()), T.StructField("n_turns", T.LongType()),
                           T.StructField("formatted", T.BinaryType()), T.StructField("loss", T.ArrayType(span))])
    kinds = pa.schema([("part", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.binary()),
                       ("loss", pa.list_(pa.struct([("first", pa.int64()), ("behind", pa.int64())])))])

    def run(batches):
        kind = None

        def seen():
            nonlocal kind
            for b in batches:
                kind = b.schema.field("conv_id")
                yield b

        for rows in _parts(seen()):
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([kind, *kinds]))

    return ordered.transform(in_batches, run, schema)


def unescape(data: bytes) -> bytes:
    """Undo the escaping."""
    if b"\\" not in data:
        return data
    out, at = [], 0
    while (found := data.find(b"\\", at)) >= 0:
        out += data[at:found], _MEANINGS[data[found + 1:found + 2]]
        at = found + 2
    return b"".join([*out, data[at:]])


def parse(formatted: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Roles and texts of formatted turns."""
    at = 0
    while at < len(formatted):
        if formatted[at:at + len(HEAD)] != HEAD:
            raise ValueError("a turn must start with its mark")
        line = formatted.index(b"\n", at + len(HEAD))
        end = formatted.index(FOOT, line + 1)
        yield unescape(formatted[at + len(HEAD):line]), unescape(formatted[line + 1:end])
        at = end + len(FOOT)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest of each conversation, read back from ``format_chats`` in the order in which that returns it.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = T.StructType([formatted.schema["conv_id"], T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
                           T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
                           T.StructField("formatted_chars", T.LongType())])

    def chars(data: bytes) -> int:
        return int((np.frombuffer(data, np.uint8) & 0xC0 != 0x80).sum())

    def run(batches):
        conv, state, kind = None, None, None

        def row():
            n, turns, loss_chars, loss, size = state
            return dict(zip(names, (conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), size)))

        for batch in batches:
            kind, made = batch.schema.field("conv_id"), []
            for c, part, body, spans in zip(batch.column("conv_id").to_pylist(), batch.column("part").to_pylist(),
                                            batch.column("formatted"), batch.column("loss").to_pylist()):
                if part == 0:
                    if state:
                        made.append(row())
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                body = body.as_py()
                for role, text in parse(body):
                    state[0] += 1
                    state[1].update(b"%b\n%b\n" % (role, text))
                for s in spans:
                    text = unescape(body[s["first"]:s["behind"]])
                    state[2] += chars(text)
                    state[3].update(text)
                state[4] += chars(body)
            if made:
                yield pa.RecordBatch.from_pylist(made, schema=fields(kind))
        if state:
            yield pa.RecordBatch.from_pylist([row()], schema=fields(kind))

    def fields(kind):
        return pa.schema([kind, ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                          ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    return formatted.select("conv_id", "part", "formatted", "loss").transform(in_batches, run, schema)
