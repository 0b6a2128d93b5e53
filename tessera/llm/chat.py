"""Chat formatting by columnar byte assembly.

Every turn becomes ``<|im_start|>`` role newline text ``<|im_end|>`` newline. Control
strings inside roles and texts are escaped: ``<``, any number of backslashes and ``|``
gain one more backslash, so no text can hold ``<|`` and the way back is exact.

A batch is assembled with numpy: the lengths of all segments (header, role, text, end),
their cumulative offsets, and one scatter index move every byte into one preallocated
buffer, which becomes the Arrow column as it is. The loss mask is the byte span of each
assistant text.

Turns are brought together by one exchange on conv_id and a sort inside partitions, and
are then streamed: a conversation comes out as chunks of whole turns (``chunk`` counts
from 0), so one with a third of all rows is read and written in bounded memory by one task
(its digest is a chain over its turns, so they cannot be dealt to several).

Defined cases: null role or text is empty; turns are ordered by turn (nulls first), then
role and text, so repeated turns stay and ties have one order; a null conv_id is a
conversation of its own; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches

START, MIDDLE, END = b"<|im_start|>", b"\n", b"<|im_end|>\n"
ASSISTANT = "assistant"
CHUNK_BYTES = 1 << 22
FORMATTED = "conv_id long, chunk long, formatted string, loss_start array<long>, loss_end array<long>, n_turns long"
READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START.decode()) + r"(.*?)\n(.*?)" + re.escape(END.decode()), re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role on one line: its line ends and backslashes are escaped, then control strings."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text), flags=re.S)


def turns_of(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of every turn of a formatted text."""
    at = 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("bytes between turns")
        at = m.end()
        yield unescape_role(m[1]), unescape(m[2])
    if at != len(formatted):
        raise ValueError("bytes after the last turn")


def assemble(segments: list[pa.Array], fixed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Interleave: fixed[0], segments[0], fixed[1], segments[1], ..., fixed[-1] for each row.
    Returns the bytes, the rows' offsets, and the offsets of every part (rows x parts)."""
    n, parts = len(segments[0]), len(segments) + len(fixed)
    lengths = np.empty((n, parts), np.int64)
    sources = []
    for j, f in enumerate(fixed):
        lengths[:, 2 * j] = len(f)
    for j, s in enumerate(segments):
        offsets = np.frombuffer(s.buffers()[1], np.int64, n + 1, 8 * s.offset)
        data = np.frombuffer(s.buffers()[2], np.uint8) if s.buffers()[2] is not None else np.empty(0, np.uint8)
        sources.append((data, offsets))
        lengths[:, 2 * j + 1] = np.diff(offsets)
    ends = np.cumsum(lengths.ravel()).reshape(n, parts)
    begins = ends - lengths
    out = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for j, f in enumerate(fixed):
        out[begins[:, 2 * j, None] + np.arange(len(f))] = np.frombuffer(f, np.uint8)
    for j, (data, offsets) in enumerate(sources):
        size = lengths[:, 2 * j + 1]
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(begins[:, 2 * j + 1], size) + step] = data[offsets[0] : offsets[-1]]
    return out, np.append(begins[:, 0], ends[-1:, -1]) if n else np.zeros(1, np.int64), begins


def _escaped(values: list[str | None], how=escape) -> pa.Array:
    return pa.array([how(v or "") for v in values], pa.large_string())


def format_conversations(turns: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunks of formatted conversations, in order within each partition; loss spans are
    byte offsets into the chunk's UTF-8."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, chunk, started = None, 0, False
        for batch in batches:
            roles, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            ids = batch.column(0).to_pylist()
            at = 0
            while at < len(ids):
                # A slice of turns with bounded bytes; a chunk ends with it or with its conversation.
                size, stop = 0, at
                while stop < len(ids) and (stop == at or size < chunk_bytes):
                    size += 4 * len(texts[stop] or "") + 4 * len(roles[stop] or "")
                    stop += 1
                kinds = roles[at:stop]
                body, row, begins = assemble([_escaped(kinds, escape_role), _escaped(texts[at:stop])], [START, MIDDLE, END])
                own = ids[at:stop]
                cuts = [0] + [i for i in range(1, len(own)) if own[i] != own[i - 1]] + [len(own)]
                numbers, first, last = [], [], []
                for a, b in zip(cuts, cuts[1:]):
                    chunk = chunk + 1 if started and own[a] == current else 0
                    current, started = own[a], True
                    numbers.append(chunk)
                    loss = [i for i in range(a, b) if kinds[i] == ASSISTANT]
                    first.append([int(begins[i, 3] - row[a]) for i in loss])
                    last.append([int(begins[i, 4] - row[a]) for i in loss])
                offsets = row[cuts].astype(np.int32)
                formatted = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(offsets), pa.py_buffer(body))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([own[a] for a in cuts[:-1]], pa.int64()),
                        pa.array(numbers, pa.int64()),
                        formatted,
                        pa.array(first, pa.list_(pa.int64())),
                        pa.array(last, pa.list_(pa.int64())),
                        pa.array(np.diff(cuts), pa.int64()),
                    ],
                    ["conv_id", "chunk", "formatted", "loss_start", "loss_end", "n_turns"],
                )
                at = stop

    bounded_batches(turns.sparkSession)
    rows = turns.select(F.col("conv_id").cast("long"), "turn", "role", "text")
    placed = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return placed.select("conv_id", "role", "text").mapInArrow(build, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row a conversation, from the formatted chunks alone (chunks of a conversation
    must follow each other, as ``format_conversations`` leaves them)."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list = []

        def done() -> pa.RecordBatch:
            conv, n, turns, chars, loss, total = state
            return pa.RecordBatch.from_pylist(
                [{"conv_id": conv, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars, "loss_sha256": loss.hexdigest(), "formatted_chars": total}],
                schema=pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]),
            )

        for batch in batches:
            ended = []
            for row in batch.to_pylist():
                if row["chunk"] == 0:
                    if state:
                        ended.append(done())
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text, raw = row["formatted"], row["formatted"].encode()
                state[5] += len(text)
                for role, said in turns_of(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for a, b in zip(row["loss_start"], row["loss_end"]):
                    spoken = unescape(raw[a:b].decode())
                    state[3] += len(spoken)
                    state[4].update(spoken.encode())
            if ended:
                yield pa.Table.from_batches(ended).combine_chunks().to_batches()[0]
        if state:
            yield done()

    return formatted.mapInArrow(parse, READ)
