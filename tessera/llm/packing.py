"""Best-fit packing of documents into sequences of at most ``capacity`` tokens.

A document is its token ids and one closing id. Longer ones are cut into pieces of
``capacity`` tokens, of which the first may be shorter; all others stay whole.

Which lengths share a sequence depends only on how many pieces there are of each length, at
most ``capacity`` numbers. That histogram is packed by bin completion: take the largest
length that is left, enumerate the undominated fillings around it (no part of a filling can
be exchanged for a longer piece that is left and still fits), least waste first, and branch.
The best-fit packing is the first incumbent; a branch ends where the sequences used and the
bound of what is left (tokens, and the waste that large pieces force, after Martello and
Toth) reach the incumbent. A filling is used as often as the counts allow, once a branch
when at most ``exact`` pieces are left. The search ends when the incumbent meets the bound,
or after ``nodes`` branches; every piece is packed either way.

Pieces then take their places by rank: the pieces of a length are numbered over all tasks
(numbers within a task while it encodes, moved by the counts of the tasks before it), and
the plan gives each number of a length its sequence and offset. The plan has a few entries a
length, whatever the number of documents, and goes to the tasks as one array; no task or
driver holds documents of others, and a length that a third of all pieces have is spread
over all tasks.

Defined cases: null and empty texts are the closing id alone; repeated rows and rows
without an id are packed as rows of their own; equal lengths take places in row order; an
empty table gives no rows. Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, grouped_by_bytes, written

Counts = dict[int, int]
Filling = dict[int, int]
Plan = list[tuple[int, Filling]]  # how often, and lengths with their numbers


# -- tokens ----------------------------------------------------------------------------

#: Fixed value: the split pattern of the byte-level pre-tokenizer.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters on which the two libraries' Unicode tables could differ begin here.
_FAR = re.compile("[^\x00-ɏ]")


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Byte strings and ids of a plain byte-level BPE vocabulary whose ids follow its merges;
    None for any other."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not model.get("byte_fallback") and not model.get("ignore_merges") and not spec.get("normalizer")
    plain = plain and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
    plain = plain and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    if not plain or not all(t["special"] and not (t["single_word"] or t["lstrip"] or t["rstrip"]) for t in spec["added_tokens"]):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    added = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"][a + b] for a, b in merges]
    return ranks if ids == sorted(ids) and len(ids) == len(ranks) - 256 else None


def encoder(spec_text: str) -> Callable[[list[str]], list[np.ndarray]]:
    """Token ids of texts under a tokenizers file, without special tokens added. A plain
    byte-level BPE is encoded by tiktoken from the same vocabulary, which gives the same ids
    several times faster; texts with characters beyond U+024F, and other files, are left to
    tokenizers."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    spec = json.loads(spec_text)
    tok = Tokenizer.from_str(spec_text)
    tok.no_truncation()
    tok.no_padding()
    ranks = _ranks(spec)
    fast = None
    if ranks is not None:
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)

    def encode(texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        slow = []
        for i, t in enumerate(texts):
            if fast is None or _FAR.search(t):
                slow.append(i)
            else:
                out[i] = fast.encode_to_numpy(t, allowed_special="all", disallowed_special=())
        for i, e in zip(slow, tok.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False)):
            out[i] = np.array(e.ids, np.uint32)
        return out

    return encode


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int, closing: int = 0, text: str = "text", doc_id: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, the task that cut it and
    its number among the task's pieces of that length; with ``keep_ids`` also its ids."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    bounded_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int32()), ("number", pa.int64())]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(spec), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([closing], np.uint32)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in grouped_by_bytes(texts, 512, 1 << 20):
                owner, rows, ids = [], [], []
                for i, found in zip(range(part.start, part.stop), encode(texts[part])):
                    found = np.concatenate((found, end)).astype("<u4")
                    first = len(found) if len(found) <= capacity else (len(found) - 1) % capacity + 1
                    bounds = [0, *range(first, len(found) + 1, capacity)]
                    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                        owner.append(i)
                        rows.append((k, a, b - a, zlib.crc32(found[a:b].tobytes()), task, int(seen[b - a])))
                        seen[b - a] += 1
                        if keep_ids:
                            ids.append(found[a:b].astype(np.int32))
                columns = [batch.column(0).take(pa.array(owner, pa.int64())), *(pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields))]
                names = ["doc_id", *(n for n, _ in fields)]
                if keep_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    read = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, number long" + ", ids array<int>" * keep_ids
    return written(read.mapInArrow(work, schema), "pieces")


# -- bin completion ----------------------------------------------------------------------


def lower_bound(counts: Counts, capacity: int) -> int:
    """Sequences that the counts need at least: for each threshold t up to half the capacity,
    pieces over capacity - t leave waste that no piece of t or more can use."""
    have = np.zeros(capacity + 2, np.int64)
    for size, n in counts.items():
        have[size] = n
    number, tokens = np.cumsum(have), np.cumsum(have * np.arange(capacity + 2))
    t = np.arange(capacity // 2 + 1)
    large = number[capacity] - number[capacity - t]
    middle = number[capacity - t] - number[capacity // 2]
    below = np.where(t > 0, tokens[np.maximum(t - 1, 0)], 0)
    rest = tokens[capacity // 2] - below - (middle * capacity - (tokens[capacity - t] - tokens[capacity // 2]))
    return int((large + middle + np.maximum(0, -(-rest // capacity))).max())


def best_fit(counts: Counts, capacity: int) -> Plan:
    """Best-fit decreasing over counts: sequences with one content are one entry."""
    open_: list[tuple[int, int, Filling]] = []  # room, how many, content
    for size in sorted(counts, reverse=True):
        left, after = counts[size], []
        for room, many, content in sorted(open_, key=lambda e: e[0]):
            each = room // size
            if not each or not left:
                after.append((room, many, content))
                continue
            full = min(many, left // each)
            left -= full * each
            if full:
                after.append((room - each * size, full, content | {size: each}))
            many -= full
            if many and left:
                after.append((room - left * size, 1, content | {size: left}))
                left, many = 0, many - 1
            if many:
                after.append((room, many, content))
        each = capacity // size
        if left // each:
            after.append((capacity - each * size, left // each, {size: each}))
        if left % each:
            after.append((capacity - left % each * size, 1, {size: left % each}))
        open_ = after
    return [(many, content) for _, many, content in open_]


def _reach(sizes: list[int], counts: Counts, room: int) -> list[int]:
    """For each i, the sums up to ``room`` of pieces of sizes[i:], as bits."""
    mask, reach = (1 << (room + 1)) - 1, [1]
    for size in reversed(sizes):
        bits, left, step = reach[-1], min(counts[size], room // size), 1
        while left:
            step = min(step, left)
            bits |= bits << (size * step) & mask
            left -= step
            step *= 2
        reach.append(bits)
    return reach[::-1]


def _dominated(filling: Filling, spare: int, waste: int) -> bool:
    """Whether some pieces of the filling can give way to one longer piece of the sizes in
    the bit set ``spare``, or several to one as long."""
    one = several = 0  # sums of one piece, of several
    for size, n in filling.items():
        one |= 1 << size
        for _ in range(n):
            several |= ((one & ~(1 << size)) | several) << size
        if n > 1:
            several |= 1 << 2 * size
    if spare & several:
        return True
    sums = one | several
    return any(spare & (sums << d) for d in range(1, waste + 1))


def fillings(counts: Counts, room: int, width: int) -> Iterator[Filling]:
    """Up to ``width`` undominated fillings of the room, least waste first, then the longest
    pieces first."""
    sizes = sorted((s for s, n in counts.items() if n and s <= room), reverse=True)
    reach, given, tried = _reach(sizes, counts, room), 0, 0
    if not sizes:
        yield {}
        return
    for waste in range(room + 1):
        if not reach[0] >> (room - waste) & 1:
            continue
        stack: list[tuple[int, int, tuple[tuple[int, int], ...]]] = [(0, room - waste, ())]
        while stack:
            i, left, chosen = stack.pop()
            if not left:
                filling = dict(chosen)
                spare = sum(1 << s for s in sizes if counts[s] > filling.get(s, 0))
                tried += 1
                if not _dominated(filling, spare, waste) and not spare & ((1 << (waste + 1)) - 1):
                    given += 1
                    yield filling
                if given >= width or tried >= 8 * width:
                    if not given:
                        yield filling
                    return
                continue
            while i < len(sizes) and sizes[i] > left:
                i += 1
            if i < len(sizes):
                most = min(counts[sizes[i]], left // sizes[i])
                for n in range(most + 1):  # the most pieces are popped first
                    if reach[i + 1] >> (left - n * sizes[i]) & 1:
                        stack.append((i + 1, left - n * sizes[i], (*chosen, (sizes[i], n)) if n else chosen))


def complete(counts: Counts, capacity: int, nodes: int = 8000, width: int = 4, exact: int = 64, fit_every: int = 2048) -> tuple[Plan, int]:
    """The best plan found and the lower bound of its sequences."""
    counts = {s: n for s, n in counts.items() if n}
    least, best = lower_bound(counts, capacity), best_fit(counts, capacity)
    fewest = sum(many for many, _ in best)

    def branches(state: Counts) -> Iterator[tuple[int, Filling]]:
        largest = max(state)
        few = sum(state.values()) <= exact
        for filling in fillings(state | {largest: state[largest] - 1}, capacity - largest, 1 << 30 if few else width):
            content = filling | {largest: filling.get(largest, 0) + 1}
            yield 1 if few else min(state[s] // n for s, n in content.items()), content

    path: list[tuple[int, Filling]] = []
    used, visited, state = 0, 0, counts
    stack: list[tuple[Counts, int, Iterator[tuple[int, Filling]]]] = []
    if fewest > least and counts:
        stack.append((state, 0, branches(state)))
    while stack and visited < nodes and fewest > least:
        state, used, options = stack[-1]
        step = next(options, None)
        del path[len(stack) - 1 :]
        if step is None:
            stack.pop()
            continue
        visited += 1
        many, content = step
        after = {s: n - many * content.get(s, 0) for s, n in state.items() if n > many * content.get(s, 0)}
        path.append(step)
        if used + many + lower_bound(after, capacity) >= fewest:
            continue
        if not after:
            fewest, best = used + many, list(path)
            continue
        if visited % fit_every == 0 or len(after) <= 1 or sum(after.values()) <= exact:
            rest = best_fit(after, capacity)
            total = used + many + sum(m for m, _ in rest)
            if total < fewest:
                fewest, best = total, [*path, *rest]
        stack.append((after, used + many, branches(after)))
    return best, least


# -- places ------------------------------------------------------------------------------


def slots(plan: Plan) -> np.ndarray:
    """Rows (length, first number, pieces a sequence, first sequence, offset), by length and
    number: the pieces of a length from that number on fill those sequences in turn."""
    rows, taken, sequence = [], {}, 0
    for many, content in plan:
        offset = 0
        for size, each in content.items():
            start = taken.get(size, 0)
            rows.append((size, start, each, sequence, offset))
            taken[size] = start + many * each
            offset += size * each
        sequence += many
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(cut: DataFrame, capacity: int, nodes: int = 8000) -> DataFrame:
    """The rows of ``cut`` (see ``pieces``) with their sequence_id and offset, without task and
    number."""
    per_task = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    per_task = written(per_task, "piece-counts")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row a length
    plan, _ = complete(counts, capacity, nodes)
    table = slots(plan)
    keys = (table[:, 0] << 48) | table[:, 1]
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    moved = per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    kept = [c for c in cut.columns if c not in ("task", "number")]
    ranked = cut.join(moved, ["task", "length"]).select(*kept, (F.col("number") + F.col("before")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(keys, (size << 48) | rank, "right") - 1
            _, start, each, sequence, offset = table[at].T
            place = rank - start
            out = b.drop_columns(["rank"])
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(sequence + place // each), pa.array(offset + place % each * size)], [*out.schema.names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.drop("rank").schema.fields)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_pieces and the ids of each sequence, for pieces cut with ``keep_ids``; a
    sequence holds ``capacity`` ids at most."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.size("parts").cast("long").alias("n_pieces"), F.flatten("parts.ids").alias("ids"))
