"""Helpers shared by the operators of this subpackage.

Word and gram hashing is columnar: a batch of texts becomes one byte array, and every
step is a numpy pass over at most ``CHUNK`` bytes, so memory does not follow the length
of the longest text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

CHUNK = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Texts are long: where the session has Spark's default of 10,000 rows an Arrow batch,
    fewer, which bounds what a task and its Python worker hold at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(rows))


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, different for every call."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder as Parquet and read them back.
    A lost executor then costs its running tasks only."""
    spark, path = df.sparkSession, run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_unique(rows: DataFrame, table: DataFrame, keys: list[str], share: float = 1e-4) -> DataFrame:
    """Left join of ``rows`` to a table with one row a key, where any key may hold a third of
    the rows. Keys with at least ``share`` of all rows are at most 1 / ``share`` (10,000): their
    part of the table is broadcast, so their rows stay where they are; the others are joined
    by an exchange. Both are best read from written tables, as they are read twice."""
    times = rows.groupBy(*keys).count()
    total = times.agg(F.coalesce(F.sum("count"), F.lit(0))).scalar()
    hot = written(times.where(F.col("count") >= F.greatest(F.lit(64), F.ceil(total * F.lit(share)))).select(*keys), "hot-keys")
    mark = fresh([*rows.columns, *table.columns], "is_hot")
    few = F.broadcast(hot.withColumn(mark, F.lit(True)))
    values = F.broadcast(written(table.join(F.broadcast(hot), keys, "left_semi"), "hot-values"))
    marked = rows.join(few, keys, "left")
    warm = marked.where(F.col(mark)).drop(mark).join(values, keys, "left")
    cold = marked.where(F.col(mark).isNull()).drop(mark).join(table, keys, "left")
    return warm.unionByName(cold)


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id as text is divisible by 5; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def trainable(doc_id: str = "doc_id") -> Column:
    """Rows that labels may be learnt from: the id is known and its remainder is not 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 != 0, F.lit(False))


def unit_hash(*cols: Column, seed: int = 0) -> Column:
    """Uniform double in [0, 1) from the values of ``cols``."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 52)) / F.lit(float(1 << 52))


def fresh(df_columns: Iterable[str], name: str) -> str:
    """``name``, or a variant that no input column has (names compare without case)."""
    taken = {c.lower() for c in df_columns}
    while name.lower() in taken:
        name += "_"
    return name


# -- byte arrays -------------------------------------------------------------------------


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mix."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def class_table(is_word) -> np.ndarray:
    """Boolean table of 256: which byte values belong to words."""
    return np.array([bool(is_word(b)) for b in range(256)])


def word_spans(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the maximal runs of word bytes."""
    inside = np.concatenate(([False], table[data], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def _pieces(data: bytes, table: np.ndarray) -> Iterator[bytes]:
    """``data`` in pieces of about CHUNK bytes, cut where no word is split."""
    at, n = 0, len(data)
    view = np.frombuffer(data, np.uint8)
    while at < n:
        end = min(n, at + CHUNK)
        while end < n and table[view[end]]:
            step = np.flatnonzero(~table[view[end : end + CHUNK]])
            end = end + int(step[0]) if step.size else min(n, end + CHUNK)
        yield data[at:end]
        at = end


def _hash_piece(data: np.ndarray, table: np.ndarray, most: int = 0) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = word_spans(data, table)
    if most:
        ends = np.minimum(ends, starts + most)
    if not starts.size:
        return starts, np.empty(0, np.uint64)
    lengths = ends - starts
    powers = np.ones(int(lengths.max()), np.uint64)
    powers[1:] = _BASE
    powers = np.multiply.accumulate(powers)
    flat = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    body = data[np.repeat(starts, lengths) + flat].astype(np.uint64) + np.uint64(1)
    sums = np.add.reduceat(body * powers[flat], np.cumsum(lengths) - lengths)
    return starts, mix(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hashed_words(texts: list[bytes], table: np.ndarray, most: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """(index, 64-bit word hashes in text order) for every text; whole texts are read.
    Short texts share a numpy pass, long ones take several. With ``most``, only that many
    first bytes of each word count."""
    batch: list[int] = []
    size = 0

    def flush(ids: list[int]) -> Iterator[tuple[int, np.ndarray]]:
        joined = np.frombuffer(b"\n".join(texts[i] for i in ids) + b"\n", np.uint8)
        bounds = np.cumsum([len(texts[i]) + 1 for i in ids])
        starts, hashes = _hash_piece(joined, table, most)
        cut = np.searchsorted(starts, bounds)
        at = 0
        for i, c in zip(ids, cut):
            yield i, hashes[at:c]
            at = c

    for i, t in enumerate(texts):
        if len(t) > CHUNK:
            found = [_hash_piece(np.frombuffer(p, np.uint8), table, most)[1] for p in _pieces(t, table)]
            yield i, np.concatenate(found) if found else np.empty(0, np.uint64)
            continue
        batch.append(i)
        size += len(t)
        if size >= CHUNK:
            yield from flush(batch)
            batch, size = [], 0
    if batch:
        yield from flush(batch)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of all ``k``-word shingles; with fewer words the whole
    sequence is the one shingle; without words the set is empty."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    width = min(k, n)
    h = np.full(n - width + 1, np.uint64(width))
    for j in range(width):
        h = mix(h * np.uint64(0xFF51AFD7ED558CCD) + words[j : n - width + 1 + j])
    return np.unique(h)


def byte_grams(texts: list[bytes], orders: tuple[int, ...], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text index, gram id below 2**bits) of all byte n-grams of the given orders, a chunk
    at a time. Grams never cross texts; a text longer than CHUNK comes in slices that look
    ahead, so each gram is counted once."""
    ahead = max(orders) - 1
    parts: list[bytes] = []
    owners: list[tuple[int, int, int]] = []  # text, bytes that start grams, bytes in all
    size = 0

    def flush() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
        text = np.repeat([o[0] for o in owners], [o[2] for o in owners])
        total = np.array([o[2] for o in owners])
        end = np.repeat(np.cumsum(total), total)
        main = np.repeat(np.cumsum(total) - total + [o[1] for o in owners], total)
        at = np.arange(len(data))
        for order in orders:
            ok = (at < main) & (at + order <= end)
            first = at[ok]
            h = np.full(len(first), np.uint64(order))
            for j in range(order):
                h = h * _BASE + data[first + j]
            yield text[ok], (mix(h) >> np.uint64(64 - bits)).astype(np.int64)

    for i, t in enumerate(texts):
        for s in range(0, len(t), CHUNK):
            piece = t[s : s + CHUNK + ahead]
            parts.append(piece)
            owners.append((i, min(CHUNK, len(t) - s), len(piece)))
            size += len(piece)
            if size >= CHUNK:
                yield from flush()
                parts, owners, size = [], [], 0
    if parts:
        yield from flush()


def grouped_by_bytes(texts: list[bytes], most_texts: int, most_bytes: int = 4 * CHUNK) -> Iterator[slice]:
    """Slices of ``texts`` with few enough texts and bytes for one dense numpy step."""
    at = size = 0
    for i, t in enumerate(texts):
        if i > at and (i - at >= most_texts or size + len(t) > most_bytes):
            yield slice(at, i)
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield slice(at, len(texts))
