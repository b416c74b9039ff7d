"""Words, shingles and hashes of whole texts, for use inside Arrow map tasks.

Everywhere in this subpackage a word is a maximal run of characters other
than ``U+0020`` and ``U+0009..U+000D``; a null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: the word pattern, in the syntax Java, RE2 and Python share
WORD_RE = r"[^\x20\x09-\x0D]+"
SHINGLE = 5
CHUNK_BYTES = 4 << 20

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder from the session's setting; package on the workers' path."""
    from ..session import ensure_checkpoint_dir, ship_package
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: names of the row key that results are joined back on
K1, K2 = "_row_k1", "_row_k2"


def key_columns(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Key of a row: two hashes of its id and text, never null.

    Rows with equal id and text share it and are judged alike."""
    i, t = F.col(doc_id).cast("bigint"), F.col(text).cast("string")
    return [F.xxhash64(i, t).alias(K1), F.hash(t, i).alias(K2)]


def keyed(docs: DataFrame) -> DataFrame:
    """``(K1, K2, doc_id, text)`` of a documents table."""
    return docs.select(*key_columns(), F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def spot(docs: DataFrame, name: str) -> int:
    """Position of a column, names compared as Spark compares them."""
    return [c.lower() for c in docs.columns].index(name.lower())


def positional(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with its columns named by position, which cannot clash with a
    name an operator adds, and those names."""
    names = [f"_at{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), names


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, or with underscores added until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose key is in ``dropped``; columns unchanged."""
    plain, names = positional(docs)
    k = key_columns(names[spot(docs, "doc_id")], names[spot(docs, "text")])
    return (plain.withColumns({K1: k[0], K2: k[1]}).join(dropped.select(K1, K2).distinct(), [K1, K2], "left_anti")
            .select(*names).toDF(*docs.columns))


def words_of(col: Column) -> Column:
    """Words of a text column as an array (null or blank text: empty array)."""
    body = F.btrim(F.coalesce(col, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"[\x20\x09-\x0D]+"))


def mix(x: np.ndarray) -> np.ndarray:
    """Invertible 64-bit finaliser (vectorised)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M2
    x ^= x >> np.uint64(27)
    x *= _M3
    x ^= x >> np.uint64(31)
    return x


def chunks(arr: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; one long text is a range of its own."""
    sizes = pc.fill_null(pc.binary_length(arr), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, s in enumerate(sizes):
        if total and total + s > limit:
            yield start, i
            start, total = i, 0
        total += int(s)
    if start < len(arr):
        yield start, len(arr)


def plain(arr) -> pa.Array:
    """One contiguous array with 64-bit offsets, nulls as empty texts."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    return pc.fill_null(arr.cast(pa.large_string()), "")


def split_words(arr: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Flat words of all texts and the offsets of each text (no empty words)."""
    lists = pc.ascii_split_whitespace(arr)
    flat = lists.flatten()
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    keep = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0, bool)
    if not keep.all():
        run = np.concatenate([[0], np.cumsum(keep)])
        bounds = run[bounds]
        flat = flat.filter(pa.array(keep))
    return flat, bounds


def hash_words(flat: pa.Array) -> np.ndarray:
    """64-bit hash of every word, eight bytes at a time over all words at once."""
    n = len(flat)
    if not n:
        return np.zeros(0, np.uint64)
    flat = flat.cast(pa.large_string())
    _, offs, data = flat.buffers()
    bounds = np.frombuffer(offs, np.int64)[flat.offset:flat.offset + n + 1]
    start, length = bounds[:-1] - bounds[0], np.diff(bounds)
    size = int(bounds[-1] - bounds[0])
    raw = np.zeros(size + 16, np.uint64)
    if size:
        raw[:size] = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]
    # raw[i] becomes the eight bytes that start at i
    for step in (1, 2, 4):
        raw[:-step] |= raw[step:] << np.uint64(8 * step)
    h = mix(length.astype(np.uint64) * _M1 + _M2)
    live, at, left = np.arange(n), start, length
    rounds = 0
    while len(live) and rounds < 32:
        block = raw[at]
        part = np.minimum(left, 8).astype(np.uint64)
        block &= np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * np.maximum(part, 1))
        block[left <= 0] = 0
        h[live] = mix(h[live] ^ (block * _M1 + _M3))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
        rounds += 1
    for i in live:      # words of more than 256 bytes
        h[i] = xxhash.xxh3_64_intdigest(flat[int(i)].as_py(), seed=int(h[i]) & 0xFFFFFFFF)
    return h


def hashed_words(arr: pa.Array, piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts and the offsets of each text.

    Works through pieces of about ``piece`` bytes, so the scratch arrays stay
    in the processor's cache and memory is eight bytes a word."""
    parts, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, b in chunks(arr, piece):
        flat, bounds = split_words(arr.slice(a, b - a))
        parts.append(hash_words(flat))
        counts.append(np.diff(bounds))
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word shingles of each text, in order, with offsets.

    A text of 1 to ``k - 1`` words has one shingle, its whole sequence; a
    text without words has none."""
    n = np.diff(bounds)
    counts = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(counts)])
    total = int(out_bounds[-1])
    if not total:
        return np.zeros(0, np.uint64), out_bounds
    # first word of every shingle
    starts = np.repeat(bounds[:-1] - out_bounds[:-1], counts) + np.arange(total)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    h = np.zeros(total, np.uint64)
    short = np.repeat(n < k, counts)
    length = np.minimum(np.repeat(n, counts), k)
    for j in range(k):
        nxt = (h ^ mix(padded[starts + j] + np.uint64((j + 1) * int(_M1) & 0xFFFFFFFFFFFFFFFF))) * _M3 + _M1
        h = np.where(short & (j >= length), h, nxt) if short.any() else nxt
    h = mix(h)
    h[short] = mix(h[short] + length[short].astype(np.uint64))
    return h, out_bounds


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def rows(batch_iter: Iterator[pa.RecordBatch], text: str = "text",
         limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Sub-batches of ``limit`` bytes of text or so, with their text column made plain.

    Arrow keeps what it has freed; a worker outlives its task, so that goes back when the rows end."""
    for batch in batch_iter:
        arr = plain(batch.column(batch.schema.get_field_index(text)))
        for a, b in chunks(arr, limit):
            yield batch.slice(a, b - a), arr.slice(a, b - a)
    pa.default_memory_pool().release_unused()


def distinct_per_text(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct hashes in ascending order, their text's index, and offsets."""
    n = len(bounds) - 1
    which = np.repeat(np.arange(n, dtype=np.uint16 if n < 65536 else np.int64), np.diff(bounds))
    order = np.argsort(h)
    order = order[np.argsort(which[order], kind="stable")]
    h, which = h[order], which[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (which[1:] != which[:-1])
    h, which = h[keep], which[keep]
    return h, which, np.concatenate([[0], np.cumsum(np.bincount(which, minlength=n))]).astype(np.int64)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each text's slice (0 for an empty one), wrapping for integers."""
    run = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return run[bounds[1:]] - run[bounds[:-1]]


def mapped_bytes(arr: pa.Array, table: np.ndarray) -> pa.Array:
    """Texts with every byte replaced by ``table[byte]`` (ASCII to ASCII only)."""
    arr = arr.cast(pa.large_string())
    _, offs, data = arr.buffers()
    bounds = np.frombuffer(offs, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return pa.LargeStringArray.from_buffers(len(arr), pa.py_buffer(bounds - bounds[0]), pa.py_buffer(table[raw]))
