"""Operator 2: benchmark decontamination by size-partitioned MinHash containment.

Words: ASCII letters in lower case, ASCII punctuation separates words.  An
item's and a document's sets hold their distinct 5-word shingles.  A document
is contaminated by an item when it holds at least ``threshold`` per cent of
the item's shingles.

* **Size partitions.**  Items are partitioned by their number of shingle
  positions: class ``c`` holds items of up to ``BLOCK * 2**c``.  For each class
  present a document is seen as windows of twice that length, half
  overlapping, so an occurrence of an item lies in one window and, whatever
  the document's length, the Jaccard similarity of the two stays above a bound
  (0.17 at a containment of 0.75).
* **MinHash.**  ``HASHES`` minima per item and per window; one equal minimum
  makes a candidate.  At the bound, a pair is missed with a probability below
  1e-5.
* **Small items.**  An item of fewer distinct shingles than half its class's
  size would fall below the bound.  It is looked up by shingle hashes instead: of
  its ``n`` shingles a document must hold ``m``, so it holds one of the
  ``n - m + 1`` with the smallest hashes.  No such pair is missed.
* **Exact containment.**  A candidate's shingles are compared as text.

A window without any item shingle cannot agree on a minimum.  A bitmap of
2 MB (whatever the benchmark's size) with the items' shingles therefore
leaves most windows alone.  The items' minima are broadcast while they number
at most ``broadcast_keys`` (8 + 4 bytes each); beyond, the windows' minima go
to a Spark join.  Both ways give the same candidates.

Edge cases: a null or wordless text or item matches nothing; 1 to 4 words are
one shingle; repeated rows give repeated results; repeated item ids are
separate items that share an id; null ids are kept; empty tables give an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .shared import bitmap, in_bitmap, written

THRESHOLD = 75
BLOCK = 16
HASHES = 64
BROADCAST_KEYS = 2_000_000

_PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[65:91] += 32
_TABLE[[ord(c) for c in _PUNCT]] = 32
_EXACT = np.uint64(0xD1B54A32D192ED03)
_FNS = T.mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _shingles(arr: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    norm = T.mapped_bytes(arr, _TABLE)
    h, wb = T.hashed_words(norm)
    s, sb = T.shingle_hashes(h, wb)
    return norm, wb, s, sb


def _shingle_texts(norm: str, places: np.ndarray) -> list[str]:
    words = norm.encode().split()
    return sorted({b" ".join(words[p:p + T.SHINGLE]).decode() for p in places.tolist()})


def _class_of(n: int) -> int:
    return max(0, (-(-n // BLOCK) - 1).bit_length())


def _keys(minima: np.ndarray, cls: int) -> np.ndarray:
    """One key per hash function for a matrix (windows x HASHES) of minima."""
    return T.mix(minima ^ _FNS[None, :]) ^ T.mix(np.uint64([cls + 1]))[0]


def _exact_keys(s: np.ndarray) -> np.ndarray:
    """Keys by which small items are looked up: one per shingle hash."""
    return T.mix(s + _EXACT)


def _minima(s: np.ndarray) -> np.ndarray:
    """The HASHES minima of one set of shingle hashes."""
    return T.mix(s[:, None] ^ _FNS[None, :]).min(axis=0)


def item_table(benchmark: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Written ``(item, item_id, cls, n, shingles, hashes, keys)`` of the items with words;
    ``cls`` is null for small items."""
    schema = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("cls", pa.int32()), ("n", pa.int64()),
                        ("shingles", pa.list_(pa.string())), ("hashes", pa.list_(pa.int64())),
                        ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, arr in T.rows(batches):
            norm, _, s, sb = _shingles(arr)
            out = []
            for i, text in enumerate(norm.to_pylist()):
                own = s[sb[i]:sb[i + 1]]
                if not len(own):
                    continue
                cls = _class_of(len(own))
                names = _shingle_texts(text, np.arange(len(own)))
                kinds = np.unique(own)
                if len(kinds) < (BLOCK << cls) // 2:
                    cls, least = None, max(1, -(-len(kinds) * threshold // 100))
                    keys = _exact_keys(kinds[:len(kinds) - least + 1])
                else:
                    keys = _keys(_minima(own)[None, :], cls)[0]
                out.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), cls, len(names), names,
                            T.signed(kinds).tolist(), T.signed(keys).tolist()))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)

    rows = benchmark.select(F.xxhash64("item_id", "text").alias("item"), F.col("item_id").cast("bigint").alias("item_id"),
                            F.col("text").cast("string").alias("text"))
    return written(rows.mapInArrow(run, "item bigint, item_id bigint, cls int, n bigint, shingles array<string>, "
                                   "hashes array<bigint>, keys array<bigint>"), "items")


def _windows(s: np.ndarray, hit: np.ndarray, cls: int) -> np.ndarray:
    """Keys of the class's windows over one document that hold a hit."""
    size = BLOCK << cls
    first = np.unique(hit // size)
    starts = np.unique(np.concatenate([first, first - 1]))
    starts = starts[starts >= 0]
    return np.concatenate([_keys(_minima(s[a * size:(a + 2) * size])[None, :], cls)[0] for a in starts.tolist()])


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: int = THRESHOLD,
                 broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``(doc_id, item_id, n_item_shingles, n_shared)`` and the row key, one row
    for each document row and item of which it holds enough."""
    spark = docs.sparkSession
    T.prepare(spark)
    items = item_table(benchmark, threshold)
    classes = [r["cls"] for r in items.select("cls").distinct().orderBy("cls").collect()]
    small, classes = None in classes, [c for c in classes if c is not None]
    bits = spark.sparkContext.broadcast(bitmap(items.select(F.explode("hashes").alias("h")), "h"))
    item_keys = items.select("item", F.explode(F.array_distinct("keys")).alias("key")).distinct()
    table = None
    if item_keys.count() <= broadcast_keys:
        got = item_keys.orderBy("key", "item").toPandas()
        table = (got["key"].to_numpy(np.int64), got["item"].to_numpy(np.int64))
    table_b = spark.sparkContext.broadcast(table)
    schema = pa.schema([(T.K1, pa.int64()), (T.K2, pa.int32()), ("doc_id", pa.int64()),
                        ("found", pa.list_(pa.int64())), ("hits", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table_b.value
        for batch, arr in T.rows(batches):
            norm, _, s, sb = _shingles(arr)
            hit = np.flatnonzero(in_bitmap(bits.value, s))
            if not len(hit):
                continue
            doc = np.searchsorted(sb, hit, side="right") - 1
            out = []
            for i in np.unique(doc).tolist():
                at = hit[doc == i] - sb[i]
                own = s[sb[i]:sb[i + 1]]
                found = np.unique(T.signed(np.concatenate(
                    [_windows(own, at, c) for c in classes] + ([_exact_keys(own[at])] if small else []))))
                if known is not None:
                    lo, hi = np.searchsorted(known[0], found), np.searchsorted(known[0], found, side="right")
                    found = np.unique(np.concatenate([known[1][a:b] for a, b in zip(lo, hi)] or [known[1][:0]]))
                if len(found):
                    out.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), batch.column(2)[i].as_py(),
                                found.tolist(), _shingle_texts(norm[i].as_py(), at)))
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)

    found = T.keyed(docs).mapInArrow(run, f"{T.K1} bigint, {T.K2} int, doc_id bigint, found array<bigint>, hits array<string>")
    if table is None:
        by_key = found.select(T.K1, T.K2, "doc_id", "hits", F.explode("found").alias("key"))
        pairs = (by_key.select(T.K1, T.K2, "key").distinct().join(item_keys, "key").select(T.K1, T.K2, "item").distinct()
                 .join(found.select(T.K1, T.K2, "doc_id", "hits"), [T.K1, T.K2]))
    else:
        pairs = found.select(T.K1, T.K2, "doc_id", "hits", F.explode("found").alias("item"))
    shared = F.size(F.array_intersect("hits", "shingles"))
    return (pairs.join(items.select("item", "item_id", "n", "shingles"), "item")
            .withColumn("n_shared", shared.cast("bigint"))
            .filter(F.col("n_shared") * 100 >= F.col("n") * threshold)
            .select(T.K1, T.K2, "doc_id", "item_id", F.col("n").alias("n_item_shingles"), "n_shared"))
