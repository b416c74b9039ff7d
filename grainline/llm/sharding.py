"""Operator 11: shards of near-equal bytes by histogram sort.

Rows are sorted by a key and cut into ``n_shards`` consecutive ranges of equal
bytes.  A row belongs to the shard its middle byte falls into, counted over all
rows before it, so a boundary is off by half a row at most.

* **Key.**  ``(key column, hash of id and text, position in the staged
  table)``: 24 bytes that order like their values and differ for every row, so
  a key value shared by a third of the rows is cut like any other range.
* **Histogram rounds.**  A round draws some rows strictly inside every open
  bracket as probes (by a hash against a threshold that follows from the exact
  number of rows in the bracket) and then counts, across all partitions, the
  exact bytes and rows below each probe.  Each wanted boundary keeps the pair of
  neighbouring probes around it; it is settled once that pair is adjacent in
  the data, or once its lower end is within ``tolerance`` of a shard's bytes.
  A bracket shrinks by about ``PROBES`` times a round, so the rounds grow with
  the logarithm of the rows.  ``tolerance`` 0 gives the exact boundaries.
* **One exchange.**  Shards are cut once more into pieces of at most about
  ``PIECE_BYTES``, whose boundaries need no refining.  Every row is sent to its
  piece once and sorted there; its slot is the piece's exact count of rows
  before it in the shard plus its position.

The counting passes read 24 bytes a row from a staged table.  The driver keeps
one key per piece (one per ``PIECE_BYTES``) and ``PROBES`` per open boundary.

Edge cases: null text has 0 bytes and checksum 0, so size 16; null keys sort
first; repeated rows are rows of their own; fewer rows than shards leave
shards empty; an empty table gives an empty result; columns not asked for are
ignored, whatever their names.  Reruns over the same files agree.
"""

from __future__ import annotations

import bisect
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from . import text as T
from .shared import place, written

SHARDS = 40
ROW_BYTES = 16                # fixed value: bytes a row counts beside its text
TOLERANCE = 0.0               # share of a shard's bytes by which a boundary may be off
PROBES = 64                   # keys drawn per open bracket and round
PIECE_BYTES = 1 << 30
_WORDS = ("_h1", "_h2", "_h3")
_SIGN = np.uint64(1 << 63)


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    """Keys of a batch as 24-byte strings that compare like (h1, h2, h3)."""
    out = np.empty((batch.num_rows, 3), ">u8")
    for i, name in enumerate(_WORDS):
        col = batch.column(batch.schema.get_field_index(name))
        out[:, i] = col.to_numpy(zero_copy_only=False).view(np.uint64) ^ _SIGN
    return out.view("S24").ravel() if len(out) else np.zeros(0, "S24")


def _fixed(keys: list[bytes]) -> np.ndarray:
    return np.array(keys, "S24")


def _draw(keys: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) per key, the same wherever the key is met."""
    w = np.frombuffer(keys.tobytes(), ">u8").reshape(-1, 3).astype(np.uint64)
    h = T.mix(w[:, 2] + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return (T.mix(h ^ T.mix(w[:, 1] ^ T.mix(w[:, 0]))) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53


def _probes(rows: DataFrame, lows: np.ndarray, highs: np.ndarray, chance: np.ndarray, seed: int) -> pd.DataFrame:
    """``(key, size)`` of the rows drawn strictly inside the brackets ``(low, high)``.

    An empty bytes value as ``high`` stands for the end of all keys."""
    spark = rows.sparkSession
    told = spark.sparkContext.broadcast((lows, highs, chance))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, p = told.value
        for batch in batches:
            k = _keys(batch)
            at = np.searchsorted(low, k, "left") - 1           # last bracket that starts below the key
            live = at >= 0
            end = high[np.maximum(at, 0)]
            live &= (end == b"") | (k < end)
            live &= _draw(k, seed) < p[np.maximum(at, 0)]
            if live.any():
                size = batch.column(batch.schema.get_field_index("size"))
                yield pa.record_batch([pa.array([x.ljust(24, b"\0") for x in k[live].tolist()], pa.binary()),
                                       size.filter(pa.array(live))], names=["key", "size"])

    return rows.mapInArrow(run, "key binary, size bigint").toPandas()


def _counts(rows: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key below each probe, and in total (last)."""
    told = rows.sparkSession.sparkContext.broadcast(probes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = told.value
        size, n = np.zeros(len(p) + 1, np.int64), np.zeros(len(p) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(p, _keys(batch), "right")
            s = batch.column(batch.schema.get_field_index("size")).to_numpy(zero_copy_only=False)
            order = np.argsort(at, kind="stable")
            cuts, first = np.unique(at[order], return_index=True)
            if len(cuts):
                size[cuts] += np.add.reduceat(s[order], first)
                n[cuts] += np.diff(np.append(first, len(at)))
        hit = np.flatnonzero(n)
        yield pa.record_batch([pa.array(hit), pa.array(size[hit]), pa.array(n[hit])], names=["b", "size", "n"])

    got = (rows.mapInArrow(run, "b bigint, size bigint, n bigint").groupBy("b")
           .agg(F.sum("size").alias("size"), F.sum("n").alias("n")).toPandas())
    size, n = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    size[got["b"].to_numpy(np.int64)] = got["size"].to_numpy(np.int64)
    n[got["b"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return np.cumsum(size), np.cumsum(n)


class Splitters:
    """Boundaries found so far: probes in key order with the exact bytes and rows below them."""

    def __init__(self, total: int, n: int):
        self.total, self.n = total, n
        self.key, self.size = _fixed([]), np.zeros(0, np.int64)
        self.bytes, self.rows = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, found: pd.DataFrame, rows: DataFrame) -> None:
        fresh = _fixed([bytes(k) for k in found["key"]])
        order = np.argsort(fresh, kind="stable")
        fresh, size = fresh[order], found["size"].to_numpy(np.int64)[order]
        below, before = _counts(rows, fresh)
        key = np.concatenate([self.key, fresh])
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        self.size = np.concatenate([self.size, size])[order]
        self.bytes = np.concatenate([self.bytes, below[:-1]])[order]
        self.rows = np.concatenate([self.rows, before[:-1]])[order]

    def around(self, at: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """For the boundaries ``at`` of ``parts`` equal ranges: index of the first
        probe whose middle byte is at or behind it, and the rows strictly between
        that probe (or the end) and the one before it (or the start)."""
        # a row's middle, doubled: 2 * bytes below + size; a boundary, doubled: 2 * total * at / parts
        middle = [(2 * int(b) + int(s)) * parts for b, s in zip(self.bytes, self.size)]
        goal = [2 * self.total * int(a) for a in at]
        upper = np.array([_first_at_least(middle, g) for g in goal], np.int64)
        end = np.append(self.rows, self.n)
        start = np.concatenate([[-1], self.rows])
        return upper, end[upper] - start[upper] - 1

    def nearest(self, at: np.ndarray, upper: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """For each boundary the nearer of its two probes, by the bytes below
        them, and the bytes by which that one misses it."""
        below, goal = np.append(self.bytes, self.total).astype(float), self.total * at / parts
        lower = np.maximum(upper - 1, 0)
        a, b = np.abs(below[lower] - goal), np.abs(below[upper] - goal)
        return np.where(a < b, lower, upper), np.minimum(a, b)


def _first_at_least(values: list[int], goal: int) -> int:
    """Index of the first of the ascending ``values`` that is ``goal`` or more."""
    return bisect.bisect_left(values, goal)


def split(rows: DataFrame, n_shards: int = SHARDS, tolerance: float = TOLERANCE, probes: int = PROBES,
          piece_bytes: int = PIECE_BYTES) -> tuple[Splitters, np.ndarray, np.ndarray]:
    """Probes, the indices of those that start a shard, and of those that start a piece."""
    keys = rows.select(*_WORDS, "size")
    total, n = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    found = Splitters(int(total), int(n))
    cuts = max(1, -(-int(total) // (n_shards * piece_bytes)))         # pieces of a shard
    edges = np.arange(1, n_shards)                                    # exact boundaries
    inner = np.arange(1, n_shards * cuts)                             # any probe near will do
    first, seed, allowed = np.zeros(len(edges), np.int64), 0, tolerance * int(total) / n_shards
    if n:
        want = max(probes, 4 * len(inner))
        found.add(_probes(keys, _fixed([b"\0"]), _fixed([b""]), np.array([want / n]), seed), keys)
        while True:
            upper, between = found.around(edges, n_shards)
            near, off = found.nearest(edges, upper, n_shards)
            settled = (between == 0) | ((off <= allowed) & (tolerance > 0))
            first = np.where(between == 0, upper, near)
            if settled.all():
                break
            seed += 1
            open_ = np.unique(upper[~settled])
            ends = np.concatenate([found.key, _fixed([b""])])
            starts = np.concatenate([_fixed([b"\0"]), found.key])
            inside = np.append(found.rows, n)[open_] - np.concatenate([[-1], found.rows])[open_] - 1
            found.add(_probes(keys, starts[open_], ends[open_], np.minimum(1.0, probes / inside), seed), keys)
    pieces = found.around(inner, n_shards * cuts)[0] if cuts > 1 else first
    return found, first, np.unique(np.concatenate([first, pieces]))


def shard(rows: DataFrame, n_shards: int = SHARDS, tolerance: float = TOLERANCE, probes: int = PROBES,
          piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``rows`` (with the key words and ``size``) plus ``shard`` and ``slot``,
    partitioned by piece and in order within a piece."""
    found, first, pieces = split(rows, n_shards, tolerance, probes, piece_bytes)
    pieces = pieces[pieces < len(found.key)]
    piece_keys = found.key[pieces]
    starts = np.concatenate([[0], found.rows[pieces]]).astype(np.int64)      # rows before each piece
    # shard of a piece: the boundaries at or before its first key; rows before that shard
    owner = np.concatenate([[0], np.searchsorted(first, pieces, "right")]).astype(np.int32)
    shard_rows = np.concatenate([[0], np.append(found.rows, found.n)[first]]).astype(np.int64)
    told = rows.sparkSession.sparkContext.broadcast((piece_keys, starts, owner, shard_rows))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = told.value[0]
        for batch in batches:
            yield batch.append_column("_piece", pa.array(np.searchsorted(keys, _keys(batch), "right").astype(np.int32)))

    placed = rows.mapInArrow(place, ST.StructType([*rows.schema.fields, ST.StructField("_piece", ST.IntegerType())]))
    dealt = placed.repartitionById(len(pieces) + 1, "_piece").sortWithinPartitions("_piece", *_WORDS)
    kept = [f for f in rows.schema.fields if f.name not in _WORDS]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, before, own, from_ = told.value
        last, run = -1, 0
        for batch in batches:
            piece = batch.column(batch.schema.get_field_index("_piece")).to_numpy(zero_copy_only=False)
            start = np.searchsorted(piece, piece, "left")                    # first row of its piece in the batch
            at = np.arange(len(piece)) - start
            if len(piece):
                at[piece == last] += run
                run = int(at[-1]) + 1
                last = int(piece[-1])
            s = own[piece]
            yield pa.record_batch([*[batch.column(batch.schema.get_field_index(f.name)) for f in kept],
                                   pa.array(s), pa.array(before[piece] - from_[s] + at)],
                                  names=[*[f.name for f in kept], "shard", "slot"])

    return dealt.mapInArrow(number, ST.StructType([*kept, ST.StructField("shard", ST.IntegerType()),
                                                    ST.StructField("slot", ST.LongType())]))


def shard_documents(docs: DataFrame, n_shards: int = SHARDS, key: Column | None = None, carry: tuple[str, ...] = (),
                    tolerance: float = TOLERANCE, probes: int = PROBES, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard, carried...)``.

    Rows are sorted by ``key`` (a ``bigint`` column, the id if not given).
    ``carry`` names columns that travel along, such as ``text``."""
    T.prepare(docs.sparkSession)
    text, i = F.col("text").cast("string"), F.col("doc_id").cast("bigint")
    body = F.coalesce(text, F.lit(""))
    least = F.lit(-(1 << 63))
    staged = written(docs.select(
        i.alias("doc_id"), (F.octet_length(body) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.coalesce(i if key is None else key.cast("bigint"), least).alias("_h1"), F.xxhash64(i, text).alias("_h2"),
        *[F.col(f"`{c}`").alias(f"_c{n}") for n, c in enumerate(carry)]), "shard-rows")
    rows = staged.withColumn("_h3", place())
    out = shard(rows, n_shards, tolerance, probes, piece_bytes)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"),
                      *[F.col(f"_c{n}").alias(c) for n, c in enumerate(carry)])


def write_shards(sharded: DataFrame, path: str) -> str:
    """Files under ``path/run-*/shard=N``, rows in slot order within a file; a
    run is complete when its ``_SUCCESS`` file is there."""
    target = f"{path.rstrip('/')}/run-{uuid.uuid4().hex[:12]}"
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(target)
    return target
