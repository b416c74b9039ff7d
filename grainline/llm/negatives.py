"""Operator 13: hard negatives by rotated one-bit codes with exact intervals.

Vectors are turned to integers, ``floor(256 * x)``; a score is an integer inner
product.  Anchors are searched in blocks against all rows:

* **Codes.**  A seeded random rotation spreads a vector evenly over its axes.
  Its code is one sign bit an axis; the unit code vector ``u`` is the signs over
  the root of the dimension.  Stored beside the bits is the alignment
  ``a = <u, x>``; what the code misses, ``x - a u``, is orthogonal to ``u`` and
  coded the same way again (``STAGES`` codes a vector, each one bit an axis).
  The norm of the last residual is stored as well.
* **Estimates.**  An anchor is stored in ``PLANES`` bits an axis.  Its product
  with a code is a sum of popcounts over those bit planes, so estimates touch
  bits and one alignment per code.
* **Intervals.**  A score differs from its estimate by the anchor's product
  with the last residual plus what the anchor's rounding adds.  Both are bounded
  by Cauchy-Schwarz with stored norms, so the interval around an estimate always
  holds the score (a small term covers floating point rounding).
* **Filter.**  Positives: rows of the anchor's label whose interval reaches the
  k-th best score so far.  Negatives: rows of other labels whose interval meets
  a positive's window ``[0.3, 0.9]`` of its score and reaches that window's k-th
  best so far.  Surviving intervals are integer-scored; nothing is decided on an
  estimate.

Scale: codes and integer vectors are written once.  Anchors are dealt into
blocks of at most ``ANCHOR_BYTES``, each broadcast in turn; every task streams
its rows against the block and sends the best ``k`` of a window, so a pass
shuffles windows times tasks times ``k`` rows however many pairs there are.
Windows are reduced by one group-by whose groups hold at most ``k`` rows a task.

Edge cases: rows with a null label, a null vector or a null or non-finite
component take no part; a null id is never an anchor and comes last in ties;
shorter vectors count as padded with zeros, an empty one scores 0 everywhere;
repeated rows are rows of their own, so a copy of an anchor is one of its other
rows; fewer rows than asked for give all; an empty table gives an empty result;
vectors so long that a score may leave 64 bits raise an error; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .shared import written

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH, UNIT = 30, 90, 100         # a negative's score within these per cent of the positive's
STAGES = 4
PLANES = 8
ANCHOR_BYTES = 8 << 20
PAIRS = 1 << 20                       # pairs of one step in a task
SEED = 13
_NO_ID = (1 << 63) - 1


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix that depends on its size and the seed only."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _packed(positive: np.ndarray) -> np.ndarray:
    """Rows of bits in 64-bit words."""
    n, d = positive.shape
    raw = np.zeros((n, -(-d // 64) * 8), np.uint8)
    raw[:, :-(-d // 8)] = np.packbits(positive, axis=1, bitorder="little")
    return raw.view(np.uint64)


def encode(z: np.ndarray, turn: np.ndarray, stages: int = STAGES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code words ``(n, stages, words)``, alignments ``(n, stages)`` and last
    residual norms of integer vectors."""
    x = z.astype(np.float64) @ turn
    d = x.shape[1]
    codes, align = [], []
    for _ in range(stages):
        positive = x >= 0
        unit = np.where(positive, 1.0, -1.0) / np.sqrt(d)
        a = np.einsum("ij,ij->i", unit, x)
        x = x - a[:, None] * unit
        codes.append(_packed(positive))
        align.append(a)
    return np.stack(codes, 1), np.stack(align, 1), np.sqrt(np.einsum("ij,ij->i", x, x))


class Anchors:
    """A block of anchors in bit planes, ready to be estimated against codes."""

    def __init__(self, z: np.ndarray, turn: np.ndarray, planes: int = PLANES):
        self.z, self.d = z, turn.shape[0]
        q = z.astype(np.float64) @ turn
        self.norm = np.sqrt(np.einsum("ij,ij->i", q, q))
        low = q.min(axis=1, initial=0.0)
        step = np.maximum((q.max(axis=1, initial=0.0) - low) / (2 ** planes - 1), 1e-300)
        cell = np.rint((q - low[:, None]) / step[:, None])
        self.low, self.step = low, step
        self.bits = [_packed((cell.astype(np.int64) >> j & 1).astype(bool)) for j in range(planes)]
        self.sum = cell.sum(axis=1)
        rest = q - (low[:, None] + step[:, None] * cell)
        self.rest = np.sqrt(np.einsum("ij,ij->i", rest, rest))     # what the bit planes miss

    def estimate(self, codes: np.ndarray, align: np.ndarray) -> np.ndarray:
        """Products with the coded parts: ``(anchors, rows)``."""
        out = np.zeros((len(self.z), len(codes)))
        for s in range(codes.shape[1]):
            word = codes[:, s, :]
            ones = np.bitwise_count(word).sum(axis=1).astype(np.float64)
            hit = np.zeros_like(out)
            for j, plane in enumerate(self.bits):
                count = np.zeros(out.shape, np.uint16)
                for w in range(word.shape[1]):
                    count += np.bitwise_count(plane[:, w, None] & word[None, :, w])
                hit += count * float(1 << j)
            # signs are 2 * bit - 1
            signed = self.step[:, None] * (2 * hit - self.sum[:, None]) + self.low[:, None] * (2 * ones[None, :] - self.d)
            out += signed * (align[:, s] / np.sqrt(max(self.d, 1)))[None, :]
        return out

    def reach(self, align: np.ndarray, residual: np.ndarray, stages: int) -> np.ndarray:
        """How far a score can be from its estimate, at most."""
        coded = np.abs(align).sum(axis=1)                     # norm of the coded part, at most
        slack = 1e-9 * np.multiply.outer(self.norm + 1.0, coded + residual + 1.0)
        return np.multiply.outer(self.norm, residual) + np.multiply.outer(self.rest, coded) + slack


def vectors(rows: DataFrame) -> DataFrame:
    """Written table ``(row, vec_id, label, z)`` of the rows that take part."""
    v, i = F.col("embedding").cast("array<double>"), F.col("vec_id").cast("bigint")
    label = F.col("label").cast("bigint")
    kept = rows.select(i.alias("vec_id"), F.when(i % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), v.alias("v"))
    kept = kept.filter(F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(
        F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True)))
    z = F.transform("v", lambda x: F.floor(x * 256).cast("bigint"))
    return written(kept.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", z.alias("z")), "vectors")


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    """Lists of integers as rows of ``dim`` columns, padded with zeros."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False)
    n = np.diff(col.offsets.to_numpy(zero_copy_only=False))
    out = np.zeros((len(col), dim), np.int64)
    if len(n) and (n == dim).all():
        return flat.reshape(-1, dim)
    out[np.arange(dim)[None, :] < n[:, None]] = flat
    return out


def _bytes(rows: np.ndarray) -> pa.Array:
    """Each row's numbers as one binary value."""
    rows = np.ascontiguousarray(rows)
    width = rows[0].nbytes if len(rows) else 0
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [
        None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * width), pa.py_buffer(rows)])


def coded(table: DataFrame, dim: int, stages: int = STAGES) -> DataFrame:
    """``table`` with code words, alignments and residual norms, written."""
    words = -(-dim // 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dim)
        for batch in batches:
            for a in range(0, batch.num_rows, max(1, PAIRS // dim)):
                part = batch.slice(a, max(1, PAIRS // dim))
                z = _matrix(part.column(3), dim)
                codes, align, left = encode(z, turn, stages)
                yield pa.record_batch([*[part.column(c) for c in range(3)], _bytes(z), _bytes(codes), _bytes(align),
                                       pa.array(left)], names=["row", "vec_id", "label", "z", "code", "align", "left"])

    return written(table.mapInArrow(run, "row bigint, vec_id bigint, label bigint, z binary, code binary, align binary, left double"),
                   "codes")


def _numbers(col: pa.Array, dtype, shape: tuple) -> np.ndarray:
    """Fixed-width binary values of a column as one array."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    _, offs, data = col.buffers()
    at = np.frombuffer(offs, np.int32 if pa.types.is_binary(col.type) else np.int64)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]].view(dtype).reshape(len(col), *shape)


class _Best:
    """The ``k`` best (score, id) rows of each window met so far in a task."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.id = np.full((n, k), _NO_ID)
        self.have = np.zeros(n, np.int64)

    def least(self) -> np.ndarray:
        """Score a row has to reach: the k-th best, or none."""
        return np.where(self.have >= self.k, self.score[:, -1].astype(np.float64), -np.inf)

    def add(self, w: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        order = np.lexsort((ids, -score, w))
        w, score, ids = w[order], score[order], ids[order]
        first = np.searchsorted(w, w, "left")
        top = np.arange(len(w)) - first < self.k
        w, score, ids = w[top], score[top], ids[top]
        for x in np.unique(w):                        # at most k fresh rows a window
            a, b = np.searchsorted(w, x, "left"), np.searchsorted(w, x, "right")
            n = self.have[x]
            s = np.concatenate([self.score[x, :n], score[a:b]])
            d = np.concatenate([self.id[x, :n], ids[a:b]])
            o = np.lexsort((d, -s))[:self.k]
            self.score[x, :len(o)], self.id[x, :len(o)], self.have[x] = s[o], d[o], len(o)


def _search(rows: DataFrame, block, dim: int, stages: int, positive: bool, k: int) -> DataFrame:
    """``(window, score, vec_id)``: each task's best ``k`` rows of every window.

    ``block``: anchors' integer vectors, rows, labels, and per window its
    anchor and its least and greatest score."""
    spark = rows.sparkSession
    told = spark.sparkContext.broadcast(block)
    words = -(-dim // 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, own, label, anchor, low, high = told.value
        q = Anchors(z, rotation(dim))
        best = _Best(len(anchor), k)
        step = max(1, PAIRS // max(len(z), 1))
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                row, rl = (part.column(c).to_numpy(zero_copy_only=False) for c in (0, 2))
                ids = part.column(1).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
                vec = _numbers(part.column(3), np.int64, (dim,))
                align = _numbers(part.column(5), np.float64, (stages,))
                left = part.column(6).to_numpy(zero_copy_only=False)
                est = q.estimate(_numbers(part.column(4), np.uint64, (stages, words)), align)
                far = q.reach(align, left, stages)
                same = label[:, None] == rl[None, :]
                fit = same & (own[:, None] != row[None, :]) if positive else ~same
                top, bottom = est + far, est - far
                # windows of one rank over all anchors at a time: the rows their intervals can hold
                for turn in _ranks(anchor):
                    who = anchor[turn]
                    ok = fit[who] & (top[who] >= low[turn, None]) & (bottom[who] <= high[turn, None])
                    _settle(best, turn, who, ok, top[who], est[who], z, vec, ids, low, high, k)
        w = np.repeat(np.arange(len(anchor)), best.have)
        at = np.arange(len(w)) - np.repeat(np.cumsum(best.have) - best.have, best.have)
        yield pa.record_batch([pa.array(w), pa.array(best.score[w, at]), pa.array(best.id[w, at])],
                              names=["window", "score", "vec_id"])

    return rows.mapInArrow(run, "window bigint, score bigint, vec_id bigint")


def _ranks(anchor: np.ndarray) -> list[np.ndarray]:
    """Windows in groups that hold no anchor twice (windows lie by anchor)."""
    rank = np.arange(len(anchor)) - np.searchsorted(anchor, anchor, "left")
    return [np.flatnonzero(rank == r) for r in range(int(rank.max(initial=-1)) + 1)]


def _settle(best, turn, who, ok, top, est, z, vec, ids, low, high, k) -> None:
    """Score the rows ``ok`` allows, likely best ones first: these raise what the
    rest of the rows has to reach."""
    def score(a, r):
        s = np.einsum("ij,ij->i", z[who[a]], vec[r])
        keep = (s >= low[turn[a]]) & (s <= high[turn[a]])
        best.add(turn[a[keep]], s[keep], ids[r[keep]])

    ok &= top >= best.least()[turn, None]
    n = ok.sum(axis=1)
    many = np.flatnonzero(n > 4 * k)
    if len(many):
        guess = np.where(ok[many], np.minimum(est[many], high[turn[many], None]), -np.inf)
        pick = np.argpartition(-guess, 2 * k, axis=1)[:, :2 * k]
        a, r = np.repeat(many, 2 * k), pick.ravel()
        ok[a, r] = False
        score(a, r)
        ok &= top >= best.least()[turn, None]
    a, r = np.nonzero(ok)
    for i in range(0, len(a), PAIRS // 8):
        score(a[i:i + PAIRS // 8], r[i:i + PAIRS // 8])


def _reduced(found: DataFrame, k: int) -> DataFrame:
    """Best ``k`` of each window over all tasks, ranked from 1."""
    over = Window.partitionBy("window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(over)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
         stages: int = STAGES, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchor`` is a condition on ``vec_id`` and ``label`` (ids divisible by 100
    if not given)."""
    spark = rows.sparkSession
    T.prepare(spark)
    table = vectors(rows)
    dim, n = table.agg(F.max(F.size("z")), F.count(F.lit(1))).first()
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not n:
        return spark.createDataFrame([], schema)
    dim = max(int(dim), 1)
    longest = table.agg(F.max(F.aggregate("z", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))).first()[0]
    if longest >= 2.0 ** 62:
        raise ValueError("a score of these vectors may not fit in 64 bits")
    codes = coded(table, dim, stages)
    condition = F.col("vec_id") % 100 == 0 if anchor is None else anchor
    chosen = codes.filter(F.coalesce(condition, F.lit(False)) & F.col("vec_id").isNotNull()).select("row", "vec_id", "label", "z")
    size = max(1, anchor_bytes // (8 * dim))
    blocks = max(1, -(-chosen.count() // size))
    chosen = written(chosen.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))), "anchors")
    out = []
    for b in range(blocks):
        got = chosen.filter(F.col("block") == b).toArrow()              # about ``anchor_bytes``
        if not got.num_rows:
            continue
        out.append(_mine_block(codes, got, dim, stages, positives, negatives, b))
    if not out:
        return spark.createDataFrame([], schema)
    while len(out) > 1:                                                 # a balanced union of the blocks
        out = [out[i].union(out[i + 1]) if i + 1 < len(out) else out[i] for i in range(0, len(out), 2)]
    return out[0]


def _mine_block(codes: DataFrame, got: pa.Table, dim: int, stages: int, positives: int, negatives: int, b: int) -> DataFrame:
    spark = codes.sparkSession
    row, ids, label = (got.column(c).to_numpy() for c in ("row", "vec_id", "label"))
    z = np.ascontiguousarray(_numbers(got.column("z"), np.int64, (dim,)))
    everyone = np.arange(len(row))
    least, most = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    near = _reduced(_search(codes, (z, row, label, everyone, np.full(len(row), least), np.full(len(row), most)),
                            dim, stages, True, positives), positives).toPandas()      # anchors of the block x positives
    near = near.sort_values(["window", "rank"])
    who, score, pid = (near[c].to_numpy(np.int64) for c in ("window", "score", "vec_id"))
    # 30 p <= 100 s <= 90 p, in whole numbers
    low = np.array([-(-LOW * int(p) // UNIT) for p in score], np.int64)
    high = np.array([HIGH * int(p) // UNIT for p in score], np.int64)
    live = low <= high
    who, score, pid, low, high = (x[live] for x in (who, score, pid, low, high))
    found = _reduced(_search(codes, (z, row, label, who, low, high), dim, stages, False, negatives), negatives)
    windows = spark.createDataFrame(
        list(zip(range(len(who)), ids[who].tolist(), pid.tolist(), score.tolist())),
        "window bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
    none = F.lit(_NO_ID)
    return written(found.join(windows, "window").select(
        "anchor_id", F.nullif("positive_id", none).alias("positive_id"), "rank",
        F.nullif(F.col("vec_id"), none).alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), f"mined-{b}")
