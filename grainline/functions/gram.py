"""Means and scatter matrix of many columns in one job.

Each task keeps ``(n, mean, M)`` of its rows, ``M`` being the scatter matrix
``sum (x - mean)(x - mean)^T``, updated once an Arrow batch.  It sends the
upper triangle of ``M`` as tiles of ``TILE`` columns squared, each with the
means it belongs to, so that tiles are summed by different tasks.  Partials are
merged pairwise by the update formula for means and scatters (no difference of
large sums), in two levels: ``FAN`` groups of tasks, then the groups.  A group
holds one tile per task at most, the driver gets one row a tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

TILE = 64
FAN = 1024
_SCHEMA = "bi int, bj int, slot int, n bigint, mi binary, mj binary, m binary"


def _merged(a: tuple, b: tuple) -> tuple:
    """``(n, mean_i, mean_j, M)`` of two disjoint sets of rows."""
    na, ai, aj, am = a
    nb, bi, bj, bm = b
    n = na + nb
    if not na or not nb:
        return b if not na else a
    di, dj = bi - ai, bj - aj
    return n, ai + di * (nb / n), aj + dj * (nb / n), am + bm + np.outer(di, dj) * (na * nb / n)


def _tiles(d: int) -> list[tuple[int, int]]:
    k = -(-d // TILE)
    return [(i, j) for i in range(k) for j in range(i, k)]


def scatter(df: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """``(rows, means, M)`` of the double columns of ``df``, which holds no nulls."""
    d = len(df.columns)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0, np.zeros(d), np.zeros(d), np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
                mean = x.mean(axis=0)
                x = x - mean
                total = _merged(total, (len(x), mean, mean, x.T @ x))
        n, mean, _, m = total
        if not n:
            return
        slot = TaskContext.get().partitionId() % FAN
        cuts = [slice(i * TILE, (i + 1) * TILE) for i in range(-(-d // TILE))]
        for i, j in _tiles(d):
            yield pa.record_batch([
                pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([slot], pa.int32()), pa.array([n], pa.int64()),
                *[pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in (mean[cuts[i]], mean[cuts[j]], m[cuts[i], cuts[j]])]],
                names=["bi", "bj", "slot", "n", "mi", "mj", "m"])

    def numbers(r) -> tuple:
        mi, mj = np.frombuffer(r.mi), np.frombuffer(r.mj)
        return int(r.n), mi, mj, np.frombuffer(r.m).reshape(len(mi), len(mj))

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("n", kind="stable")
        rows = [numbers(r) for r in group.itertuples(index=False)]
        while len(rows) > 1:                               # pairwise, so that merged sets are of like size
            rows = [_merged(rows[i], rows[i + 1]) if i + 1 < len(rows) else rows[i] for i in range(0, len(rows), 2)]
        n, mi, mj, m = rows[0]
        first = group.iloc[0]
        return pd.DataFrame({"bi": [first.bi], "bj": [first.bj], "slot": [first.slot], "n": [n], "mi": [mi.tobytes()],
                             "mj": [mj.tobytes()], "m": [np.ascontiguousarray(m).tobytes()]})

    parts = df.mapInArrow(part, _SCHEMA)
    parts = parts.groupBy("bi", "bj", "slot").applyInPandas(merge, _SCHEMA)
    rows = parts.groupBy("bi", "bj").applyInPandas(merge, _SCHEMA).collect()       # one row a tile
    mean, m, n = np.zeros(d), np.zeros((d, d)), 0
    for r in rows:
        n, mi, mj, tile = numbers(r)
        a, b = slice(r.bi * TILE, r.bi * TILE + len(mi)), slice(r.bj * TILE, r.bj * TILE + len(mj))
        mean[a], mean[b] = mi, mj
        m[a, b], m[b, a] = tile, tile.T
    return n, mean, m
