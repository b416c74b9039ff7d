"""Exact k-nearest-neighbour imputation without an all-pairs join.

Semantics: every numeric column with gaps is filled from the mean of that
column over the ``k`` nearest rows where it is present.  The distance is the
NaN-aware Euclidean one, ``sqrt(n / |C| · Σ_{j∈C} (a_j − b_j)²)`` over the
coordinates ``C`` present in both rows (``n`` = number of features).  Ties are
broken by the donor's feature tuple, so the result is deterministic.  With a
single numeric column the median is used instead.

Plan, per column to fill:

* **Pre-aggregation.**  Donors are grouped by their full feature tuple with a
  multiplicity, receivers by their tuple: a value repeated in a third of the
  table becomes one weighted row before anything is shuffled.
* **Tree.**  Donors are dealt into the leaves of a space-partition tree
  (``spacetree``): median splits on the widest coordinate, missing coordinates
  split off first, so skewed and gappy columns fill leaves evenly and no column
  has to be free of nulls.  It is grown on a bounded sample of the donors, has at most
  ``MAX_LEAVES`` leaves, and travels to the tasks as arrays.  One aggregate gives
  the exact box of every leaf.
* **Rounds.**  A receiver first meets its own leaf.  Each further round sends it
  to the next nearest leaves among those whose lower bound is within its ``k``-th
  best distance so far; most receivers end after one or two.  Leaves are cut into
  donor chunks and receiver chunks by hash, and each ``(leaf, donor chunk, receiver
  chunk)`` group is solved by ``cogroup().applyInPandas`` with numpy, which returns
  only the best ``k`` (by multiplicity) per receiver; pairs are never materialised.
* **Exact stop.**  A receiver is finished when no unvisited leaf can hold a donor
  at its ``k``-th distance or nearer.  Leaves without a coordinate in common with it
  are never visited.  Candidates are staged between rounds in the shared folder.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import as_double, existing, numeric_columns, qcol
from ..functions.joins import join_lookup
from ..functions.staging import staged
from .spacetree import Boxes, grow, leaf_of

DONORS_PER_CELL = 2048
MAX_LEAVES = 8192
SAMPLE_PER_LEAF = 16            # donors the tree is grown on, for each leaf
CHUNK_ROWS = 2048
BOUND_CELLS = 1 << 21           # receivers x leaves x coordinates bounded at a time in a task


def impute_knn(df: DataFrame, target: str | None = None, k: int = 5, columns=None,
               donors_per_cell: int = DONORS_PER_CELL, chunk_rows: int = CHUNK_ROWS,
               max_leaves: int = MAX_LEAVES) -> DataFrame:
    """``df`` with the gaps of all its numeric columns (or ``columns``) filled;
    nothing happens where ``target`` is none of them."""
    feats = existing(df, columns) if columns else numeric_columns(df)
    if target is not None and target not in feats:
        return df
    if len(feats) <= 1:
        from .impute import impute
        return impute(df, {target or feats[0]: "median"}) if feats else df
    n = len(feats)
    fcols = [f"f{i}" for i in range(n)]
    X = df.select(*[as_double(df, c).alias(f) for c, f in zip(feats, fcols)])
    stats = X.agg(*[F.count_if(F.col(f).isNull()).alias(f"z{i}") for i, f in enumerate(fcols)],
                  *[F.avg(f).alias(f"m{i}") for i, f in enumerate(fcols)]).first()
    to_fill = [i for i in range(n) if stats[f"z{i}"] > 0]
    if not to_fill:
        return df
    lookups = []
    for j in to_fill:
        vals = _knn_column(X, fcols, j, k, stats, donors_per_cell, chunk_rows, max_leaves)
        lookups.append(vals.withColumnRenamed("value", f"fill{j}"))
    table = lookups[0]
    for other in lookups[1:]:
        table = _merge_lookup(table, other, fcols)
    keyed = df.withColumns({f"__k{i}": as_double(df, c) for i, c in enumerate(feats)})
    look = table.select(*[F.col(f).alias(f"__l{i}") for i, f in enumerate(fcols)],
                        *[F.col(f"fill{j}") for j in to_fill])
    cond = [F.col(f"__k{i}").eqNullSafe(F.col(f"__l{i}")) for i in range(n)]
    joined = join_lookup(keyed, look, cond, "left")
    out = joined.withColumns({feats[j]: F.coalesce(as_double(df, feats[j]), F.col(f"fill{j}"))
                              for j in to_fill})
    return out.select(*[qcol(c) for c in df.columns])


def _merge_lookup(a: DataFrame, b: DataFrame, fcols: list[str]) -> DataFrame:
    """Receivers of several columns in one table (one row per tuple)."""
    fill_a = [c for c in a.columns if c.startswith("fill")]
    fill_b = [c for c in b.columns if c.startswith("fill")]
    u = a.unionByName(b, allowMissingColumns=True)
    key = F.struct(*[F.col(f) for f in fcols])
    return u.groupBy(key.alias("__t")).agg(*[F.max(c).alias(c) for c in fill_a + fill_b]) \
        .select(*[F.col("__t").getField(f).alias(f) for f in fcols], *fill_a, *fill_b)


def _numbers(batch: pa.RecordBatch, fcols: list[str]) -> np.ndarray:
    """Coordinates of a batch, missing ones as NaN."""
    return np.stack([batch.column(batch.schema.get_field_index(f)).cast(pa.float64()).to_numpy(zero_copy_only=False)
                     for f in fcols], axis=1).astype(np.float64)


def _with_leaf(points: DataFrame, fcols: list[str], nodes) -> DataFrame:
    """``points`` plus the ``leaf`` each falls into."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("leaf", pa.array(leaf_of(nodes.value, _numbers(batch, fcols)).astype(np.int32)))

    return points.mapInArrow(run, T.StructType([*points.schema.fields, T.StructField("leaf", T.IntegerType())]))


def _next_leaves(receivers: DataFrame, fcols: list[str], boxes, seen: int, step: int) -> DataFrame:
    """``(coordinates, leaf)``: per receiver the leaves ``seen`` to ``seen + step`` among
    those within its limit ``dk2``, nearest first, its own leaf left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = boxes.value
        block = max(1, BOUND_CELLS // (len(told.nodes["kind"]) * len(fcols)))
        for batch in batches:
            for start in range(0, batch.num_rows, block):
                part = batch.slice(start, block)
                x = _numbers(part, fcols)
                limit = part.column(part.schema.get_field_index("dk2")).cast(pa.float64()).to_numpy(zero_copy_only=False)
                home = part.column(part.schema.get_field_index("home")).to_numpy(zero_copy_only=False)
                point, leaf, _ = told.near(x, np.where(np.isnan(limit), np.inf, limit))
                other = leaf != home[point]
                point, leaf = point[other], leaf[other]
                place = np.arange(len(point)) - np.searchsorted(point, point, "left")
                due = (place >= seen) & (place < seen + step)
                point, leaf = point[due], leaf[due]
                taken = part.select(fcols).take(pa.array(point))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(leaf.astype(np.int32))], names=[*fcols, "leaf"])

    return receivers.mapInArrow(run, T.StructType([*[T.StructField(f, T.DoubleType()) for f in fcols],
                                                    T.StructField("leaf", T.IntegerType())]))


def _knn_column(X: DataFrame, fcols, j, k, stats, donors_per_cell, chunk_rows, max_leaves) -> DataFrame:
    spark = X.sparkSession
    fj = fcols[j]
    donors = staged(X.where(F.col(fj).isNotNull()).groupBy(*fcols).agg(F.count(F.lit(1)).alias("m")), "donors")
    receivers = X.where(F.col(fj).isNull()).select(*fcols).distinct()
    n_donors = donors.count()
    if n_donors == 0:
        return receivers.withColumn("value", F.lit(None).cast("double"))
    # the target takes no part in a distance, receivers do not have it
    leaves = max(1, min(max_leaves, math.ceil(n_donors / donors_per_cell)))
    want = SAMPLE_PER_LEAF * leaves
    sample = donors if n_donors <= want else donors.where(
        F.pmod(F.xxhash64(F.lit(5), *fcols), F.lit(1 << 30)) < F.lit(int((1 << 30) * want / n_donors)))
    drawn = sample.select(*fcols).limit(2 * want).toPandas().to_numpy(dtype="float64", na_value=np.nan)
    drawn[:, j] = np.nan
    nodes = grow(drawn, leaves).packed() if len(drawn) else grow(np.full((1, len(fcols)), np.nan), 1).packed()
    told = spark.sparkContext.broadcast(nodes)
    blank = [F.lit(None).cast("double").alias(f) if f == fj else F.col(f) for f in fcols]
    donors = staged(_with_leaf(donors.select(*blank, F.col(fj).alias("__t"), "m"), fcols, told)
                    .select("leaf", *[f for f in fcols if f != fj], F.col("__t").alias(fj), "m"), "donor-leaves")
    others = [f for f in fcols if f != fj]
    per_leaf = donors.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("nd"), *[F.min(f).alias(f"lo_{f}") for f in others],
        *[F.max(f).alias(f"hi_{f}") for f in others], *[F.count(f).alias(f"n_{f}") for f in others])
    found = per_leaf.toPandas().set_index("leaf")              # a row per leaf, at most ``max_leaves``
    boxes = spark.sparkContext.broadcast(_boxes(nodes, found, fcols, fj))
    chunks = spark.createDataFrame([(int(i), int(math.ceil(nd / chunk_rows))) for i, nd in found["nd"].items()],
                                   "leaf int, dchunks int")
    donors = join_lookup(donors, chunks, "leaf", "inner", len(found))
    donors = donors.withColumn("dchunk", F.pmod(F.xxhash64(*fcols), F.col("dchunks")).cast("int")).drop("dchunks")

    recv = staged(_with_leaf(receivers, fcols, told).withColumnRenamed("leaf", "home"), "receivers")
    rk = F.struct(*fcols)
    rk_type = recv.select(rk.alias("rk")).schema["rk"].dataType
    cand_schema = T.StructType([T.StructField("rk", rk_type),
                                *[T.StructField(f"d_{f}", T.DoubleType()) for f in fcols],
                                T.StructField("dist2", T.DoubleType()), T.StructField("m", T.LongType())])
    targets, candidates, seen, step = recv.select(*fcols, F.col("home").alias("leaf")), None, 0, 2
    while True:
        # receiver chunks per target leaf; each meets every donor chunk of the leaf
        per_t = targets.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / chunk_rows).cast("int").alias("rchunks"))
        per_t = staged(per_t.join(chunks, "leaf", "inner"), "chunks")
        sent = join_lookup(targets, per_t, "leaf", "inner", len(found))
        sent = sent.withColumn("rchunk", F.pmod(F.xxhash64(*fcols), F.col("rchunks")).cast("int"))
        sent = sent.withColumn("dchunk", F.explode(F.sequence(F.lit(0), F.col("dchunks") - 1)))
        dside = join_lookup(donors, per_t.select("leaf", "rchunks"), "leaf", "inner", len(found))
        dside = dside.withColumn("rchunk", F.explode(F.sequence(F.lit(0), F.col("rchunks") - 1)))
        keys = ["leaf", "dchunk", "rchunk"]
        got = (sent.select(*keys, *fcols).groupBy(*keys)
               .cogroup(dside.select(*keys, *[F.col(f).alias(f"d_{f}") for f in fcols], "m").groupBy(*keys))
               .applyInPandas(_group_topk(fcols, j, k), cand_schema))
        both = got if candidates is None else candidates.unionByName(got, allowMissingColumns=True)
        candidates = staged(_keep_best(both, fcols, k), "candidates")
        if len(found) == 1:
            break
        # receivers without k donors yet have no limit
        status = _status(candidates, k)
        open_ = recv.withColumn("rk", rk).join(status, "rk", "left").select(*fcols, "home", "dk2")
        targets = staged(_next_leaves(open_, fcols, boxes, seen, step), "targets")
        if targets.isEmpty():
            break
        seen, step = seen + step, step * 4
    # value = mean of the target over the best k (multiplicities included)
    best = candidates.withColumn("use", F.least(F.col("m"), F.lit(k) - F.col("__before")))
    best = best.where(F.col("use") > 0)
    vals = best.groupBy("rk").agg((F.sum(F.col(f"d_{fj}") * F.col("use")) / F.sum("use")).alias("value"))
    out = recv.withColumn("rk", rk).join(vals, "rk", "left")
    return out.select(*fcols, F.coalesce(F.col("value"), F.lit(stats[f"m{j}"])).alias("value"))


def _boxes(nodes: dict, found: pd.DataFrame, fcols: list[str], fj: str) -> Boxes:
    """Boxes of the tree from the leaves' ranges; the target is in none of them."""
    n, leaves = len(fcols), int(nodes["leaf"].max()) + 1
    low, high = np.full((leaves, n), np.inf), np.full((leaves, n), -np.inf)
    always, ever, held = np.zeros((leaves, n), bool), np.zeros((leaves, n), bool), np.zeros(leaves, bool)
    at = found.index.to_numpy(np.int64)
    held[at] = True
    for i, f in enumerate(fcols):
        if f == fj:
            continue
        count = found[f"n_{f}"].to_numpy(np.int64)
        low[at, i] = found[f"lo_{f}"].to_numpy(dtype="float64", na_value=np.inf)
        high[at, i] = found[f"hi_{f}"].to_numpy(dtype="float64", na_value=-np.inf)
        ever[at, i], always[at, i] = count > 0, count == found["nd"].to_numpy(np.int64)
    low[~ever], high[~ever] = np.inf, -np.inf
    return Boxes(nodes, low, high, always, ever, held)


def _keep_best(cands: DataFrame, fcols, k) -> DataFrame:
    """Per receiver, the best donors until their multiplicities reach ``k``;
    ``__before`` is the multiplicity of strictly better donors."""
    base = cands.drop("__before") if "__before" in cands.columns else cands
    w = Window.partitionBy("rk").orderBy("dist2", *[f"d_{f}" for f in fcols])
    ranked = base.withColumn("__before", F.coalesce(
        F.sum("m").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return ranked.where(F.col("__before") < k)


def _status(cands: DataFrame, k) -> DataFrame:
    reached = F.col("__before") + F.col("m") >= k
    return cands.groupBy("rk").agg(F.sum("m").alias("have"),
                                    F.min(F.when(reached, F.col("dist2"))).alias("dk2"))


def _group_topk(fcols, j, k):
    n = len(fcols)

    def solve(rdf: pd.DataFrame, ddf: pd.DataFrame) -> pd.DataFrame:
        if rdf.empty or ddf.empty:
            return pd.DataFrame({"rk": [], **{f"d_{f}": [] for f in fcols}, "dist2": [], "m": []})
        A = rdf[fcols].to_numpy(dtype="float64", na_value=np.nan)
        B = ddf[[f"d_{f}" for f in fcols]].to_numpy(dtype="float64", na_value=np.nan)
        mult = ddf["m"].to_numpy(dtype="int64")
        out = []
        step = max(1, 2_000_000 // max(1, len(B) * n))
        # tie-break on the donor tuple in Spark's ascending order (nulls first)
        order_keys = []
        for c in reversed(range(n)):
            order_keys += [np.nan_to_num(B[:, c]), ~np.isnan(B[:, c])]
        for s in range(0, len(A), step):
            a = A[s:s + step]
            diff = a[:, None, :] - B[None, :, :]
            sq = np.nansum(diff * diff, axis=2)
            cnt = np.sum(~np.isnan(diff), axis=2)
            with np.errstate(divide="ignore", invalid="ignore"):
                d2 = np.where(cnt > 0, sq * (n / np.maximum(cnt, 1)), np.nan)
            for r in range(len(a)):
                row = d2[r]
                valid = ~np.isnan(row)
                if not valid.any():
                    continue
                idx = np.flatnonzero(valid)
                # order by distance, then by the donor tuple
                o = np.lexsort([k_[idx] for k_ in order_keys] + [row[idx]])
                idx = idx[o]
                cum = np.cumsum(mult[idx])
                keep = idx[: int(np.searchsorted(cum, k) + 1)]
                key = {f: (None if np.isnan(a[r, c]) else float(a[r, c])) for c, f in enumerate(fcols)}
                for t in keep:
                    out.append((key, *B[t], float(row[t]), int(mult[t])))
        return pd.DataFrame(out, columns=["rk", *[f"d_{f}" for f in fcols], "dist2", "m"])

    return solve
