"""Isolation forest (Liu, Ting, Zhou 2008) as a distributed Spark job.

1. **Sample.**  A pool of some 64 times ``max_samples`` rows is drawn once, by a
   seeded number of each row's own, so that equal rows are drawn apart.  Within the
   pool a row joins tree ``t`` when its hash with ``t`` falls under a rate that yields
   about twice ``max_samples`` rows per tree, so only a few hundred rows per tree leave
   the stage; the table is never copied per tree.
2. **Grow.**  ``groupBy(tree).applyInPandas``: each group keeps its
   ``max_samples`` smallest hashes and grows one random tree with numpy.  A
   group holds at most a few hundred rows.
3. **Score.**  The forest (at most trees × (2·max_samples − 1) nodes) is
   broadcast; a pandas UDF walks each Arrow batch through every tree.
4. **Cut.**  The outlier cut is the ``1 − contamination`` quantile of the
   training scores (``percentile_approx`` with accuracy 10⁴, one pass).

An empty table gives a forest without trees, which flags nothing and scores null.

Randomness comes from ``seed`` and the tree id, so results are reproducible;
they are not bit-equal to other implementations of the algorithm.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..functions.exprs import as_double, existing, numeric_columns

NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left int, right int, "
               "size int, leaf boolean")
EULER_GAMMA = 0.5772156649015329   # fixed value: Euler–Mascheroni constant


def average_path(n: float) -> float:
    """c(n): average path length of an unsuccessful binary-search-tree search."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    """Grow one isolation tree; returns node rows (node, feature, threshold, left, right, size, leaf)."""
    nodes = []
    stack = [(np.arange(len(x)), 0, 0)]
    nodes.append(None)
    while stack:
        idx, depth, nid = stack.pop()
        sub = x[idx]
        if depth >= max_depth or len(idx) <= 1:
            nodes[nid] = (nid, -1, 0.0, -1, -1, len(idx), True)
            continue
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.where(hi > lo)[0]
        if len(usable) == 0:
            nodes[nid] = (nid, -1, 0.0, -1, -1, len(idx), True)
            continue
        f = int(rng.choice(usable))
        t = float(rng.uniform(lo[f], hi[f]))
        left_idx, right_idx = idx[sub[:, f] < t], idx[sub[:, f] >= t]
        lid, rid = len(nodes), len(nodes) + 1
        nodes.extend([None, None])
        nodes[nid] = (nid, f, t, lid, rid, len(idx), False)
        stack.append((left_idx, depth + 1, lid))
        stack.append((right_idx, depth + 1, rid))
    return nodes


@dataclass
class IsolationForestModel:
    columns: list[str]
    trees: dict            # tree id -> arrays (feature, threshold, left, right, leaf_adjust, leaf)
    max_samples: int
    threshold: float | None = None

    def packed(self):
        """All trees in flat arrays (absolute child indices) plus each root."""
        feats, thrs, lefts, rights, adjs, leaves, roots = [], [], [], [], [], [], []
        offset = 0
        for feat, thr, left, right, adj, leaf in self.trees.values():
            roots.append(offset)
            feats.append(feat)
            thrs.append(thr)
            lefts.append(np.where(left >= 0, left + offset, -1))
            rights.append(np.where(right >= 0, right + offset, -1))
            adjs.append(adj)
            leaves.append(leaf)
            offset += len(feat)
        cat = np.concatenate
        return (cat(feats), cat(thrs), cat(lefts), cat(rights), cat(adjs), cat(leaves).astype(bool),
                np.array(roots, dtype=np.int64))

    def score_column(self, df: DataFrame):
        sc = df.sparkSession.sparkContext
        forest = sc.broadcast(self.packed())
        norm = average_path(self.max_samples)
        n_trees = max(len(self.trees), 1)

        @pandas_udf("double")
        def score(*cols: pd.Series) -> pd.Series:
            feat, thr, left, right, adj, leaf, roots = forest.value
            x = np.column_stack([c.to_numpy(dtype="float64", na_value=np.nan) for c in cols])
            x = np.nan_to_num(x, nan=0.0)
            rows = np.arange(len(x))[:, None]
            node = np.broadcast_to(roots, (len(x), len(roots))).copy()   # one walker per (row, tree)
            depth = np.zeros(node.shape)
            active = ~leaf[node]
            while active.any():
                go_left = x[rows, feat[node]] < thr[node]
                step = np.where(go_left, left[node], right[node])
                node = np.where(active, step, node)
                depth += active
                active = ~leaf[node]
            mean_depth = (depth + adj[node]).sum(axis=1) / n_trees
            return pd.Series(np.power(2.0, -mean_depth / norm) if norm > 0 else np.zeros(len(x)))

        return score(*[as_double(df, c) for c in self.columns])

    def transform(self, df: DataFrame, flag_column: str = "is_outlier", score_column: str | None = None) -> DataFrame:
        if not self.trees:
            out = df.withColumn(flag_column, F.lit(False))
            return out.withColumn(score_column, F.lit(None).cast("double")) if score_column else out
        df = spread(df)
        s = self.score_column(df)
        out = df.withColumn(flag_column, s > F.lit(self.threshold))
        if score_column:
            out = out.withColumn(score_column, s)
        return out


def spread(df: DataFrame) -> DataFrame:
    """Scoring is CPU-bound Python: an input of fewer files than the cluster has
    cores (a small file is one split) is spread round-robin first.  The files are
    known to the plan, so nothing runs to find out; other inputs are left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df


def fit_isolation_forest(df: DataFrame, columns=None, n_trees: int = 100, max_samples: int = 256,
                         contamination: float = 0.1, seed: int = 42) -> IsolationForestModel:
    cols = existing(df, columns) if columns else numeric_columns(df)
    n = df.count()
    if not n:
        return IsolationForestModel(cols, {}, 0)
    psi = int(min(max_samples, n))
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    # a pool of rows drawn once, by a number of the row's own (equal rows are drawn
    # apart); each tree then draws its sample from the pool
    pool = max(64 * psi, 4096)
    rate = min(1.0, 1.25 * pool / max(n, 1))
    scale = 1 << 30
    share = min(1.0, (2.0 * psi + 64) / max(min(n, 1.25 * pool), 1))
    feats = [as_double(df, c) for c in cols]
    xs = [F.col(f"x{i}") for i in range(len(cols))]
    sample = (df.select(*[f.alias(f"x{i}") for i, f in enumerate(feats)], F.rand(seed).alias("u"))
              .where(F.col("u") < F.lit(rate))
              .select("*", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree"))
              .withColumn("h", F.xxhash64("u", F.lit(seed * 1000) + F.col("tree")))
              .where(F.pmod(F.col("h"), F.lit(scale)) < F.lit(int(share * scale)))
              .select("tree", "h", *xs))
    xcols = [f"x{i}" for i in range(len(cols))]

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("h").head(psi)
        t = int(pdf["tree"].iloc[0])
        x = np.nan_to_num(pdf[xcols].to_numpy(dtype="float64", na_value=np.nan), nan=0.0)
        rng = np.random.default_rng([seed, t])
        nodes = _grow(x, rng, max_depth)
        return pd.DataFrame([(t, *nd) for nd in nodes],
                            columns=["tree", "node", "feature", "threshold", "left", "right", "size", "leaf"])

    nodes = sample.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()   # bounded: trees × nodes
    trees = {}
    if n and nodes["tree"].nunique() != n_trees:
        raise RuntimeError(f"{nodes['tree'].nunique()} of {n_trees} trees have a sample")
    for t, g in nodes.groupby("tree"):
        g = g.sort_values("node")
        # per node: c(size) added when a walk ends there (the unbuilt part of the path)
        adj = np.array([average_path(float(n)) for n in g["size"].to_numpy()])
        trees[int(t)] = (g["feature"].to_numpy().clip(min=0), g["threshold"].to_numpy(),
                         g["left"].to_numpy(), g["right"].to_numpy(), adj, g["leaf"].to_numpy())
    model = IsolationForestModel(cols, trees, psi)
    src = spread(df.select(*cols))
    scored = src.select(model.score_column(src).alias("score"))
    model.threshold = scored.agg(F.percentile_approx("score", 1.0 - contamination, 10_000)).first()[0]
    return model
