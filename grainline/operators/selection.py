"""The ``feature_selection`` step: variance threshold and univariate F tests.

Each score table is a lazy DataFrame computed from sufficient statistics:

* variance — one ``agg(var_samp)`` over all feature columns.
* classification (ANOVA F) — ``groupBy(target).agg(count, sum x, sum x²)``
  (partial aggregation, so a dominant class costs nothing extra), then a
  second aggregate over the per-class rows; the class table never reaches
  the driver.
* regression (F of Pearson r) — one aggregate of counts, sums and
  ``covar_samp`` / ``stddev_samp`` over complete pairs.

Features are taken in blocks of ``BLOCK``: an aggregate of a block reads the columns of
that block only, so thousands of features cost one pass over the data in column slices
and no projection grows beyond what code generation takes.

``select_*`` applies a score table: it reads the few scores (one per feature)
and keeps the chosen features plus every non-feature column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import as_double, existing, numeric_columns, qcol

BLOCK = 250                     # features of one aggregate


def _features(df: DataFrame, feature_columns, target: str | None) -> list[str]:
    cols = existing(df, feature_columns) if feature_columns else numeric_columns(df)
    return [c for c in cols if c != target]


def _by_block(feats: list[str], scores, df: DataFrame) -> DataFrame:
    """``scores`` of blocks of ``BLOCK`` features, as one table."""
    blocks = [scores(feats[i:i + BLOCK]) for i in range(0, len(feats), BLOCK)]
    return reduce(DataFrame.union, blocks) if blocks else df.sparkSession.createDataFrame([], "feature string, score double")


def variance_scores(df: DataFrame, feature_columns=None, target: str | None = None) -> DataFrame:
    return _by_block(_features(df, feature_columns, target), lambda feats: _variances(df, feats), df)


def _variances(df: DataFrame, feats: list[str]) -> DataFrame:
    wide = df.agg(*[F.var_samp(as_double(df, c)).alias(f"v{i}") for i, c in enumerate(feats)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"v{i}").alias("score")) for i, c in enumerate(feats)
    ])).alias("s")).select("s.feature", "s.score")


def anova_f_scores(df: DataFrame, target: str, feature_columns=None) -> DataFrame:
    """ANOVA F per feature against a class column (rows with a null class or
    value are left out, per feature).  Two scans: grand means, then per-class
    statistics for every feature, then one aggregate over the class rows."""
    known = df.where(qcol(target).isNotNull())
    return _by_block(_features(df, feature_columns, target), lambda feats: _anova(known, df, target, feats), df)


def _anova(known: DataFrame, df: DataFrame, target: str, feats: list[str]) -> DataFrame:
    # sums of squares of centred values do not cancel; the grand means are literals
    mean = known.agg(*[F.avg(as_double(df, c)).alias(f"m{i}") for i, c in enumerate(feats)]).first()
    centred = [as_double(df, c) - F.lit(mean[f"m{i}"]).cast("double") for i, c in enumerate(feats)]
    per_class = known.groupBy(qcol(target).alias("__cls")).agg(
        *[agg for i, x in enumerate(centred) for agg in (
            F.count(x).alias(f"n{i}"), F.sum(x).alias(f"s{i}"), F.sum(x * x).alias(f"q{i}"))])
    totals = []
    for i in range(len(feats)):
        n, s_, q = F.col(f"n{i}"), F.col(f"s{i}"), F.col(f"q{i}")
        present = n > 0
        totals += [F.sum(F.when(present, n)).alias(f"N{i}"), F.count_if(present).alias(f"K{i}"),
                   F.sum(F.when(present, s_)).alias(f"S{i}"), F.sum(F.when(present, q)).alias(f"Q{i}"),
                   F.sum(F.when(present, s_ * s_ / n)).alias(f"B{i}")]
    wide = per_class.agg(*totals)
    # SSB = sum_k S_k^2/n_k - S^2/N ; SSW = Q - sum_k S_k^2/n_k
    rows = []
    for i, c in enumerate(feats):
        N, K, S, Q, B = (F.col(f"{x}{i}") for x in "NKSQB")
        ssb = B - S * S / N
        ssw = Q - B
        rows.append(F.struct(F.lit(c).alias("feature"),
                             F.try_divide(ssb / (K - 1), ssw / (N - K)).alias("score")))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.feature", "r.score")


def regression_f_scores(df: DataFrame, target: str, feature_columns=None) -> DataFrame:
    """F of Pearson r: r²/(1-r²)·(n-2) over complete (x, y) pairs."""
    return _by_block(_features(df, feature_columns, target), lambda feats: _regression(df, target, feats), df)


def _regression(df: DataFrame, target: str, feats: list[str]) -> DataFrame:
    y = as_double(df, target)
    aggs = []
    for i, c in enumerate(feats):
        x = as_double(df, c)
        both = x.isNotNull() & y.isNotNull()
        xs, ys = F.when(both, x), F.when(both, y)
        aggs += [F.count(xs).alias(f"n{i}"),
                 F.try_divide(F.covar_samp(xs, ys), F.stddev_samp(xs) * F.stddev_samp(ys)).alias(f"r{i}")]
    wide = df.agg(*aggs)
    rows = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"r{i}").alias("r"))
        for i, c in enumerate(feats)])).alias("s")).select("s.*")
    r2 = F.col("r") * F.col("r")
    return rows.select("feature", (F.try_divide(r2, 1 - r2) * (F.col("n") - 2)).alias("score"))


def _keep(df: DataFrame, feats: list[str], chosen: set[str]) -> DataFrame:
    return df.select(*[qcol(c) for c in df.columns if c not in feats or c in chosen])


def select_variance(df: DataFrame, threshold: float = 0.01, feature_columns=None, target=None) -> DataFrame:
    feats = _features(df, feature_columns, target)
    scores = {r["feature"]: r["score"] for r in variance_scores(df, feats).collect()}  # one row per feature
    return _keep(df, feats, {c for c, v in scores.items() if v is not None and v > threshold})


def top_k(scores: DataFrame, k: int) -> DataFrame:
    """Mark the ``k`` best features (ties: feature name order).  The score
    table has one row per feature, so it is read once and ranked on the
    driver instead of being recomputed for a self-join."""
    rows = scores.collect()                              # one row per feature
    ranked = sorted(rows, key=lambda r: (r["score"] is None, -(r["score"] or 0.0), r["feature"]))
    chosen = {r["feature"] for r in ranked[:k]}
    return scores.sparkSession.createDataFrame(
        [(r["feature"], r["score"], r["feature"] in chosen) for r in rows],
        "feature string, score double, selected boolean")


def select_univariate(df: DataFrame, target: str, k: int = 10, problem_type: str = "classification",
                      feature_columns=None) -> DataFrame:
    if target not in df.columns:
        return df
    feats = _features(df, feature_columns, target)
    scores = anova_f_scores(df, target, feats) if problem_type == "classification" \
        else regression_f_scores(df, target, feats)
    chosen = {r["feature"] for r in top_k(scores, min(k, len(feats))).collect() if r["selected"]}
    return _keep(df, feats, chosen)


def selection_step(df: DataFrame, config: dict) -> DataFrame:
    method = config.get("method", "variance")
    if method == "variance":
        return select_variance(df, config.get("variance_threshold", 0.01), config.get("feature_columns"),
                               config.get("target_column"))
    if method == "univariate":
        return select_univariate(df, config.get("target_column"), config.get("k", 10),
                                 config.get("problem_type", "classification"), config.get("feature_columns"))
    raise ValueError(f"unknown selection method {method!r}")
