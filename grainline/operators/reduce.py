"""The ``dimensionality_reduction`` step: PCA on centred, unscaled columns.

Fit = one job for the means and the scatter matrix of the complete rows
(``functions.gram``: blockwise partials of Arrow batches, merged in a tree), then
an eigen-decomposition of the d×d matrix on the driver, the same split Spark ML's
PCA uses.  The plan is the same for two columns and for thousands.  Components follow the usual sign rule (largest
absolute loading positive).  ``transform`` is a projection
``Σ (x_i - mean_i) · v_ij``: whole-stage codegen, stream-safe.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import and_all, as_double, existing, numeric_columns, qcol
from ..functions.gram import scatter


@dataclass
class PCAModel:
    columns: list[str]
    means: list[float]
    components: np.ndarray          # (n_components, d)
    explained_variance_ratio: list[float]
    prefix: str = "pca_component_"

    def projection(self, df: DataFrame):
        out = {}
        for j, comp in enumerate(self.components):
            terms = [(as_double(df, c) - F.lit(m)) * F.lit(float(w))
                     for c, m, w in zip(self.columns, self.means, comp)]
            e = terms[0]
            for t in terms[1:]:
                e = e + t
            out[f"{self.prefix}{j + 1}"] = e
        return out

    def transform(self, df: DataFrame, drop_inputs: bool = True) -> DataFrame:
        comps = self.projection(df)
        keep = [qcol(c) for c in df.columns if not (drop_inputs and c in self.columns)]
        return df.select(*keep, *[e.alias(n) for n, e in comps.items()])

    def components_frame(self, spark) -> DataFrame:
        rows = [(j + 1, c, float(w), float(self.explained_variance_ratio[j]))
                for j, comp in enumerate(self.components) for c, w in zip(self.columns, comp)]
        return spark.createDataFrame(rows, "component int, column string, loading double, explained_variance_ratio double")


def fit_pca(df: DataFrame, columns=None, n_components: int = 2) -> PCAModel | None:
    cols = existing(df, columns) if columns else numeric_columns(df)
    if not cols or len(cols) < n_components:
        return None
    complete = df.where(and_all([as_double(df, c).isNotNull() for c in cols]))
    n, means, scattered = scatter(complete.select(*[as_double(complete, c).alias(f"x{i}") for i, c in enumerate(cols)]))
    cov = scattered / max(n - 1, 1)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    vals, vecs = vals[order], vecs[:, order]
    comps = vecs[:, :n_components].T.copy()
    for k in range(comps.shape[0]):
        if comps[k, np.argmax(np.abs(comps[k]))] < 0:
            comps[k] = -comps[k]
    total = float(np.sum(np.clip(vals, 0, None)))
    ratio = [float(max(v, 0.0) / total) if total > 0 else 0.0 for v in vals[:n_components]]
    return PCAModel(cols, [float(m) for m in means], comps, ratio)


def pca(df: DataFrame, columns=None, n_components: int = 2) -> DataFrame:
    model = fit_pca(df, columns, n_components)
    return df if model is None else model.transform(df)
