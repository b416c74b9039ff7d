"""The ``outlier_detection`` step: IQR, z-score and isolation-forest masks,
then flag / remove / cap.

Bounds are fitted once for all columns (exact quantiles, or one
``avg``/``stddev_samp`` aggregate) and applied as literals.  The mask is the OR
over columns; a null value is never an outlier.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import as_double, existing, numeric_columns, or_all
from ..functions.stats import exact_quantiles


@dataclass
class OutlierModel:
    method: str
    bounds: dict[str, tuple]          # iqr: (lo, hi); zscore: (mean, std, threshold)

    def mask(self, df: DataFrame) -> Column:
        preds = []
        for c, b in self.bounds.items():
            if c not in df.columns:
                continue
            x = as_double(df, c)
            if self.method == "iqr":
                lo, hi = b
                if lo is None:
                    continue
                preds.append(F.coalesce((x < F.lit(lo)) | (x > F.lit(hi)), F.lit(False)))
            elif self.method == "zscore":
                mean, std, t = b
                if mean is None or std is None:
                    continue
                z = F.abs(F.try_divide(x - F.lit(mean), F.lit(std)))
                if std == 0:
                    # pandas: (x - mean) / 0 is +-inf unless x == mean
                    z = F.when(x != F.lit(mean), F.lit(float("inf")))
                preds.append(F.coalesce(z > F.lit(float(t)), F.lit(False)))
        return or_all(preds)


def fit_outliers(df: DataFrame, columns=None, method: str = "iqr", threshold: float = 3.0,
                 iqr_factor: float = 1.5, approximate: bool = False) -> OutlierModel:
    cols = existing(df, columns) if columns else numeric_columns(df)
    if method == "iqr":
        q = exact_quantiles(df, cols, [0.25, 0.75], approximate=approximate)
        bounds = {}
        for c in cols:
            q1, q3 = q[c]
            if q1 is None:
                bounds[c] = (None, None)
            else:
                iqr = q3 - q1
                bounds[c] = (q1 - iqr_factor * iqr, q3 + iqr_factor * iqr)
        return OutlierModel("iqr", bounds)
    if method == "zscore":
        aggs = []
        for i, c in enumerate(cols):
            x = as_double(df, c)
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
        row = df.agg(*aggs).first()
        return OutlierModel("zscore", {c: (row[f"m{i}"], row[f"s{i}"], threshold)
                                       for i, c in enumerate(cols)})
    raise ValueError(f"unknown outlier method {method!r}")


def cap_columns(df: DataFrame, columns, lower_percentile: float = 5, upper_percentile: float = 95,
                approximate: bool = False) -> DataFrame:
    """Clip every row of each column to its percentiles (nulls stay null)."""
    cols = existing(df, columns) if columns else numeric_columns(df)
    q = exact_quantiles(df, cols, [lower_percentile / 100.0, upper_percentile / 100.0], approximate=approximate)
    exprs = {}
    for c in cols:
        lo, hi = q[c]
        if lo is None:
            continue
        x = as_double(df, c)
        exprs[c] = F.when(x.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), x)))
    return df.withColumns(exprs) if exprs else df


def detect_outliers(df: DataFrame, columns=None, method: str = "isolation_forest", action: str = "flag",
                    threshold: float = 3.0, contamination: float = 0.1,
                    lower_percentile: float = 5, upper_percentile: float = 95,
                    flag_column: str = "is_outlier", seed: int = 42, approximate: bool = False) -> DataFrame:
    cols = existing(df, columns) if columns else numeric_columns(df)
    if not cols:
        return df
    if action == "cap":
        # the cap action clips all rows; the detection mask is not used
        return cap_columns(df, cols, lower_percentile, upper_percentile, approximate)
    if method == "isolation_forest":
        from .forest import fit_isolation_forest
        model = fit_isolation_forest(df, cols, contamination=contamination, seed=seed)
        flagged = model.transform(df, flag_column)
        if action == "flag":
            return flagged
        if action == "remove":
            return flagged.where(~F.col(flag_column)).drop(flag_column)
        raise ValueError(f"unknown outlier action {action!r}")
    mask = fit_outliers(df, cols, method, threshold, approximate=approximate).mask(df)
    if action == "flag":
        return df.withColumn(flag_column, mask)
    if action == "remove":
        return df.where(~mask)
    raise ValueError(f"unknown outlier action {action!r}")
