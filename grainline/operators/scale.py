"""The ``scale`` step: standard, min-max and robust scaling, and the inverse.

A fit is one aggregate job over all chosen columns (exact quantiles for the
robust scaler take a few more bounded passes); the fitted numbers come back
as a small ``ScaleModel`` and are applied as literals, so ``transform`` is a
pure projection that also works on a stream.  ``model.to_frame(spark)``
gives the parameters as a table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import as_double, existing, numeric_columns
from ..functions.stats import exact_quantiles


@dataclass
class ScaleModel:
    method: str
    columns: list[str]
    # per column: (center, scale) so that y = (x - center) / scale, or for
    # min-max y = (x - lo) * factor + range_low
    params: dict[str, dict] = field(default_factory=dict)
    feature_range: tuple[float, float] = (0.0, 1.0)

    def transform(self, df: DataFrame) -> DataFrame:
        exprs = {}
        for c in self.columns:
            if c not in df.columns:
                continue
            x = as_double(df, c)
            p = self.params[c]
            exprs[c] = (x - F.lit(p["center"])) / F.lit(p["scale"])
            if self.method == "minmax":
                exprs[c] = exprs[c] + F.lit(self.feature_range[0])
        return df.withColumns(exprs) if exprs else df

    def inverse(self, df: DataFrame) -> DataFrame:
        exprs = {}
        for c in self.columns:
            if c not in df.columns:
                continue
            y = as_double(df, c)
            p = self.params[c]
            if self.method == "minmax":
                y = y - F.lit(self.feature_range[0])
            exprs[c] = y * F.lit(p["scale"]) + F.lit(p["center"])
        return df.withColumns(exprs) if exprs else df

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(self.method, c, float(self.params[c]["center"]), float(self.params[c]["scale"]))
                for c in self.columns]
        return spark.createDataFrame(rows, "method string, column string, center double, scale double")


def fit_scaler(df: DataFrame, columns: list[str] | None = None, method: str = "standard",
               feature_range=(0.0, 1.0), approximate: bool = False) -> ScaleModel:
    cols = existing(df, columns) if columns else numeric_columns(df)
    params: dict[str, dict] = {}
    if method == "standard":
        aggs = []
        for i, c in enumerate(cols):
            x = as_double(df, c)
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
        row = df.agg(*aggs).first() if cols else None
        for i, c in enumerate(cols):
            m, s = row[f"m{i}"], row[f"s{i}"]
            params[c] = {"center": m if m is not None else 0.0,
                         "scale": s if s else 1.0}
    elif method == "minmax":
        lo_r, hi_r = feature_range
        aggs = []
        for i, c in enumerate(cols):
            x = as_double(df, c)
            aggs += [F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}")]
        row = df.agg(*aggs).first() if cols else None
        for i, c in enumerate(cols):
            a, b = row[f"a{i}"], row[f"b{i}"]
            if a is None:
                a, b = 0.0, 1.0
            rng = (b - a) if b != a else 1.0
            # y = (x - a) / rng * (hi - lo) + lo  ==  (x - a) / (rng / (hi - lo)) + lo
            params[c] = {"center": a, "scale": rng / (hi_r - lo_r)}
    elif method == "robust":
        q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], approximate=approximate)
        for c in cols:
            q1, med, q3 = q[c]
            if med is None:
                params[c] = {"center": 0.0, "scale": 1.0}
                continue
            iqr = q3 - q1
            params[c] = {"center": med, "scale": iqr if iqr != 0 else 1.0}
    else:
        raise ValueError(f"unsupported scaling method: {method!r}")
    return ScaleModel(method, cols, params, tuple(feature_range))


def scale(df: DataFrame, columns: list[str] | None = None, method: str = "standard",
          feature_range=(0.0, 1.0), approximate: bool = False) -> DataFrame:
    return fit_scaler(df, columns, method, feature_range, approximate).transform(df)

