"""The ``feature_engineering`` step: arithmetic, datetime, text, interaction,
binning and polynomial features.

All features except binning are row-local expressions (stream-safe).  Binning
fits edges with one aggregate (min/max, or exact quantiles) and then applies a
right-closed indexer ``size(filter(edges, e -> e < x)) - 1`` — Spark's
``width_bucket`` / ``Bucketizer`` are left-closed and cannot be used.
"""

from __future__ import annotations

import itertools
import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import (DIGIT_PATTERN, PUNCTUATION_PATTERN, RATIO_EPSILON,
                               UPPER_ASCII_PATTERN, WORD_PATTERN, as_double, clean_value, existing,
                               qcol, row_count_present, row_max, row_min, row_product, row_sum)
from ..functions.stats import exact_quantiles
from .clean import parse_datetime_expr

log = logging.getLogger(__name__)


# ----------------------------------------------------------------- arithmetic
def arithmetic_expr(df: DataFrame, operation: str, columns: list[str]) -> Column | None:
    cols = [clean_value(df, c) for c in columns]
    if not cols:
        return None
    if operation == "sum":
        return row_sum(cols)
    if operation == "mean":
        return F.try_divide(row_sum(cols), F.nullif(row_count_present(cols), F.lit(0)))
    if operation == "difference" and len(cols) >= 2:
        return cols[0] - cols[1]
    if operation == "ratio" and len(cols) >= 2:
        return F.try_divide(cols[0], cols[1] + F.lit(RATIO_EPSILON))
    if operation == "product":
        return row_product(cols)
    if operation == "max":
        return row_max(cols)
    if operation == "min":
        return row_min(cols)
    return None


def arithmetic_feature(df: DataFrame, name: str, operation: str, columns: list[str]) -> DataFrame:
    e = arithmetic_expr(df, operation, columns)
    return df if e is None else df.withColumn(name, e)


# ------------------------------------------------------------------- datetime
DATETIME_PARTS = ("year", "month", "day", "dayofweek", "quarter", "hour", "minute", "is_weekend")


def datetime_features(df: DataFrame, column: str, extract=("year", "month", "day")) -> DataFrame:
    """Columns ``{column}_{part}``; the column itself becomes a timestamp.

    ``dayofweek`` counts Monday as 0; ``is_weekend`` of a null time is 0.
    """
    if column not in df.columns:
        return df
    ts = parse_datetime_expr(df, column)
    df = df.withColumn(column, ts)
    c = qcol(column)
    parts = {
        "year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c),
        "dayofweek": F.weekday(c), "quarter": F.quarter(c), "hour": F.hour(c),
        "minute": F.minute(c),
        "is_weekend": F.coalesce((F.weekday(c) >= 5).cast("int"), F.lit(0)),
    }
    return df.withColumns({f"{column}_{p}": parts[p] for p in extract if p in parts})


# ----------------------------------------------------------------------- text
TEXT_FEATURES = ("length", "word_count", "char_count", "uppercase_count", "digit_count",
                 "punctuation_count")


def text_features(df: DataFrame, column: str, extract=("length",)) -> DataFrame:
    """Columns ``{column}_{feature}``; a null text gives null features."""
    if column not in df.columns:
        return df
    c = qcol(column).cast("string")
    exprs = {
        "length": F.length(c),
        "word_count": F.regexp_count(c, F.lit(WORD_PATTERN)),
        "char_count": F.length(F.replace(c, F.lit(" "), F.lit(""))),
        "uppercase_count": F.regexp_count(c, F.lit(UPPER_ASCII_PATTERN)),
        "digit_count": F.regexp_count(c, F.lit(DIGIT_PATTERN)),
        "punctuation_count": F.regexp_count(c, F.lit(PUNCTUATION_PATTERN)),
    }
    return df.withColumns({f"{column}_{f}": exprs[f] for f in extract if f in exprs})


# ---------------------------------------------------------------- interaction
def interaction_features(df: DataFrame, columns: list[str], interaction_type: str = "multiply") -> DataFrame:
    """Every pair i<j of existing columns: ``{a}_{type}_{b}``."""
    cols = existing(df, columns)
    if len(columns or []) < 2:
        return df
    exprs = {}
    for a, b in itertools.combinations(cols, 2):
        ca, cb = clean_value(df, a), clean_value(df, b)
        if interaction_type == "multiply":
            e = ca * cb
        elif interaction_type == "add":
            e = ca + cb
        elif interaction_type == "subtract":
            e = ca - cb
        elif interaction_type == "divide":
            e = F.try_divide(ca, cb + F.lit(RATIO_EPSILON))
        else:
            continue
        exprs[f"{a}_{interaction_type}_{b}"] = e
    return df.withColumns(exprs) if exprs else df


# -------------------------------------------------------------------- binning
@dataclass
class BinModel:
    column: str
    edges: list[float]          # right-closed intervals (e[i], e[i+1]]; lowest edge included
    labels: list | None = None
    name: str | None = None
    include_lowest: bool = False

    def bin_expr(self, df: DataFrame) -> Column:
        x = as_double(df, self.column)
        edges = F.array(*[F.lit(float(e)) for e in self.edges])
        n_bins = len(self.edges) - 1
        idx = F.size(F.filter(edges, lambda e: e < x)) - 1
        low = F.lit(float(self.edges[0]))
        inside = ((x >= low) if self.include_lowest else (x > low)) & (x <= F.lit(float(self.edges[-1])))
        code = F.when(x.isNotNull() & inside, F.greatest(F.lit(0), F.least(idx, F.lit(n_bins - 1))))
        if self.labels:
            # guard the lookup: element_at with a null index does not give null here
            return F.when(code.isNotNull(), F.element_at(F.array(*[F.lit(v) for v in self.labels]), code + 1))
        return code.cast("int")

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.name or f"{self.column}_binned", self.bin_expr(df))


def fit_bins_equal_width(df: DataFrame, column: str, bins=5, labels=None, name=None) -> BinModel:
    """Edges of ``pandas.cut``: n equal bins, the lowest edge widened by 0.1 %.

    ``bins`` may also be an explicit list of edges (values outside → null).
    """
    if isinstance(bins, (list, tuple)):
        return BinModel(column, [float(b) for b in bins], labels, name)
    x = as_double(df, column)
    row = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx")).first()
    mn, mx = row["mn"], row["mx"]
    if mn is None:
        return BinModel(column, [0.0, 0.0], labels, name)
    if mn == mx:
        pad = 0.001 * abs(mn) if mn != 0 else 0.001
        mn, mx = mn - pad, mx + pad
        edges = [mn + (mx - mn) * i / bins for i in range(bins + 1)]
    else:
        edges = [mn + (mx - mn) * i / bins for i in range(bins + 1)]
        edges[0] = mn - (mx - mn) * 0.001
    return BinModel(column, edges, labels, name)


def fit_bins_equal_frequency(df: DataFrame, column: str, bins=5, labels=None, name=None,
                             approximate: bool = False) -> BinModel:
    """Edges of ``pandas.qcut``: exact quantiles, duplicate edges dropped."""
    probs = [i / bins for i in range(bins + 1)] if isinstance(bins, int) else list(bins)
    q = exact_quantiles(df, [column], probs, approximate=approximate)[column]
    if q[0] is None:
        return BinModel(column, [0.0, 0.0], labels, name)
    edges = sorted(set(q))
    return BinModel(column, edges, labels, name, include_lowest=True)


def binned_feature(df: DataFrame, column: str, bins=5, strategy: str = "equal_width",
                   labels=None, name=None) -> DataFrame:
    if column not in df.columns:
        return df
    if strategy == "equal_width":
        model = fit_bins_equal_width(df, column, bins, labels, name)
    elif strategy == "equal_frequency":
        model = fit_bins_equal_frequency(df, column, bins, labels, name)
    else:
        raise ValueError(f"unknown binning strategy {strategy!r}")
    return model.transform(df)


# ----------------------------------------------------------------- polynomial
def polynomial_features(df: DataFrame, columns: list[str], degree: int = 2,
                        include_bias: bool = False) -> DataFrame:
    """Monomials of degree 2..``degree`` named like ``a^2`` and ``a b``.

    Degree-1 terms are the inputs themselves and are not repeated; ``1`` is
    added with ``include_bias``.  A null input makes the monomials null.
    """
    cols = existing(df, columns)
    if not cols:
        return df
    exprs = {}
    if include_bias:
        exprs["1"] = F.lit(1.0)
    for d in range(2, degree + 1):
        for combo in itertools.combinations_with_replacement(range(len(cols)), d):
            counts = {}
            for i in combo:
                counts[i] = counts.get(i, 0) + 1
            name = " ".join(cols[i] if k == 1 else f"{cols[i]}^{k}" for i, k in sorted(counts.items()))
            e = None
            for i in combo:
                term = as_double(df, cols[i])
                e = term if e is None else e * term
            exprs[name] = e
    return df.withColumns(exprs)


# ----------------------------------------------------------------------- step
def feature_step(df: DataFrame, config: dict, on_error: str = "fail") -> DataFrame:
    """Run each feature in order.  ``on_error='skip'`` skips a feature whose
    plan cannot be analysed (Spark is lazy: run-time errors still fail)."""
    for f in config.get("features", []):
        try:
            df = _one_feature(df, f)
        except Exception as exc:  # noqa: BLE001 - policy decides
            if on_error != "skip":
                raise
            log.warning("feature %s skipped: %s", f.get("name"), exc)
    return df


def _one_feature(df: DataFrame, f: dict) -> DataFrame:
    t = f.get("type")
    if t == "arithmetic":
        return arithmetic_feature(df, f.get("name"), f.get("operation"), f.get("columns", []))
    if t == "datetime":
        return datetime_features(df, f.get("column"), f.get("extract_features", ["year", "month", "day"]))
    if t == "text":
        return text_features(df, f.get("column"), f.get("extract_features", ["length"]))
    if t == "interaction":
        return interaction_features(df, f.get("columns", []), f.get("interaction_type", "multiply"))
    if t == "binning":
        return binned_feature(df, f.get("column"), f.get("bins", 5), f.get("strategy", "equal_width"),
                              f.get("labels"), f.get("name"))
    if t == "polynomial":
        return polynomial_features(df, f.get("columns", []), f.get("degree", 2), f.get("include_bias", False))
    return df

