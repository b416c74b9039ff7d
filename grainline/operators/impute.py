"""The ``impute`` step.

Strategies run per column in spec order (a ``drop`` changes the statistics of
later columns).  Runs of mean / median / mode / constant columns between two
drops share their fit jobs: one ``agg`` for every mean, one exact-quantile
search for every median, one partial count per mode column.  Fitted values
are applied as literals (``coalesce``), so the result is a projection.
Forward / backward fill use the two-level ordered fill (no single-task
window); they need an explicit ``order_by`` because Spark rows have no order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import as_double, clean_value, is_numeric_type, qcol
from ..functions.ordering import ordered_fill
from ..functions.stats import column_modes, exact_quantiles
from .predicates import apply_filters, filter_rows

FIT_STRATEGIES = ("mean", "median", "mode", "constant")


@dataclass
class ImputeModel:
    """Fill value per column; ``transform`` is a stream-safe projection."""
    values: dict[str, object] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        exprs = {}
        for c, v in self.values.items():
            if c not in df.columns or v is None:
                continue
            exprs[c] = fill_expr(df, c, v)
        return df.withColumns(exprs) if exprs else df

    def to_frame(self, spark):
        return spark.createDataFrame([(c, None if v is None else str(v)) for c, v in self.values.items()],
                                     "column string, fill_value string")


def fill_expr(df: DataFrame, column: str, value):
    """``coalesce(column, value)`` with the type rules of a fill: an integral
    column keeps its type for an integral value, a fractional value makes it
    double, and a value of another kind turns the column into text."""
    dt = df.schema[column].dataType
    c = clean_value(df, column)
    numeric_value = isinstance(value, (int, float)) and not isinstance(value, bool)
    if numeric_value and is_numeric_type(dt):
        if isinstance(value, int) and isinstance(dt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            return F.coalesce(c, F.lit(value).cast(dt))
        return F.coalesce(c.cast("double"), F.lit(float(value)))
    if isinstance(dt, T.StringType):
        return F.coalesce(c, F.lit(str(value)))
    if not numeric_value and isinstance(value, type(None)):
        return c
    return F.coalesce(c.cast("string"), F.lit(str(value)))


def fit_imputer(df: DataFrame, strategies: dict[str, str], fill_values: dict | None = None,
                approximate: bool = False) -> ImputeModel:
    """Fit mean / median / mode / constant fills for the given columns."""
    fill_values = fill_values or {}
    cols = {s: [c for c, st in strategies.items() if st == s and c in df.columns] for s in FIT_STRATEGIES}
    values: dict[str, object] = {}
    # one job: null counts of every column (columns without nulls are left
    # untouched, types included) and every mean
    fitted = [c for s in FIT_STRATEGIES for c in cols[s]]
    mean_cols = list(cols["mean"])
    aggs = [F.count_if(clean_value(df, c).isNull()).alias(f"z{i}") for i, c in enumerate(fitted)]
    aggs += [F.avg(as_double(df, c)).alias(f"m{i}") for i, c in enumerate(mean_cols)]
    row = df.agg(*aggs).first() if aggs else None
    has_null = {c for i, c in enumerate(fitted) if row[f"z{i}"] > 0}
    cols = {s: [c for c in cs if c in has_null] for s, cs in cols.items()}
    values.update({c: row[f"m{i}"] for i, c in enumerate(mean_cols) if c in has_null})
    if cols["median"]:
        q = exact_quantiles(df, cols["median"], [0.5], approximate=approximate)
        values.update({c: q[c][0] for c in cols["median"]})
    if cols["mode"]:
        values.update(column_modes(df, cols["mode"]))
    for c in cols["constant"]:
        values[c] = fill_values.get(c, 0)
    return ImputeModel({c: values[c] for c in strategies if c in values})


def impute(df: DataFrame, column_strategies: dict[str, str], fill_values: dict | None = None,
           global_strategy: str | None = None, order_by: list[str] | None = None,
           partition_by: list[str] | None = None, knn_neighbors: int = 5,
           approximate: bool = False) -> DataFrame:
    """The whole ``impute`` step."""
    pending: dict[str, str] = {}

    def flush(d):
        if pending:
            d = fit_imputer(d, dict(pending), fill_values, approximate).transform(d)
            pending.clear()
        return d

    for c, strategy in (column_strategies or {}).items():
        if c not in df.columns:
            continue
        if strategy in FIT_STRATEGIES:
            pending[c] = strategy
            continue
        df = flush(df)
        if strategy == "drop":
            df = filter_rows(df, c, "not_null")
        elif strategy in ("forward_fill", "backward_fill"):
            if not order_by:
                raise ValueError(f"{strategy} of {c} needs order_by: Spark rows have no order")
            df = ordered_fill(df.withColumn(c, clean_value(df, c)), [c], order_by, partition_by,
                              "forward" if strategy == "forward_fill" else "backward")
        elif strategy == "knn":
            from .knn import impute_knn
            df = impute_knn(df, target=c, k=knn_neighbors)
        else:
            raise ValueError(f"unknown imputation strategy {strategy!r} for {c}")
    df = flush(df)
    if global_strategy == "drop_rows":
        df = drop_rows_with_nulls(df)
    elif global_strategy == "drop_columns":
        df = drop_columns_with_nulls(df)
    elif global_strategy:
        raise ValueError(f"unknown global strategy {global_strategy!r}")
    return df


def drop_rows_with_nulls(df: DataFrame) -> DataFrame:
    """Drop rows holding any null (NaN counts as null)."""
    return apply_filters(df, [{"column": c, "condition": "not_null"} for c in df.columns])


def drop_columns_with_nulls(df: DataFrame) -> DataFrame:
    """Drop every column holding a null: one counting job, then a projection."""
    row = df.agg(*[F.count_if(clean_value(df, c).isNull()).alias(f"n{i}")
                   for i, c in enumerate(df.columns)]).first()
    keep = [c for i, c in enumerate(df.columns) if row[f"n{i}"] == 0]
    return df.select(*[qcol(c) for c in keep])
