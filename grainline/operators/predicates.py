"""Row filters ``{column, condition, value}``.

Null semantics follow the tool being rebuilt: ``not_equals`` keeps null rows,
every other comparison drops them.  Unknown columns, incomplete filters and
unknown conditions are no-ops.  Null tests need no value.  All filters of a
list are ANDed into one predicate so Catalyst can push it into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import and_all, is_float_type, qcol

CONDITIONS = ("equals", "not_equals", "greater_than", "less_than", "contains",
              "in", "not_null", "is_null")

# above this many values an ``in`` list becomes a broadcast left-semi join
IN_LIST_JOIN_THRESHOLD = 10_000


def condition_expr(df: DataFrame, column: str, condition: str, value=None) -> Column | None:
    """The predicate of one filter, or ``None`` when the filter is a no-op."""
    if column is None or column not in df.columns:
        return None
    c = qcol(column)
    # NaN counts as missing.  The predicates are written on the raw column (plus
    # an ``isnan`` guard where NaN would otherwise pass) so that the comparison
    # itself still reaches the Parquet reader as a pushed filter.
    floating = is_float_type(df.schema[column].dataType)
    if condition == "is_null":
        return (c.isNull() | F.isnan(c)) if floating else c.isNull()
    if condition == "not_null":
        return (c.isNotNull() & ~F.isnan(c)) if floating else c.isNotNull()
    if value is None:
        return None
    if condition == "equals":
        return c == F.lit(value)
    if condition == "not_equals":
        return ~c.eqNullSafe(F.lit(value))
    if condition == "greater_than":
        # Spark orders NaN above every number; pandas compares it as False
        return ((c > F.lit(value)) & ~F.isnan(c)) if floating else (c > F.lit(value))
    if condition == "less_than":
        return c < F.lit(value)
    if condition == "contains":
        # a regular-expression search on the string form
        return c.cast("string").rlike(str(value))
    if condition == "in":
        return c.isin(in_values(df, column, value))
    return None


def in_values(df: DataFrame, column: str, value) -> list:
    """The wanted values in the column's own kind: text columns are compared as
    text, numbers with the values that read as numbers (others match nothing)."""
    values = list(value) if isinstance(value, (list, tuple, set)) else [value]
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        return [v if v is None or isinstance(v, str) else str(v) for v in values]
    if isinstance(dtype, T.NumericType):
        out = []
        for v in values:
            try:
                out.append((int(v) if v.strip().lstrip("+-").isdigit() else float(v)) if isinstance(v, str) else v)
            except ValueError:
                continue
        return out
    return values


def apply_filters(df: DataFrame, filters: list[dict]) -> DataFrame:
    """AND all filters of a list (list order does not matter for an AND)."""
    preds = []
    big_in = []
    for f in filters or []:
        cond = f.get("condition")
        if cond == "in" and isinstance(f.get("value"), (list, tuple, set)) \
                and len(f["value"]) > IN_LIST_JOIN_THRESHOLD and f.get("column") in df.columns:
            big_in.append(f)
            continue
        p = condition_expr(df, f.get("column"), cond, f.get("value"))
        if p is not None:
            preds.append(p)
    out = df.where(and_all(preds)) if preds else df
    for f in big_in:
        out = filter_in_table(out, f["column"], in_values(out, f["column"], f["value"]))
    return out


def filter_in_table(df: DataFrame, column: str, values: list) -> DataFrame:
    """``in`` with a long list: a left-semi join against the value table.

    The list came from the driver, so its size is known; it is broadcast only
    under Spark's own size threshold, otherwise the join shuffles.
    """
    spark = df.sparkSession
    kinds = {type(v) for v in values if v is not None}
    if kinds <= {int}:
        name = "bigint" if all(v is None or -2**63 <= v < 2**63 for v in values) else None
    elif kinds <= {int, float}:
        name = "double"
    else:
        name = "string" if kinds == {str} else None
    if name is None:                  # mixed kinds: let the analyzer find the common type
        return df.where(qcol(column).isin(values))
    vals = spark.createDataFrame([(float(v) if name == "double" and v is not None else v,) for v in values],
                                 f"__in_value {name}")
    # neither side is cast here: the comparison widens both to their common type, as isin does
    return df.join(vals, qcol(column) == F.col("__in_value"), "left_semi")


def filter_rows(df: DataFrame, column: str, condition: str, value=None) -> DataFrame:
    return apply_filters(df, [{"column": column, "condition": condition, "value": value}])
