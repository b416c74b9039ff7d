"""The ``clean`` step: de-duplicate, drop, rename, cast, text, row filters.

De-duplication never ranks rows inside one window partition: keeping the
first (or last) row of a key is ``min`` (``max``) of a struct that leads with
the order columns, an aggregate Spark combines map-side, so a key holding a
third of the table is reduced in every task before the shuffle.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import (DIGIT_PATTERN, EDGE_WHITESPACE_PATTERN, PUNCTUATION_PATTERN,
                               WHITESPACE_RUN_PATTERN, existing, qcol)
from .predicates import apply_filters

log = logging.getLogger(__name__)


# ---------------------------------------------------------------- duplicates
def dedupe(df: DataFrame, subset: list[str] | None = None, keep: str | bool = "first",
           order_by: list[str] | None = None) -> DataFrame:
    """Drop duplicate rows on ``subset`` (default: all columns).

    ``keep='first'|'last'`` keeps the row with the smallest / largest
    ``order_by`` key (ties broken by the remaining columns, so the result is
    deterministic); without ``order_by`` any one representative is kept.
    ``keep='none'`` (or ``False``) drops every member of a duplicated group.
    """
    cols = df.columns
    subset = existing(df, subset) if subset else list(cols)
    if keep is False:
        keep = "none"
    if keep == "none":
        others = [c for c in cols if c not in subset]
        grouped = df.groupBy(*[qcol(c) for c in subset]).agg(
            F.count(F.lit(1)).alias("__dup_n"),
            *[F.any_value(qcol(c)).alias(c) for c in others])
        return grouped.where(F.col("__dup_n") == 1).select(*[qcol(c) for c in cols])
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first', 'last' or 'none', got {keep!r}")
    if not order_by or set(subset) == set(cols):
        return df.dropDuplicates(subset)
    others = [c for c in cols if c not in subset]
    packed = F.struct(*[qcol(o).alias(f"__o{i}") for i, o in enumerate(order_by)],
                      *[qcol(c).alias(c) for c in others])
    pick = F.min(packed) if keep == "first" else F.max(packed)
    grouped = df.groupBy(*[qcol(c) for c in subset]).agg(pick.alias("__row"))
    return grouped.select(*[qcol(c) if c in subset else F.col("__row").getField(c).alias(c)
                            for c in cols])


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*existing(df, columns))


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in (mapping or {}).items() if k in df.columns})


# --------------------------------------------------------------------- casts
# fixed values: dtype names accepted by the spec and their Spark types
DATE_NAMES = ("datetime", "datetime64", "datetime64[ns]", "timestamp")
DTYPE_NAMES = {
    "int": "bigint", "int64": "bigint", "int32": "int", "int16": "smallint", "int8": "tinyint",
    "float": "double", "float64": "double", "float32": "float",
    "str": "string", "string": "string", "object": "string", "category": "string",
    "bool": "boolean", "boolean": "boolean",
}

# fixed values: strftime codes and the Spark datetime pattern letters they map to
STRFTIME_TO_SPARK = {
    "%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%I": "hh", "%M": "mm",
    "%S": "ss", "%f": "SSSSSS", "%p": "a", "%b": "MMM", "%B": "MMMM", "%a": "EEE",
    "%A": "EEEE", "%j": "DDD", "%z": "Z", "%Z": "z", "%%": "%",
}


def strftime_to_spark(fmt: str) -> str:
    """Translate a strftime format into a Spark datetime pattern."""
    out, literal = [], []
    i = 0
    while i < len(fmt):
        tok = fmt[i:i + 2]
        if tok in STRFTIME_TO_SPARK:
            if literal:
                out.append("'" + "".join(literal).replace("'", "''") + "'")
                literal = []
            out.append(STRFTIME_TO_SPARK[tok])
            i += 2
        else:
            ch = fmt[i]
            if ch.isalpha():
                literal.append(ch)
            else:
                if literal:
                    out.append("'" + "".join(literal) + "'")
                    literal = []
                out.append(ch if ch != "'" else "''")
            i += 1
    if literal:
        out.append("'" + "".join(literal) + "'")
    return "".join(out)


def parse_datetime_expr(df: DataFrame, column: str, fmt: str | None = None):
    dt = df.schema[column].dataType
    c = qcol(column)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(dt, T.DateType):
        return c.cast("timestamp_ntz")
    if fmt:
        parsed = F.try_to_timestamp(c.cast("string"), F.lit(strftime_to_spark(fmt)))
    else:
        parsed = F.try_to_timestamp(c.cast("string"))
    return parsed.cast("timestamp_ntz")


def parse_datetime(df: DataFrame, column: str, fmt: str | None = None) -> DataFrame:
    """Parse a column to a timestamp; unparseable values become null."""
    if column not in df.columns:
        return df
    return df.withColumn(column, parse_datetime_expr(df, column, fmt))


def cast_columns(df: DataFrame, dtypes: dict[str, str], date_formats: dict[str, str] | None = None,
                 on_error: str = "null") -> DataFrame:
    """Convert column types.

    ``on_error='null'``: failed values become null (``try_cast``).
    ``on_error='fail'``: a failed value raises (ANSI ``cast``).
    ``on_error='keep'``: one counting job per batch of columns; a column with
    any failed value is left unconverted (the whole-column behaviour of the
    tool being rebuilt).
    """
    date_formats = date_formats or {}
    exprs = {}
    for col, name in (dtypes or {}).items():
        if col not in df.columns:
            continue
        if name in DATE_NAMES:
            exprs[col] = parse_datetime_expr(df, col, date_formats.get(col))
            continue
        target = DTYPE_NAMES.get(name, name)
        src_type = df.schema[col].dataType
        source = qcol(col)
        if target == "string" and isinstance(src_type, T.StringType):
            continue
        if on_error == "fail":
            exprs[col] = source.cast(target)
        else:
            exprs[col] = source.try_cast(target)
    if on_error == "keep" and exprs:
        # a date that cannot be read becomes null; only other casts keep the source column
        dates = {c for c in exprs if (dtypes or {})[c] in DATE_NAMES}
        checks = [F.count_if(qcol(c).isNotNull() & e.isNull()).alias(c) for c, e in exprs.items() if c not in dates]
        failed = df.agg(*checks).first().asDict() if checks else {}
        for c, n in failed.items():
            if n:
                log.warning("cast of %s left unconverted: %d values fail", c, n)
                exprs.pop(c)
    return df.withColumns(exprs) if exprs else df


# ---------------------------------------------------------------------- text
def text_op_expr(c, op: str):
    if op == "lowercase":
        return F.lower(c)
    if op == "uppercase":
        return F.upper(c)
    if op == "strip":
        return F.regexp_replace(c, EDGE_WHITESPACE_PATTERN, "")
    if op == "remove_punctuation":
        return F.regexp_replace(c, PUNCTUATION_PATTERN, "")
    if op == "remove_digits":
        return F.regexp_replace(c, DIGIT_PATTERN, "")
    if op == "remove_extra_spaces":
        return F.regexp_replace(c, WHITESPACE_RUN_PATTERN, " ")
    raise ValueError(f"unknown text operation {op!r}")


def clean_text(df: DataFrame, column: str, operations: list[str]) -> DataFrame:
    """Apply text operations in order; null stays null."""
    if column not in df.columns:
        return df
    e = qcol(column)
    if not isinstance(df.schema[column].dataType, T.StringType):
        e = e.cast("string")
    for op in operations:
        e = text_op_expr(e, op)
    return df.withColumn(column, e)


# ---------------------------------------------------------------------- step
def clean_step(df: DataFrame, config: dict) -> DataFrame:
    """The whole ``clean`` step in its fixed order."""
    if config.get("remove_duplicates"):
        df = dedupe(df, config.get("duplicate_subset"), config.get("duplicate_keep", "first"),
                    config.get("order_by"))
    if config.get("drop_columns"):
        df = drop_columns(df, config["drop_columns"])
    if config.get("rename_columns"):
        df = rename_columns(df, config["rename_columns"])
    if config.get("dtype_conversions"):
        df = cast_columns(df, config["dtype_conversions"], config.get("date_format"),
                          config.get("on_cast_error", "keep"))
    for col, ops in (config.get("text_cleaning") or {}).items():
        df = clean_text(df, col, ops)
    if config.get("row_filters"):
        df = apply_filters(df, config["row_filters"])
    return df

