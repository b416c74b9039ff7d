"""Column-expression helpers shared by every operator.

Everything here returns a ``Column`` so that operators stay inside
whole-stage codegen; nothing leaves the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: regular expressions that give the results of the Unicode-aware
# Python patterns of the tool being rebuilt (\w, \d, \s, str.strip, str.split).
# Python's whitespace (str.isspace) is Unicode White_Space plus U+001C..U+001F.
# Spark (Java regex): the (?U) flag makes \s Unicode White_Space and keeps the
# engine's fast path; the four separators are added to the class.
PUNCTUATION_PATTERN = r"(?U)[^\p{L}\p{N}_\s\x{1C}-\x{1F}]"           # Python [^\w\s]
DIGIT_PATTERN = r"\p{Nd}"                                             # Python \d
WHITESPACE_RUN_PATTERN = r"(?U)[\s\x{1C}-\x{1F}]+"                     # Python \s+
EDGE_WHITESPACE_PATTERN = r"(?U)^[\s\x{1C}-\x{1F}]+|[\s\x{1C}-\x{1F}]+$"  # str.strip()
WORD_PATTERN = r"(?U)[^\s\x{1C}-\x{1F}]+"                             # tokens of str.split()
UPPER_ASCII_PATTERN = r"[A-Z]"
# The same sets for engines without the (?U) flag (RE2, used by the SQL oracles):
# every whitespace character spelled out.
PY_SPACE = (r"\t\n\x0B\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
SQL_PUNCTUATION_PATTERN = r"[^\p{L}\p{N}_" + PY_SPACE + "]"
SQL_WHITESPACE_RUN_PATTERN = "[" + PY_SPACE + "]+"
SQL_EDGE_WHITESPACE_PATTERN = "^[" + PY_SPACE + "]+|[" + PY_SPACE + "]+$"
SQL_WORD_PATTERN = "[^" + PY_SPACE + "]+"
# small constant added to divisors by ratio-style features
RATIO_EPSILON = 1e-8


def is_numeric_type(dt: T.DataType) -> bool:
    """Numeric in the pandas ``select_dtypes(number)`` sense: booleans excluded."""
    return isinstance(dt, T.NumericType)


def is_float_type(dt: T.DataType) -> bool:
    return isinstance(dt, (T.FloatType, T.DoubleType))


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if is_numeric_type(f.dataType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def existing(df: DataFrame, columns) -> list[str]:
    have = set(df.columns)
    return [c for c in (columns or []) if c in have]


def qcol(name: str) -> Column:
    """Column by exact name, safe for names holding dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_value(df: DataFrame, name: str) -> Column:
    """The column with NaN mapped to null (pandas treats NaN as missing)."""
    c = qcol(name)
    if is_float_type(df.schema[name].dataType):
        return F.nanvl(c, F.lit(None).cast(df.schema[name].dataType))
    return c


def as_double(df: DataFrame, name: str) -> Column:
    """Numeric column as double with NaN normalised to null."""
    c = qcol(name).cast("double")
    if is_float_type(df.schema[name].dataType):
        return F.nanvl(c, F.lit(None).cast("double"))
    return c


def normalize_nan(df: DataFrame, columns=None) -> DataFrame:
    """Replace NaN by null in float columns (ingest normalisation)."""
    cols = [f.name for f in df.schema.fields if is_float_type(f.dataType)]
    if columns is not None:
        cols = [c for c in cols if c in set(columns)]
    if not cols:
        return df
    return df.withColumns({c: clean_value(df, c) for c in cols})


def row_sum(cols: list[Column]) -> Column:
    """Row-wise sum skipping nulls; all null gives 0 (pandas ``sum(axis=1)``)."""
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cols])


def row_count_present(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])


def row_product(cols: list[Column]) -> Column:
    """Row-wise product skipping nulls; all null gives 1."""
    return reduce(lambda a, b: a * b, [F.coalesce(c, F.lit(1)) for c in cols])


def row_max(cols: list[Column]) -> Column:
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def row_min(cols: list[Column]) -> Column:
    return cols[0] if len(cols) == 1 else F.least(*cols)


def and_all(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def or_all(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)
