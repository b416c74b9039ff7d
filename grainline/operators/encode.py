"""The ``encode`` step: label, one-hot and target encoding.

* label — the sorted distinct values get codes 0..n-1 by the two-level global
  numbering (no one-task window over the dictionary), then a lookup join that
  is broadcast only under a counted size.
* one-hot — schema depends on the data, so the distinct values are fetched
  eagerly, bounded by ``max_categories`` (an error above it, never a silent
  cut); each dummy is ``coalesce(col = v, false)``.
* target — ``groupBy(category).avg(target)`` (combined map-side) joined back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import as_double, existing, qcol, string_columns
from ..functions.joins import join_lookup
from ..functions.ordering import global_row_number

MISSING_LABEL = "nan"   # fixed value: text form a missing category takes before label encoding
MAX_CATEGORIES = 1000


def _columns(df: DataFrame, columns) -> list[str]:
    return existing(df, columns) if columns else string_columns(df)


# -------------------------------------------------------------------- label
@dataclass
class LabelModel:
    column: str
    dictionary: DataFrame      # (value string, code int)
    size: int

    def transform(self, df: DataFrame) -> DataFrame:
        key = "__label_key"
        d = self.dictionary.withColumnRenamed("value", key).withColumnRenamed("code", "__label_code")
        keyed = df.withColumn(key, F.coalesce(qcol(self.column).cast("string"), F.lit(MISSING_LABEL)))
        joined = join_lookup(keyed, d, key, "left", self.size)
        cols = [F.col("__label_code").alias(self.column) if c == self.column else qcol(c)
                for c in df.columns]
        return joined.select(*cols)


def fit_label(df: DataFrame, column: str) -> LabelModel:
    values = (df.select(F.coalesce(qcol(column).cast("string"), F.lit(MISSING_LABEL)).alias("value"))
              .distinct())
    numbered, size = global_row_number(values, ["value"], name="code", with_total=True)
    dictionary = numbered.select("value", (F.col("code") - 1).cast("int").alias("code"))
    return LabelModel(column, dictionary, size)


def encode_label(df: DataFrame, columns=None) -> DataFrame:
    for c in _columns(df, columns):
        df = fit_label(df, c).transform(df)
    return df


# ------------------------------------------------------------------ one-hot
def category_values(df: DataFrame, column: str, max_categories: int = MAX_CATEGORIES) -> list:
    vals = (df.where(qcol(column).isNotNull()).select(qcol(column).alias("v")).distinct()
            .limit(max_categories + 1).collect())
    if len(vals) > max_categories:
        raise ValueError(f"{column} has more than {max_categories} categories; "
                         "raise max_categories, or encode it sparse")
    return sorted(r["v"] for r in vals)


def encode_onehot_sparse(df: DataFrame, columns=None, drop_first: bool = False, suffix: str = "_onehot") -> DataFrame:
    """One column ``{c}_onehot`` per input instead of one per category: a struct
    ``(size, index)``, the position of the one that is set among ``size`` categories in
    sorted order (null where none is: a missing value, or the first category under
    ``drop_first``).  The categories stay in a table: any number of them encodes."""
    for c in _columns(df, columns):
        name = f"{c}{suffix}"
        if name.lower() in {x.lower() for x in df.columns if x != c}:
            raise ValueError(f"column {name} exists already; choose another suffix")
        values = df.where(qcol(c).isNotNull()).select(qcol(c).alias("value")).distinct()
        numbered, size = global_row_number(values, ["value"], name="code", with_total=True)
        first = 2 if drop_first else 1
        table = numbered.where(F.col("code") >= first).select(F.col("value").alias("__oh_value"),
                                                              (F.col("code") - first).cast("int").alias("__oh_code"))
        joined = join_lookup(df, table, qcol(c) == F.col("__oh_value"), "left")
        hot = F.struct(F.lit(max(0, size - first + 1)).cast("int").alias("size"), F.col("__oh_code").alias("index")).alias(name)
        df = joined.select(*[qcol(x) for x in df.columns if x != c], hot)
    return df


def encode_onehot(df: DataFrame, columns=None, prefix: str | None = None, drop_first: bool = False,
                  max_categories: int = MAX_CATEGORIES) -> DataFrame:
    """One boolean column per category.  More than ``max_categories`` raise: that many
    columns make no usable table, ``encode_onehot_sparse`` has no such bound."""
    cols = _columns(df, columns)
    if cols:
        # one HyperLogLog pass over all columns first: a column with millions of
        # values fails here, before an exact distinct would shuffle all of them
        approx = df.agg(*[F.approx_count_distinct(qcol(c), 0.02).alias(f"a{i}")
                          for i, c in enumerate(cols)]).first()
        for i, c in enumerate(cols):
            if approx[f"a{i}"] > max_categories * 1.1:
                raise ValueError(f"{c} has about {approx[f'a{i}']} categories (more than {max_categories}); "
                                 "raise max_categories, or encode it sparse")
    for c in cols:
        cats = category_values(df, c, max_categories)
        if drop_first:
            cats = cats[1:]
        p = prefix or c
        dummies = {f"{p}_{v}": F.coalesce(qcol(c) == F.lit(v), F.lit(False)) for v in cats}
        rest = [x for x in df.columns if x != c]
        clash = {x.lower() for x in rest} & {x.lower() for x in dummies}
        if clash:
            raise ValueError(f"columns {sorted(clash)} exist already; choose another prefix")
        df = df.select(*[qcol(x) for x in rest], *[e.alias(n) for n, e in dummies.items()])
    return df


# ------------------------------------------------------------------- target
def encode_target(df: DataFrame, columns=None, target_column: str | None = None,
                  drop_original: bool = True) -> DataFrame:
    if not target_column or target_column not in df.columns:
        return df
    for c in _columns(df, columns):
        if c == target_column:
            continue
        means = (df.where(qcol(c).isNotNull()).groupBy(qcol(c).alias("__te_key"))
                 .agg(F.avg(as_double(df, target_column)).alias(f"{c}_target_encoded")))
        # one row per category: AQE broadcasts it at run time when it is small
        joined = join_lookup(df, means, qcol(c) == F.col("__te_key"), "left").drop("__te_key")
        if drop_original:
            joined = joined.drop(c)
        df = joined
    return df


def encode_step(df: DataFrame, config: dict) -> DataFrame:
    method = config.get("method", "onehot")
    cols = config.get("columns")
    if method == "label":
        return encode_label(df, cols)
    if method == "onehot" and config.get("sparse"):
        return encode_onehot_sparse(df, cols, config.get("drop_first", False))
    if method == "onehot":
        return encode_onehot(df, cols, config.get("prefix"), config.get("drop_first", False),
                             config.get("max_categories", MAX_CATEGORIES))
    if method == "target":
        return encode_target(df, cols, config.get("target_column"), config.get("drop_original", True))
    raise ValueError(f"unknown encoding method {method!r}")
