"""Table profiles as long-form DataFrames.

Each profile is a handful of fused aggregates; only aggregate values (a few
per column) reach the driver.  The top-values profile is a union of one
``groupBy(value).count()`` + ``orderBy(count desc, value).limit(k)`` per
column — Spark plans that as a partial count and a per-partition top-k
(``TakeOrderedAndProject``), so no value table is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import as_double, clean_value, numeric_columns, qcol, string_columns
from ..functions.stats import column_modes, exact_quantiles

NUMERIC_STATS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")


def profile_basic(df: DataFrame) -> DataFrame:
    n = df.count()
    rows = [("rows", None, str(n)), ("columns", None, str(len(df.columns)))]
    rows += [("dtype", f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "metric string, column string, value string")


def profile_missing(df: DataFrame) -> DataFrame:
    """Null count and percentage per column, plus a ``*`` total row."""
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(clean_value(df, c).isNull()).alias(f"z{i}") for i, c in enumerate(df.columns)]
                 ).first()
    n = row["__n"]
    rows = [(c, row[f"z{i}"], (100.0 * row[f"z{i}"] / n) if n else None) for i, c in enumerate(df.columns)]
    rows.append(("*", sum(r[1] for r in rows), None))
    return df.sparkSession.createDataFrame(rows, "column string, missing_count bigint, missing_percentage double")


def profile_duplicates(df: DataFrame) -> DataFrame:
    """Rows equal to an earlier row, and their share."""
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 F.count_distinct(F.struct(*[qcol(c) for c in df.columns])).alias("d")).first()
    n, d = row["n"], row["d"]
    return df.sparkSession.createDataFrame(
        [(n - d, (100.0 * (n - d) / n) if n else 0.0)],
        "duplicate_rows bigint, duplicate_percentage double")


def profile_numeric(df: DataFrame, columns=None) -> DataFrame:
    """describe(): count, mean, std (sample), min, quartiles (exact), max."""
    cols = columns or numeric_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, stat string, value double")
    aggs = {}
    for i, c in enumerate(cols):
        x = as_double(df, c)
        aggs.update({f"c{i}": F.count(x), f"m{i}": F.avg(x), f"s{i}": F.stddev_samp(x),
                     f"lo{i}": F.min(x), f"hi{i}": F.max(x)})
    row: dict = {}
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], extra=aggs, extra_out=row)   # moments ride along
    rows = []
    for i, c in enumerate(cols):
        vals = [row[f"c{i}"], row[f"m{i}"], row[f"s{i}"], row[f"lo{i}"], *q[c], row[f"hi{i}"]]
        rows += [(c, s, None if v is None else float(v)) for s, v in zip(NUMERIC_STATS, vals)]
    return df.sparkSession.createDataFrame(rows, "column string, stat string, value double")


def profile_categorical(df: DataFrame, columns=None) -> DataFrame:
    """Distinct count and most frequent value (smallest on ties) per text column."""
    cols = columns or string_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, unique_count bigint, most_frequent string")
    distinct: dict = {}
    modes = column_modes(df, cols, distinct_out=distinct)      # one job: modes and distinct counts
    rows = [(c, distinct.get(c, 0), modes[c]) for c in cols]
    return df.sparkSession.createDataFrame(rows, "column string, unique_count bigint, most_frequent string")


def profile_top_values(df: DataFrame, columns=None, k: int = 10, salt: int = 64) -> DataFrame:
    """Top ``k`` values with counts per text column (ties: smaller value first).

    One scan for all columns: ``(column, value)`` pairs are counted by one
    partial aggregation; the top-k is then taken in two window levels — first
    per ``(column, hash(value) % salt)``, then per column over at most
    ``k × salt`` survivors — so no task ranks all distinct values of a column.
    """
    cols = columns or string_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string, count bigint")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), qcol(c).cast("string").alias("value"))
                                for c in cols])).alias("p")
    counts = (df.select(pairs).select("p.column", "p.value").where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")))
    order = [F.desc("count"), F.asc("value")]
    local = Window.partitionBy("column", F.pmod(F.xxhash64("value"), F.lit(salt))).orderBy(*order)
    final = Window.partitionBy("column").orderBy(*order)
    first = counts.withColumn("r", F.row_number().over(local)).where(F.col("r") <= k).drop("r")
    return first.withColumn("r", F.row_number().over(final)).where(F.col("r") <= k).drop("r")


def profile(df: DataFrame) -> dict[str, DataFrame]:
    """All profiles of a table with the scans fused: one aggregate pass holds the
    row count, every null count, the distinct-row count, the numeric moments and
    the quantile sketches (one more bounded pass finishes the quantiles); modes
    with distinct counts take one job per type family; top values one job."""
    spark = df.sparkSession
    cols = df.columns
    nums, texts = numeric_columns(df), string_columns(df)
    extra = {"__n": F.count(F.lit(1)), "__d": F.count_distinct(F.struct(*[qcol(c) for c in cols]))}
    extra.update({f"z{i}": F.count_if(clean_value(df, c).isNull()) for i, c in enumerate(cols)})
    for i, c in enumerate(nums):
        x = as_double(df, c)
        extra.update({f"c{i}": F.count(x), f"m{i}": F.avg(x), f"s{i}": F.stddev_samp(x),
                      f"lo{i}": F.min(x), f"hi{i}": F.max(x)})
    v: dict = {}
    if nums:
        q = exact_quantiles(df, nums, [0.25, 0.5, 0.75], extra=extra, extra_out=v)
    else:
        q = {}
        row = df.agg(*[e.alias(k) for k, e in extra.items()]).first()
        v = {k: row[k] for k in extra}
    n = v["__n"]
    basic = [("rows", None, str(n)), ("columns", None, str(len(cols)))]
    basic += [("dtype", f.name, f.dataType.simpleString()) for f in df.schema.fields]
    missing = [(c, v[f"z{i}"], (100.0 * v[f"z{i}"] / n) if n else None) for i, c in enumerate(cols)]
    missing.append(("*", sum(r[1] for r in missing), None))
    dups = n - v["__d"]
    numeric = []
    for i, c in enumerate(nums):
        vals = [v[f"c{i}"], v[f"m{i}"], v[f"s{i}"], v[f"lo{i}"], *q[c], v[f"hi{i}"]]
        numeric += [(c, st, None if x is None else float(x)) for st, x in zip(NUMERIC_STATS, vals)]
    distinct: dict = {}
    modes = column_modes(df, texts, distinct_out=distinct) if texts else {}
    return {
        "basic": spark.createDataFrame(basic, "metric string, column string, value string"),
        "missing": spark.createDataFrame(missing, "column string, missing_count bigint, missing_percentage double"),
        "duplicates": spark.createDataFrame([(dups, (100.0 * dups / n) if n else 0.0)],
                                            "duplicate_rows bigint, duplicate_percentage double"),
        "numeric": spark.createDataFrame(numeric, "column string, stat string, value double"),
        "categorical": spark.createDataFrame([(c, distinct.get(c, 0), modes[c]) for c in texts],
                                             "column string, unique_count bigint, most_frequent string"),
        "top_values": profile_top_values(df, texts) if texts
        else spark.createDataFrame([], "column string, value string, count bigint"),
    }
