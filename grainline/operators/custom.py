"""The ``custom`` step, re-aimed from Python ``eval`` to Spark SQL text.

* ``custom_column`` — ``withColumn(new, expr(text))``: the expression stays in
  Catalyst (pushdown, codegen) instead of running row-by-row in Python.
* ``custom_table`` — ``spark.sql(text, args, data=df)``: the current table is
  bound as ``{data}``, so joins, grouping, windows and set operations are all
  available to the user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def custom_column(df: DataFrame, expression: str, new_column: str) -> DataFrame:
    if not expression:
        return df
    return df.withColumn(new_column, F.expr(expression))


def custom_table(df: DataFrame, query: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Run ``query`` with ``{data}`` bound to ``df`` (and any other named frames)."""
    spark = df.sparkSession
    kwargs = {"data": df, **frames}
    if args:
        return spark.sql(query, args=args, **kwargs)
    return spark.sql(query, **kwargs)


def custom_step(df: DataFrame, config: dict) -> DataFrame:
    if config.get("query"):
        return custom_table(df, config["query"], config.get("args"))
    return custom_column(df, config.get("expression"), config.get("new_column", "custom_feature"))
