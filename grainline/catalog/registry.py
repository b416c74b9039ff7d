"""Registry of the operator queries exposed through ``__spark_entry__``.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables (or
data Spark derives from them); ``oracle`` is the DuckDB SQL over the same
tables that must give the same rows.  Columns carry equal aliases on both
sides; floating results are rounded to ``DIGITS`` on both sides so that
summation order cannot change a hash.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"query {key} registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column (the oracle rounds the same columns).

    ``+ 0.0`` makes a rounded negative zero a plain zero on both sides (one
    engine keeps the sign of ``round(-1e-9, 6)``, the other does not)."""
    exprs = {f.name: F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0) for f in df.schema.fields
             if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(exprs) if exprs else df


def r6(expr: str) -> str:
    """SQL twin of ``rounded`` for one expression."""
    return f"(round({expr}, {DIGITS}) + 0.0)"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    from ..session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark)
    if base is None:
        raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is needed")
    return f"{base.rstrip('/')}/grainline-scratch/{label}-{uuid.uuid4().hex[:12]}"


# ---------------------------------------------------------------- planted gaps
# fixed values: how nulls are planted into the gap-free driver tables; the
# oracle SQL below uses the same rules
def events_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "ts", "user_id",
        F.when(F.col("event_id") % 11 == 0, None).otherwise(F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 7 == 0, None).otherwise(F.col("value")).alias("value"),
        "props")


EVENTS_GAPS_SQL = """(SELECT event_id, ts, user_id,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value, props FROM events)"""


def lineitem_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.withColumn("l_discount", F.when(F.col("l_linenumber") == 3, None)
                         .otherwise(F.col("l_discount")))


LINEITEM_GAPS_SQL = """(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
  l_extendedprice, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS l_discount,
  l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem)"""


def orders_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 17 == 0, None)
                        .otherwise(F.col("o_orderpriority")))


ORDERS_GAPS_SQL = """(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders)"""


def events_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with planted extremes (value * 50 every 500th id) and a constant column."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "event_type",
                    F.when(F.col("event_id") % 500 == 0, F.col("value") * 50)
                    .otherwise(F.col("value")).alias("value"),
                    F.lit(5.0).alias("const"))


EVENTS_EXTREMES_SQL = """(SELECT event_id, user_id, event_type,
  CASE WHEN event_id % 500 = 0 THEN value * 50 ELSE value END AS value,
  CAST(5.0 AS DOUBLE) AS const FROM events)"""
