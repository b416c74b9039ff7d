"""The flagship query: one real preparation chain end to end.

lineitem → filter (quantity > 10) → ratio and product features → ship-date
parts → standard scaling of the price → IQR outlier flag on price and ratio.
Two fit jobs (scale moments, IQR quantile brackets), everything else is one
projection over a pruned, filter-pushed Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import features as FE
from ..operators import outliers as O
from ..operators import predicates as P
from ..operators import scale as S
from .registry import table


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    df = P.filter_rows(li, "l_quantity", "greater_than", 10)
    df = FE.arithmetic_feature(df, "price_per_discount", "ratio", ["l_extendedprice", "l_discount"])
    df = FE.arithmetic_feature(df, "tax_discount_product", "product", ["l_tax", "l_discount"])
    df = FE.datetime_features(df, "l_shipdate", ["year", "month", "dayofweek", "is_weekend"])
    df = S.scale(df, ["l_extendedprice"], "standard")
    return O.detect_outliers(df, ["l_extendedprice", "price_per_discount"], method="iqr", action="flag")
