"""Edge tables (FIXTURES §4): null, NaN, tiny values, constant column, one row, empty."""

import math

import pytest
from pyspark.sql import functions as F

from grainline.operators import encode as E
from grainline.operators import features as FE
from grainline.operators import impute as I
from grainline.operators import outliers as O
from grainline.operators import scale as S
from grainline.plans import profile as PR
from grainline.plans import rules as R
from grainline.sources import files as SF

ROWS = [(1, None, 1.0, 5), (2, float("nan"), 2.0, 5), (3, 0.0, 3.0, 5), (4, -1e-8, 4.0, 5), (5, -3.0, 5.0, 5)]
SCHEMA = "id int, a double, b double, c int"


@pytest.fixture(params=["full", "one", "empty"])
def edge_numeric(spark, request):
    rows = {"full": ROWS, "one": ROWS[2:3], "empty": []}[request.param]
    return spark.createDataFrame(rows, SCHEMA)


def test_fitted_operators_survive_edge_tables(spark, edge_numeric):
    df = edge_numeric
    for method in ("standard", "minmax", "robust"):
        S.scale(df, ["a", "b", "c"], method).collect()
    I.impute(df, {"a": "mean", "b": "median", "c": "mode"}).collect()
    for method in ("iqr", "zscore"):
        O.detect_outliers(df, ["a", "b", "c"], method=method, action="flag").collect()
    O.detect_outliers(df, ["a", "b"], method="iqr", action="cap").collect()
    FE.binned_feature(df, "a", 3, "equal_width").collect()
    FE.binned_feature(df, "a", 3, "equal_frequency").collect()
    PR.profile_numeric(df).collect()
    PR.profile_missing(df).collect()
    R.validate(df, {"quality": [{"type": "completeness"}, {"type": "uniqueness", "columns": ["id"]}],
                    "statistical": [{"type": "distribution", "column": "a", "expected_mean": 0},
                                    {"type": "correlation", "columns": ["a", "b"]},
                                    {"type": "outliers", "columns": ["a", "b"]}]}).collect()


def test_nan_is_missing(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    filled = {r["id"]: r["a"] for r in I.impute(df, {"a": "mean"}).collect()}
    mean = (0.0 - 1e-8 - 3.0) / 3
    assert math.isclose(filled[1], mean) and math.isclose(filled[2], mean)
    miss = {r["column"]: r["missing_count"] for r in PR.profile_missing(df).collect()}
    assert miss["a"] == 2
    assert O.detect_outliers(df, ["a"], "zscore", "flag").where("is_outlier").count() == 0


def test_constant_column_scaling(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = S.scale(df, ["c"], "standard").select("c").distinct().collect()
    assert [r[0] for r in out] == [0.0]
    out = S.scale(df, ["c"], "minmax").select("c").distinct().collect()
    assert [r[0] for r in out] == [0.0]


def test_edge_text_and_time(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "   "), (4, "nan"), (5, "2024-02-29 10:00:00"),
                                (6, "not a date")], "id int, s string")
    out = {r["id"]: r for r in FE.datetime_features(df, "s", ["year", "dayofweek", "is_weekend"]).collect()}
    assert out[5]["s_year"] == 2024 and out[5]["s_dayofweek"] == 3 and out[6]["s_year"] is None
    assert out[1]["s_is_weekend"] == 0
    labels = {r["id"]: r["s"] for r in E.encode_label(df, ["s"]).collect()}
    assert labels[1] == labels[4]              # a missing value is the class "nan"


def test_json_records_single_object_and_missing_key(spark, tmp_path_factory):
    from grainline.catalog.registry import scratch_dir
    path = scratch_dir(spark, "t-json")
    spark.createDataFrame([('{"resp": {"data": {"v": 1, "w": {"x": 2}}}}',)], "value string").write.text(path)
    out = SF.read_json_records(spark, path, "resp.data")
    assert out.columns == ["v", "w.x"] and out.collect()[0]["w.x"] == 2
    with pytest.raises(Exception):
        SF.read_json_records(spark, path, "resp.nope")


def test_onehot_refuses_high_cardinality_before_collecting(spark):
    df = spark.range(5000).selectExpr("CAST(id AS STRING) AS k")
    with pytest.raises(ValueError):
        E.encode_onehot(df, ["k"], max_categories=100)
