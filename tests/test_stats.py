import math

import numpy as np
import pytest

from grainline.functions.stats import column_modes, exact_quantiles


def test_quantiles_match_numpy_with_ties_nulls_nan(spark):
    rng = np.random.default_rng(3)
    vals = [float(v) for v in rng.integers(0, 50, 3000)] + [None] * 40 + [float("nan")] * 7
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0, 0.3333]
    clean = np.array([v for v in vals if v is not None and not math.isnan(v)])
    ref = np.quantile(clean, probs)
    for limit in (50_000, 10):          # gather path and narrowing path
        got = exact_quantiles(df, ["x"], probs, collect_limit=limit)["x"]
        assert np.allclose(got, ref, rtol=0, atol=1e-12)


def test_quantiles_hot_value_third_of_rows(spark):
    vals = [7.0] * 1000 + [float(v) for v in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = exact_quantiles(df, ["x"], [0.1, 0.5, 0.9], collect_limit=20)["x"]
    assert np.allclose(got, np.quantile(vals, [0.1, 0.5, 0.9]))


def test_quantiles_empty_and_single(spark):
    df = spark.createDataFrame([(None, 4.0)], "a double, b double")
    q = exact_quantiles(df, ["a", "b"], [0.25, 0.5])
    assert q["a"] == [None, None]
    assert q["b"] == [4.0, 4.0]


def test_mode_smallest_of_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,), (None,), (None,)], "k string")
    assert column_modes(df, ["k"]) == {"k": "a"}


def test_approximate_option_is_close(spark):
    df = spark.range(100000).selectExpr("CAST(id AS DOUBLE) AS x")
    exact = exact_quantiles(df, ["x"], [0.25, 0.5, 0.75])["x"]
    approx = exact_quantiles(df, ["x"], [0.25, 0.5, 0.75], approximate=True)["x"]
    assert all(abs(a - e) <= 100000 / 10_000 + 1 for a, e in zip(approx, exact))


def test_many_columns_in_one_counting_pass(spark):
    """100 columns, ties and heavy values: equal to numpy, and few jobs."""
    rng = np.random.default_rng(12)
    X = np.round(rng.normal(size=(400, 100)), 1)
    X[:140, ::3] = 0.5                                     # a third of the rows on one value
    X[rng.random(X.shape) < 0.05] = np.nan
    cols = [f"c{i}" for i in range(100)]
    df = spark.createDataFrame([tuple(None if np.isnan(x) else float(x) for x in r) for r in X],
                               ", ".join(f"{c} double" for c in cols))
    got = exact_quantiles(df, cols, [0.25, 0.5, 0.9], accuracy=50)
    for i, c in enumerate(cols):
        assert np.allclose(got[c], np.nanquantile(X[:, i], [0.25, 0.5, 0.9]), atol=1e-12)
