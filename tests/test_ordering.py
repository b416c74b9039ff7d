import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from grainline.functions.ordering import global_row_number, numbered_within, ordered_fill


def _frame(spark, n=3000, hot=True):
    rng = np.random.default_rng(5)
    keys = np.where(rng.random(n) < (0.34 if hot else 0.0), 0, rng.integers(1, 40, n))
    vals = np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n))
    pdf = pd.DataFrame({"id": np.arange(n), "k": keys, "t": rng.integers(0, 500, n), "v": vals})
    df = spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None).cast("double")))
    return df, pdf.sort_values(["t", "id"])


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("direction", ["forward", "backward"])
@pytest.mark.parametrize("buckets", [9, 300])          # CASE-tree buckets / range partitions
def test_fill_matches_pandas_with_hot_key(spark, keys, direction, buckets):
    df, pdf = _frame(spark)
    got = ordered_fill(df, ["v"], ["t", "id"], keys, direction, n_buckets=buckets).toPandas() \
        .sort_values(["t", "id"])
    g = pdf.groupby("k")["v"] if keys else pdf["v"]
    ref = g.ffill() if direction == "forward" else g.bfill()
    a, r = got["v"].to_numpy(), ref.to_numpy()
    assert np.all((a == r) | (np.isnan(a.astype(float)) & np.isnan(r)))


@pytest.mark.parametrize("buckets", [7, 300])
def test_global_row_number(spark, buckets):
    df, pdf = _frame(spark)
    got = global_row_number(df, ["t", "id"], n_buckets=buckets).toPandas().sort_values(["t", "id"])
    assert (got["row_pos"].to_numpy() == np.arange(1, len(got) + 1)).all()


def test_fill_plan_has_no_single_partition_exchange(spark):
    df, _ = _frame(spark)
    plan = ordered_fill(df, ["v"], ["t", "id"], [], "forward", n_buckets=5)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_backward_fill_reads_each_row_once(spark, keys):
    """No frame that shrinks row by row (quadratic in a bucket): each frame grows from the first row."""
    df, _ = _frame(spark)
    plan = ordered_fill(df, ["v"], ["t", "id"], keys, "backward", n_buckets=5)._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "unboundedpreceding$(), currentrow$()" in plan and "unboundedfollowing" not in plan


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("direction", ["forward", "backward"])
def test_fill_scans_summary_in_levels(spark, keys, direction):
    """40 buckets scanned in groups of 3: four levels, long gaps that cross buckets and groups."""
    df, pdf = _frame(spark)
    df = df.withColumn("v", F.when((F.col("t") % 100) < 4, F.col("v")))
    pdf = pdf.assign(v=pdf["v"].where(pdf["t"] % 100 < 4))
    got = ordered_fill(df, ["v"], ["t", "id"], keys, direction, n_buckets=40, width=3).toPandas().sort_values(["t", "id"])
    g = pdf.groupby("k")["v"] if keys else pdf["v"]
    ref = (g.ffill() if direction == "forward" else g.bfill()).to_numpy()
    a = got["v"].to_numpy().astype(float)
    assert np.all((a == ref) | (np.isnan(a) & np.isnan(ref)))


def test_numbering_scans_summary_in_levels(spark):
    df, _ = _frame(spark)
    got, total = global_row_number(df, ["t", "id"], n_buckets=50, width=2, with_total=True)
    pos = got.toPandas().sort_values(["t", "id"])["row_pos"].to_numpy()
    assert total == len(pos) and (pos == np.arange(1, len(pos) + 1)).all()


def test_numbered_within_hot_and_null_keys(spark):
    df, pdf = _frame(spark)
    df = df.withColumn("k", F.when(F.col("k") != 3, F.col("k")))
    got = numbered_within(df, ["k"], ["t", "id"], n_buckets=30, width=4).toPandas().sort_values(["t", "id"])
    want = pdf.groupby(pdf["k"].where(pdf["k"] != 3).fillna(-1)).cumcount().to_numpy() + 1
    assert (got["row_pos"].to_numpy() == want).all()


def test_ordering_edges(spark):
    """Empty table, repeated and null rows, a map column, names that clash with the helper's own."""
    rows = [(None, None, {"a": 1}), (1, 2.0, None), (1, 2.0, None), (2, None, {"b": 2})]
    df = spark.createDataFrame(rows, "`__bucket` int, `c0` double, `__at` map<string,int>")
    assert sorted(r["n"] for r in global_row_number(df, ["__bucket"], "n", n_buckets=3).collect()) == [1, 2, 3, 4]
    out = ordered_fill(df, ["c0"], ["__bucket"], n_buckets=3)
    assert out.columns == df.columns and sorted(r["c0"] or 0 for r in out.collect()) == [0, 2.0, 2.0, 2.0]
    empty = df.limit(0)
    assert global_row_number(empty, ["__bucket"], with_total=True)[1] == 0
    assert ordered_fill(empty, ["c0"], ["__bucket"], ["__at"][:0]).count() == 0
    assert numbered_within(empty, ["c0"], ["__bucket"]).count() == 0
