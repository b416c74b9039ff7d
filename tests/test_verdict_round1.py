"""Cases that earlier versions answered wrongly."""

import pytest
from pyspark.sql import functions as F


@pytest.mark.parametrize("limit", [50_000, 20])
def test_quantiles_of_two_heavy_values(spark, limit):
    from grainline.functions.stats import exact_quantiles
    df = spark.range(0, 13_000_000, numPartitions=8).select((F.col("id") % 2).cast("double").alias("x"))
    assert exact_quantiles(df, ["x"], [0.25, 0.5, 0.75], collect_limit=limit)["x"] == [0.0, 0.5, 1.0]


def test_quantiles_gather_many_columns(spark):
    from grainline.functions.stats import exact_quantiles
    df = spark.range(0, 20_001).select(*[(F.col("id") * (i + 1) % 20_001).cast("double").alias(f"c{i}") for i in range(12)])
    got = exact_quantiles(df, [f"c{i}" for i in range(12)], [0.5], accuracy=50, collect_limit=100)
    assert all(v[0] == sorted(k * (i + 1) % 20_001 for k in range(20_001))[10_000] for i, v in enumerate(got.values()))


def test_paged_schema_of_all_pages(spark):
    from grainline.sources.misc import paged_records
    pages = spark.createDataFrame([(1, '{"data":[{"a":1},{"a":2}]}'), (2, '{"data":[{"a":2.5,"b":"x"}]}')], "page int, body string")
    got = {(r.a, r.b) for r in paged_records(pages, page_size=2).collect()}
    assert got == {(1.0, None), (2.0, None), (2.5, "x")}


def test_long_in_list_keeps_fractions(spark):
    from grainline.operators.predicates import filter_rows
    df = spark.createDataFrame([(1,), (2,), (30_000,)], "a bigint")
    short, long = [1.5, 2.0], [1.5, 2.0] + [float(i) + 0.5 for i in range(20_000)]
    assert [r.a for r in filter_rows(df, "a", "in", short).collect()] == [r.a for r in filter_rows(df, "a", "in", long).collect()] == [2]


def test_forest_on_repeated_rows(spark):
    from grainline.operators.forest import fit_isolation_forest
    df = spark.range(0, 200_000).select((F.col("id") % 5).cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("y"))
    assert len(fit_isolation_forest(df, ["x", "y"]).trees) == 100


def test_mode_of_large_longs_and_nan(spark):
    from grainline.functions.stats import column_modes
    df = spark.createDataFrame([(9007199254740993, float("nan"))] * 3 + [(1, 1.0)] * 2, "a bigint, b double")
    assert column_modes(df, ["a", "b"]) == {"a": 9007199254740993, "b": 1.0}


def test_anova_does_not_cancel(spark):
    from grainline.operators.selection import anova_f_scores
    rows = [(i % 3, (i * 7 % 11) + (i % 3) * 2.0) for i in range(60)]
    a = anova_f_scores(spark.createDataFrame(rows, "k int, x double"), "k", ["x"]).first().score
    b = anova_f_scores(spark.createDataFrame([(k, x + 1e9) for k, x in rows], "k int, x double"), "k", ["x"]).first().score
    assert a == pytest.approx(b, rel=1e-6)


def test_flat_spec_and_empty_input(spark):
    from grainline.plans.runner import apply_step
    df = spark.createDataFrame([(1, "a"), (1, "a")], "x int, y string")
    flat = apply_step(df, {"type": "clean", "drop_columns": ["y"]})
    assert flat.columns == apply_step(df, {"type": "clean", "config": {"drop_columns": ["y"]}}).columns


def test_json_keeps_null_keys(spark, tmp_path):
    from grainline.sinks.writers import write_json
    path = f"file:{tmp_path}/out"
    write_json(spark.createDataFrame([(1, None)], "a int, b string"), path)
    assert spark.read.text(path).first().value == '{"a":1,"b":null}'


def test_csv_na_values_with_schema(spark, tmp_path):
    from grainline.sources.files import read_csv
    spark.createDataFrame([("a,b",), ("1,x",), ("-999,missing",)], "value string").coalesce(1).write.text(f"file:{tmp_path}/c")
    got = read_csv(spark, f"file:{tmp_path}/c", na_values=["-999", "missing"], schema="a int, b string")
    assert got.dtypes == [("a", "int"), ("b", "string")] and sorted(map(tuple, got.collect()), key=str) == [(1, "x"), (None, None)]


def test_first_rows_read_only_the_first_files(spark, tmp_path):
    from grainline.sources.files import read_parquet_first_rows
    spark.range(0, 100, numPartitions=5).write.parquet(f"file:{tmp_path}/p")
    got = read_parquet_first_rows(spark, f"file:{tmp_path}/p", 25)
    assert [r.id for r in got.collect()] == list(range(25)) and len(got.inputFiles()) == 3


def test_lookup_broadcast_by_bytes(spark):
    from grainline.functions.joins import join_lookup
    df = spark.range(10)
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    small = spark.range(5).selectExpr("id", "id * 2L AS v")
    assert "broadcast" in plan(join_lookup(df, small, "id", lookup_rows=5))
    assert "broadcast" not in plan(join_lookup(df, small, "id", lookup_rows=3_000_000))
    assert "broadcast" not in plan(join_lookup(df, small.selectExpr("id", "cast(v AS string) AS v"), "id", lookup_rows=5))
