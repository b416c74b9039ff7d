from pyspark.sql import functions as F

from grainline.catalog.registry import scratch_dir
from grainline.operators import features as FE
from grainline.operators import impute as IM
from grainline.plans import history as H
from grainline.plans.runner import run_spec
from grainline.streaming import stream as ST

SF = "/root/testdata/sf0.001"


def _spec(**over):
    spec = {"name": "t",
            "extraction": {"sources": [{"name": "o", "type": "parquet", "path": f"{SF}/orders.parquet"}],
                           "filters": [{"column": "o_totalprice", "condition": "greater_than", "value": 1000}]},
            "validation": {"pre": {"schema": [{"type": "required_columns", "columns": ["o_orderkey"]}]},
                           "post": {"quality": [{"type": "uniqueness", "columns": ["o_orderkey"]}]}},
            "transformation": {"steps": [
                {"type": "clean", "config": {"drop_columns": ["o_orderpriority"]}},
                {"type": "scale", "config": {"columns": ["o_totalprice"], "method": "minmax"}}]}}
    spec.update(over)
    return spec


def test_run_success_history_and_shapes(spark):
    hist = H.History(spark, scratch_dir(spark, "t-hist"))
    ok = run_spec(spark, _spec(), history=hist)
    assert ok.success and ok.records_processed > 0
    assert ok.source_rows == {"o": spark.read.parquet(f"{SF}/orders.parquet").count()}
    assert ok.target_rows == ok.records_processed
    assert [s["type"] for s in ok.shapes] == ["clean", "scale"]
    assert ok.shapes[0]["columns_out"] == ok.shapes[0]["columns_in"] - 1
    bad = _spec()
    bad["validation"]["pre"]["schema"][0]["columns"] = ["nope"]
    failed = run_spec(spark, bad, history=hist)
    assert not failed.success and "Critical validation failed" in failed.error
    runs = hist.table("runs")
    assert runs.count() == 2
    status = {r["id"]: r for r in H.run_status(runs, hist.table("logs")).collect()}
    assert status[failed.run_id]["status"] == "failed"
    assert any(line["level"] == "ERROR" for line in status[failed.run_id]["logs"])
    assert H.recent_runs(runs, 1).count() == 1
    thr = H.run_throughput(runs.where("status = 'completed'")).first()
    assert thr["records_per_second"] > 0
    steps = {r["step"] for r in hist.table("quality").where(F.col("pipeline_run_id") == ok.run_id).collect()}
    assert steps == {"pre_validate", "post_validate"}


def test_skip_broken_step(spark):
    spec = _spec()
    spec["transformation"]["fail_on_step_error"] = False
    spec["transformation"]["steps"].insert(0, {"type": "custom", "config": {"expression": "missing_col + 1",
                                                                             "new_column": "x"}})
    res = run_spec(spark, spec)
    assert res.success and "x" not in res.data.columns


def test_fitted_operators_on_a_stream(spark):
    batch = spark.read.parquet(f"{SF}/events.parquet").withColumn(
        "value", F.when(F.col("event_id") % 7 == 0, None).otherwise(F.col("value")))
    imputer = IM.fit_imputer(batch, {"value": "median"})
    bins = FE.fit_bins_equal_frequency(batch, "value", 4)
    base = scratch_dir(spark, "t-stream")
    src = f"{base}/in"
    batch.write.parquet(src)
    stream = ST.file_stream(spark, src, batch.schema)
    ST.run_available(stream, lambda d: bins.transform(imputer.transform(d)), f"{base}/out", f"{base}/ckpt")
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == batch.count()
    assert out.where(F.col("value").isNull()).count() == 0
    assert {r[0] for r in out.select("value_binned").distinct().collect()} == {0, 1, 2, 3}


def test_stream_into_split_targets(spark):
    batch = spark.read.parquet(f"{SF}/events.parquet")
    base = scratch_dir(spark, "t-stream-split")
    batch.write.parquet(f"{base}/in")
    stream = ST.file_stream(spark, f"{base}/in", batch.schema, max_files_per_trigger=1)
    ST.run_available_to_targets(stream, lambda d: d.select("event_id", "event_type"),
                                [{"type": "split", "path": f"{base}/out", "group_by": "event_type"},
                                 {"type": "parquet", "path": f"{base}/flat"}], f"{base}/ckpt")
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == batch.count() == spark.read.parquet(f"{base}/flat").count()
    assert {r[0] for r in out.select("event_type").distinct().collect()} == \
        {r[0] for r in batch.select("event_type").distinct().collect()}


def test_template_like_spec_on_csv(spark):
    """The shape of the source tool's template: CSV in, dedupe, impute mean/mode,
    completeness check, CSV out."""
    base = scratch_dir(spark, "t-template")
    rows = [(1, "a", 1.5, 10.0, "x"), (1, "a", 1.5, 10.0, "x"), (2, "b", 2.5, None, "y"),
            (3, "c", 3.5, 30.0, None), (4, "d", 4.5, 20.0, "y")]
    spark.createDataFrame(rows, "id int, name string, value double, numeric_column double, "
                                "categorical_column string").write.option("header", "true").csv(f"{base}/in")
    spec = {
        "name": "template",
        "extraction": {"sources": [{"name": "input", "type": "csv", "path": f"{base}/in"}]},
        "validation": {"pre": {"schema": [{"type": "required_columns", "columns": ["id", "name", "value"]}],
                               "quality": [{"type": "null_check", "columns": ["id"], "critical": True}]},
                       "post": {"quality": [{"type": "completeness", "min_completeness": 95}]}},
        "transformation": {"steps": [
            {"type": "clean", "config": {"remove_duplicates": True}},
            {"type": "impute", "config": {"column_strategies": {"numeric_column": "mean",
                                                                "categorical_column": "mode"}}}]},
        "loading": {"targets": [{"type": "csv", "path": f"{base}/out"}]},
    }
    res = run_spec(spark, spec)
    assert res.success, res.error
    out = {r["id"]: r for r in spark.read.option("header", "true").csv(f"{base}/out").collect()}
    assert len(out) == 4
    assert float(out["2"]["numeric_column"]) == 20.0          # mean of 10, 30, 20 after dedupe
    assert out["3"]["categorical_column"] == "y"               # most frequent after dedupe
    assert res.source_rows == {"input": 5} and res.target_rows == 4


def test_profile_metrics_in_history(spark):
    from grainline.plans import profile as PR
    hist = H.History(spark, scratch_dir(spark, "t-qual"))
    df = spark.read.parquet(f"{SF}/orders.parquet")
    hist.record_profile("run-1", "extract", PR.profile(df))
    q = {r["metric_name"]: r["metric_value"] for r in hist.table("quality").collect()}
    assert q["duplicate_rows"] == 0.0 and q["missing_pct.o_orderkey"] == 0.0
    assert q["count.o_totalprice"] == df.count()


def test_every_step_type_through_the_runner(spark):
    spec = {
        "name": "all-steps",
        "extraction": {"sources": [{"name": "li", "type": "parquet", "path": f"{SF}/lineitem.parquet",
                                    "columns": ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount",
                                                "l_tax", "l_returnflag", "l_shipdate"]}]},
        "transformation": {"steps": [
            {"type": "clean", "config": {"remove_duplicates": True, "rename_columns": {"l_tax": "tax"}}},
            {"type": "impute", "config": {"column_strategies": {"l_discount": "median"}}},
            {"type": "feature_engineering", "config": {"features": [
                {"type": "datetime", "column": "l_shipdate", "extract_features": ["year"]},
                {"type": "binning", "column": "l_quantity", "bins": 4, "strategy": "equal_frequency"}]}},
            {"type": "outlier_detection", "config": {"columns": ["l_extendedprice"], "method": "isolation_forest",
                                                     "contamination": 0.05}},
            {"type": "encode", "config": {"columns": ["l_returnflag"], "method": "target",
                                          "target_column": "l_extendedprice"}},
            {"type": "scale", "config": {"columns": ["l_quantity", "l_extendedprice"], "method": "robust"}},
            {"type": "feature_selection", "config": {"method": "univariate", "target_column": "l_orderkey",
                                                     "problem_type": "regression", "k": 2,
                                                     "feature_columns": ["l_quantity", "l_discount", "tax"]}},
            {"type": "dimensionality_reduction", "config": {"columns": ["l_extendedprice", "l_returnflag_target_encoded"],
                                                            "n_components": 1}},
            {"type": "custom", "config": {"expression": "coalesce(l_discount, tax) * 2", "new_column": "q2"}},
        ]},
    }
    res = run_spec(spark, spec)
    assert res.success, res.error
    cols = res.data.columns
    assert {"is_outlier", "pca_component_1", "q2", "l_shipdate_year", "l_quantity_binned"} <= set(cols)
    assert "l_returnflag" not in cols and len(res.shapes) == 9
