from grainline.plans import profile as PR
from grainline.plans import rules as R


def test_rule_suite_rows_and_failures(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (2, "c", None)], "id int, s string, v double")
    cfg = {
        "schema": [{"type": "required_columns", "columns": ["id", "zz"]}, {"type": "bogus"}],
        "quality": [{"type": "uniqueness", "columns": ["id"]},
                    {"type": "regex_pattern", "columns": ["s"], "pattern": "("},
                    {"type": "completeness", "min_completeness": 50}],
        "business": [{"name": "bad_sql", "expression": "no_such_col > 1"},
                     {"name": "pos", "expression": "v > 0"}],
        "statistical": [{"type": "correlation", "columns": ["id", "v"]}],
    }
    res = {r["rule"]: r for r in R.validate(df, cfg).collect()}
    assert not res["schema_required_columns"]["passed"] and res["schema_required_columns"]["critical"]
    assert not res["schema_bogus"]["passed"]
    assert res["quality_uniqueness"]["metric"] == 1.0
    assert not res["quality_regex_pattern"]["passed"]
    assert res["quality_completeness"]["passed"]
    assert not res["bad_sql"]["passed"] and "error" in res["bad_sql"]["message"]
    assert res["pos"]["metric"] == 1.0
    results = R.validate(df, cfg)
    gate = R.first_critical_failure(results).collect()
    assert gate[0]["rule"] == "schema_required_columns"
    s = R.summary(results).first()
    assert s["total_rules"] == 8 and s["passed_rules"] + s["failed_rules"] == 8


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "b")], "x int, s string")
    assert PR.profile_duplicates(df).first()["duplicate_rows"] == 1
    miss = {r["column"]: r["missing_count"] for r in PR.profile_missing(df).collect()}
    assert miss == {"x": 0, "s": 1, "*": 1}
    cat = PR.profile_categorical(df).first()
    assert (cat["unique_count"], cat["most_frequent"]) == (2, "a")
    num = {r["stat"]: r["value"] for r in PR.profile_numeric(df).collect()}
    assert num["50%"] == 1.5 and num["count"] == 4


def test_uniqueness_approximate_option(spark):
    df = spark.range(5000).selectExpr("id", "id % 100 AS g")
    exact = R.validate(df, {"quality": [{"type": "uniqueness", "columns": ["g"]}]}).first()
    approx = R.validate(df, {"quality": [{"type": "uniqueness", "columns": ["g"], "approximate": True}]}).first()
    assert exact["metric"] == 4900
    assert abs(approx["metric"] - 4900) <= 5


def test_rules_ride_on_a_write(spark):
    from grainline.catalog.registry import scratch_dir
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    cfg = {"schema": [{"type": "required_columns", "columns": ["event_id"]}],
           "quality": [{"type": "null_check", "columns": ["value"]},
                       {"type": "value_range", "columns": ["value"], "min_value": 0, "max_value": 100}],
           "business": [{"name": "pos", "expression": "value > 0"},
                        {"name": "total", "expression": "sum(value) > 0", "aggregate": True}],
           "statistical": [{"type": "distribution", "column": "value", "expected_mean": 50}]}
    observed, results = R.observe_rules(df, cfg)
    observed.write.parquet(scratch_dir(spark, "t-observe"))
    got = [(r["rule"], r["passed"], r["metric"]) for r in results().orderBy("pos").collect()]
    want = [(r["rule"], r["passed"], r["metric"]) for r in R.validate(df, cfg).orderBy("pos").collect()]
    assert got == want
    import pytest
    with pytest.raises(ValueError):
        R.observe_rules(df, {"quality": [{"type": "uniqueness", "columns": ["event_id"]}]})


def test_fused_profile_equals_single_profiles(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    fused = PR.profile(df)
    single = {"basic": PR.profile_basic(df), "missing": PR.profile_missing(df),
              "duplicates": PR.profile_duplicates(df), "numeric": PR.profile_numeric(df),
              "categorical": PR.profile_categorical(df), "top_values": PR.profile_top_values(df)}
    for name, frame in single.items():
        assert sorted(map(tuple, fused[name].collect())) == sorted(map(tuple, frame.collect())), name
