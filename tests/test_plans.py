"""Plan checks: pushdown, pruning, fused rule jobs."""

from pyspark.sql import functions as F

from grainline.catalog.flagship import flagship
from grainline.plans import rules as R


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_pushes_filter_and_prunes(spark):
    plan = _plan(flagship(spark, "/root/testdata/sf0.001"))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "l_returnflag" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_rule_suite_is_one_aggregate_job(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    cfg = {"quality": [{"type": "null_check", "columns": ["value"]}, {"type": "uniqueness", "columns": ["event_id"]},
                       {"type": "completeness"}, {"type": "value_range", "columns": ["value"], "min_value": 0}],
           "business": [{"name": "pos", "expression": "value > 0"}],
           "statistical": [{"type": "distribution", "column": "value", "expected_mean": 100}]}
    # count the actions the suite runs over the data (AQE splits one query into
    # several job ids, so actions are counted, not jobs)
    DataFrame = type(df)
    calls = []
    original = DataFrame.first

    def counting_first(self):
        calls.append(1)
        return original(self)

    DataFrame.first = counting_first
    try:
        rows = R.validate(df, cfg).collect()
    finally:
        DataFrame.first = original
    assert len(rows) == 6
    assert len(calls) == 1
