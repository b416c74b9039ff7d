"""Queries for validation rules and profiles."""

from __future__ import annotations

from ..plans import profile as PR
from ..plans import rules as R
from .registry import (EVENTS_EXTREMES_SQL, EVENTS_GAPS_SQL, ORDERS_GAPS_SQL, events_extremes,
                       events_gaps, orders_gaps, register, rounded, table)

EG = EVENTS_GAPS_SQL
OG = ORDERS_GAPS_SQL
EX = EVENTS_EXTREMES_SQL
RESULT_COLS = ["rule", "category", "type", "passed", "critical", "metric", "threshold"]


def _res_sql(rule, category, rtype, passed, critical, metric, threshold, source):
    thr = "CAST(NULL AS DOUBLE)" if threshold is None else f"CAST({threshold} AS DOUBLE)"
    return (f"SELECT '{rule}' AS rule, '{category}' AS category, '{rtype}' AS type, {passed} AS passed, "
            f"{critical} AS critical, (round(CAST({metric} AS DOUBLE), 6) + 0.0) AS metric, {thr} AS threshold "
            f"FROM {source}")


def _val(key, loader, config, sql):
    def q(spark, sf):
        return rounded(R.validate(loader(spark, sf), config).select(*RESULT_COLS))
    register(key, sql)(q)


def _tbl(name):
    return lambda spark, sf: table(spark, sf, name)


# fixed values: DuckDB type names → the Spark type families of the column-type rule
DUCK_FAMILY = """CASE WHEN data_type IN ('BIGINT', 'INTEGER', 'SMALLINT', 'TINYINT') THEN 'int'
  WHEN data_type IN ('DOUBLE', 'FLOAT') THEN 'float' WHEN data_type = 'VARCHAR' THEN 'string'
  WHEN data_type LIKE 'TIMESTAMP%' OR data_type = 'DATE' THEN 'datetime'
  WHEN data_type = 'BOOLEAN' THEN 'bool' END"""
DUCK_SPARK_TYPE = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
  WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(data_type) END"""

# ------------------------------------------------------------------- schema
_val("val_required_columns", _tbl("events"),
     {"schema": [{"type": "required_columns", "name": "req", "columns": ["event_id", "ts", "value", "no_such"]}]},
     _res_sql("req", "schema", "required_columns", "m = 0", "true", "m", 0, """(SELECT count(*) AS m FROM
       (VALUES ('event_id'), ('ts'), ('value'), ('no_such')) v(c) WHERE c NOT IN
       (SELECT column_name FROM information_schema.columns WHERE table_name = 'events'))"""))

_val("val_column_types", _tbl("events"),
     {"schema": [{"type": "column_types", "name": "types",
                  "types": {"event_id": "int", "ts": "datetime", "value": "float", "event_type": "int",
                            "user_id": "int64", "gone": "int"}}]},
     _res_sql("types", "schema", "column_types", "m = 0", "false", "m", 0, f"""(SELECT count(*) AS m FROM
       (VALUES ('event_id', 'int'), ('ts', 'datetime'), ('value', 'float'), ('event_type', 'int'),
               ('user_id', 'int')) e(c, fam)
       JOIN information_schema.columns i ON i.column_name = e.c AND i.table_name = 'events'
       WHERE fam IS DISTINCT FROM {DUCK_FAMILY})"""))

_val("val_column_count", _tbl("events"),
     {"schema": [{"type": "column_count", "name": "ncols", "min": 3, "max": 5}]},
     _res_sql("ncols", "schema", "column_count", "m BETWEEN 3 AND 5", "false", "m", 3,
              "(SELECT count(*) AS m FROM information_schema.columns WHERE table_name = 'events')"))

_val("val_row_count", _tbl("lineitem"),
     {"schema": [{"type": "row_count", "name": "nrows", "min": 1000}]},
     _res_sql("nrows", "schema", "row_count", "m >= 1000", "false", "m", 1000,
              "(SELECT count(*) AS m FROM lineitem)"))

# ------------------------------------------------------------------ quality
_val("val_null_check", events_gaps,
     {"quality": [{"type": "null_check", "name": "nulls", "columns": ["event_type", "value", "ts"],
                   "allow_nulls": True, "max_null_percentage": 12}]},
     _res_sql("nulls", "quality", "null_check", "m <= 12", "false", "m", 12, f"""(SELECT greatest(
       100.0 * count_if(event_type IS NULL) / count(*), 100.0 * count_if(value IS NULL) / count(*),
       100.0 * count_if(ts IS NULL) / count(*)) AS m FROM {EG})"""))

_val("val_duplicate_check", _tbl("events"),
     {"quality": [{"type": "duplicate_check", "name": "dups", "columns": ["user_id", "event_type"],
                   "allow_duplicates": False}]},
     _res_sql("dups", "quality", "duplicate_check", "m = 0", "false", "m", 100, """(SELECT
       (SELECT count(*) FROM events) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events))
       AS m)"""))

_val("val_value_range", _tbl("lineitem"),
     {"quality": [{"type": "value_range", "name": "range", "columns": ["l_quantity", "l_discount", "l_returnflag"],
                   "min_value": 1, "max_value": 45}]},
     _res_sql("range", "quality", "value_range", "m = 0", "false", "m", 0, """(SELECT
       count_if(l_quantity < 1) + count_if(l_quantity > 45) + count_if(l_discount < 1)
       + count_if(l_discount > 45) + 1 AS m FROM lineitem)"""))

_val("val_regex_pattern", orders_gaps,
     {"quality": [{"type": "regex_pattern", "name": "prio", "columns": ["o_orderpriority", "o_orderstatus"],
                   "pattern": "[1-5]-[A-Z]+"}]},
     _res_sql("prio", "quality", "regex_pattern", "m = 0", "false", "m", 0, f"""(SELECT
       count_if(NOT coalesce(regexp_matches(o_orderpriority, '^(?:[1-5]-[A-Z]+)'), false))
       + count_if(NOT coalesce(regexp_matches(o_orderstatus, '^(?:[1-5]-[A-Z]+)'), false)) AS m FROM {OG})"""))

_val("val_uniqueness", _tbl("customer"),
     {"quality": [{"type": "uniqueness", "name": "uniq", "columns": ["c_custkey", "c_nationkey"]}]},
     _res_sql("uniq", "quality", "uniqueness", "m = 0", "true", "m", 0, """(SELECT
       2 * count(*) - count(DISTINCT c_custkey) - count(DISTINCT c_nationkey) AS m FROM customer)"""))

_val("val_completeness", events_gaps,
     {"quality": [{"type": "completeness", "name": "complete", "min_completeness": 95}]},
     _res_sql("complete", "quality", "completeness", "m >= 95", "false", "m", 95, f"""(SELECT least(
       100.0 * count(event_id) / count(*), 100.0 * count(ts) / count(*), 100.0 * count(user_id) / count(*),
       100.0 * count(event_type) / count(*), 100.0 * count(value) / count(*), 100.0 * count(props) / count(*))
       AS m FROM {EG})"""))

# ----------------------------------------------------------------- business
_val("val_business_row", _tbl("lineitem"),
     {"business": [{"name": "price_rule", "expression": "l_extendedprice > 0 AND l_discount <= 0.09"}]},
     _res_sql("price_rule", "business", "row", "m = 0", "false", "m", 0, """(SELECT
       count_if(NOT coalesce(l_extendedprice > 0 AND l_discount <= 0.09, false)) AS m FROM lineitem)"""))

_val("val_business_aggregate", events_gaps,
     {"business": [{"name": "revenue", "expression": "sum(value) > 0 AND count(*) > 100", "aggregate": True}]},
     _res_sql("revenue", "business", "aggregate", "m = 1", "false", "m", None, f"""(SELECT
       CASE WHEN sum(value) > 0 AND count(*) > 100 THEN 1 ELSE 0 END AS m FROM {EG})"""))

# -------------------------------------------------------------- statistical
_val("val_distribution", events_gaps,
     {"statistical": [{"type": "distribution", "name": "value_dist", "column": "value",
                       "expected_mean": 100, "expected_std": 80, "tolerance": 0.1}]},
     _res_sql("value_dist", "statistical", "distribution",
              "abs(m - 100) / 100 <= 0.1 AND abs(sd - 80) / 80 <= 0.1", "false", "m", 0.1,
              f"(SELECT avg(value) AS m, stddev_samp(value) AS sd FROM {EG})"))

_val("val_correlation", _tbl("lineitem"),
     {"statistical": [{"type": "correlation", "name": "qty_price", "columns": ["l_quantity", "l_extendedprice"],
                       "expected_correlation": 0.5, "tolerance": 0.2}]},
     _res_sql("qty_price", "statistical", "correlation", "abs(m - 0.5) <= 0.2", "false", "m", 0.2,
              "(SELECT corr(l_quantity, l_extendedprice) AS m FROM lineitem)"))

_val("val_outliers", events_extremes,
     {"statistical": [{"type": "outliers", "name": "value_outliers", "columns": ["value"], "method": "iqr",
                       "max_outlier_percentage": 1}]},
     _res_sql("value_outliers", "statistical", "outliers", "m <= 1", "false", "m", 1, f"""(SELECT
       100.0 * count_if(value < b.lo OR value > b.hi) / count(*) AS m FROM {EX},
       (SELECT quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS lo,
               quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS hi
        FROM {EX}) b)"""))

# -------------------------------------------------------------------- suite
SUITE = {
    "schema": [{"type": "required_columns", "name": "req", "columns": ["event_id", "value"]},
               {"type": "column_count", "name": "ncols", "exact": 6}],
    "quality": [{"type": "null_check", "name": "value_nulls", "columns": ["value"], "critical": True},
                {"type": "uniqueness", "name": "ids", "columns": ["event_id"]},
                {"type": "completeness", "name": "types_complete", "columns": ["event_type"],
                 "min_completeness": 95, "critical": True}],
    "business": [{"name": "positive", "expression": "value > 0"}],
    "statistical": [{"type": "outliers", "name": "z_outliers", "columns": ["value"], "method": "zscore",
                     "max_outlier_percentage": 5}],
}
SUITE_SQL = f"""
SELECT 0 AS pos, 'req' AS rule, true AS passed, true AS critical, 0.0 AS metric
UNION ALL SELECT 1, 'ncols', true, false, 6.0
UNION ALL SELECT 2, 'value_nulls', count_if(value IS NULL) = 0, true,
  (round(100.0 * count_if(value IS NULL) / count(*), 6) + 0.0) FROM {EG}
UNION ALL SELECT 3, 'ids', count(*) = count(DISTINCT event_id), true,
  CAST(count(*) - count(DISTINCT event_id) AS DOUBLE) FROM {EG}
UNION ALL SELECT 4, 'types_complete', 100.0 * count(event_type) / count(*) >= 95, true,
  (round(100.0 * count(event_type) / count(*), 6) + 0.0) FROM {EG}
UNION ALL SELECT 5, 'positive', count_if(NOT coalesce(value > 0, false)) = 0, false,
  CAST(count_if(NOT coalesce(value > 0, false)) AS DOUBLE) FROM {EG}
UNION ALL SELECT 6, 'z_outliers', 100.0 * count_if(abs(value - s.m) / s.sd > 3) / count(*) <= 5, false,
  (round(100.0 * count_if(abs(value - s.m) / s.sd > 3) / count(*), 6) + 0.0)
  FROM {EG}, (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM {EG}) s
"""


def _suite(spark, sf):
    return R.validate(events_gaps(spark, sf), SUITE)


@register("val_suite", SUITE_SQL)
def q_suite(spark, sf):
    return rounded(_suite(spark, sf).select("pos", "rule", "passed", "critical", "metric"))


@register("val_gate", f"""SELECT pos, rule FROM ({SUITE_SQL}) WHERE NOT passed AND critical
ORDER BY pos LIMIT 1""")
def q_gate(spark, sf):
    return R.first_critical_failure(_suite(spark, sf)).select("pos", "rule")


@register("val_summary", f"""SELECT count(*) AS total_rules, CAST(count_if(passed) AS BIGINT) AS passed_rules,
CAST(count_if(NOT passed) AS BIGINT) AS failed_rules, CAST(count_if(NOT passed AND critical) AS BIGINT) AS error_rules,
CAST(count_if(NOT passed AND NOT critical) AS BIGINT) AS warning_rules FROM ({SUITE_SQL})""")
def q_summary(spark, sf):
    return R.summary(_suite(spark, sf))


# ----------------------------------------------------------------- profiles
EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@register("profile_basic", f"""
SELECT 'rows' AS metric, CAST(NULL AS VARCHAR) AS "column", CAST(count(*) AS VARCHAR) AS value FROM {EG}
UNION ALL SELECT 'columns', NULL, '6'
UNION ALL SELECT 'dtype', column_name, {DUCK_SPARK_TYPE} FROM information_schema.columns
  WHERE table_name = 'events'""")
def q_profile_basic(spark, sf):
    return PR.profile_basic(events_gaps(spark, sf))


@register("profile_missing", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS missing_count, "
    f"(round(100.0 * count_if({c} IS NULL) / count(*), 6) + 0.0) AS missing_percentage FROM {EG}" for c in EV_COLS)
    + f" UNION ALL SELECT '*', CAST(count_if(event_type IS NULL) + count_if(value IS NULL) AS BIGINT), NULL FROM {EG}")
def q_profile_missing(spark, sf):
    return rounded(PR.profile_missing(events_gaps(spark, sf)))


@register("profile_duplicates", """
SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)) AS duplicate_rows,
  (round(100.0 * (count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events))) / count(*), 6) + 0.0)
  AS duplicate_percentage FROM events""")
def q_profile_duplicates(spark, sf):
    return rounded(PR.profile_duplicates(table(spark, sf, "events").select("user_id", "event_type")))


NUM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_STAT_SQL = {"count": "count({c})", "mean": "avg({c})", "std": "stddev_samp({c})", "min": "min({c})",
             "25%": "quantile_cont({c}, 0.25)", "50%": "quantile_cont({c}, 0.5)",
             "75%": "quantile_cont({c}, 0.75)", "max": "max({c})"}


@register("profile_numeric", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{s}' AS stat, (round(CAST({e.format(c=c)} AS DOUBLE), 6) + 0.0) AS value FROM lineitem"
    for c in NUM_COLS for s, e in _STAT_SQL.items()))
def q_profile_numeric(spark, sf):
    return rounded(PR.profile_numeric(table(spark, sf, "lineitem").select(*NUM_COLS)))


@register("profile_categorical", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", (SELECT count(DISTINCT {c}) FROM {OG}) AS unique_count,
      (SELECT {c} FROM {OG} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)
      AS most_frequent""" for c in ["o_orderstatus", "o_orderpriority"]))
def q_profile_categorical(spark, sf):
    return PR.profile_categorical(orders_gaps(spark, sf).select("o_orderkey", "o_orderstatus", "o_orderpriority"))


@register("profile_top_values", " UNION ALL ".join(
    f"""SELECT "column", value, count FROM (SELECT '{c}' AS "column", {c} AS value, count(*) AS count,
      row_number() OVER (ORDER BY count(*) DESC, {c}) AS rn FROM {EG} WHERE {c} IS NOT NULL GROUP BY {c})
      WHERE rn <= 10""" for c in ["event_type", "props"]))
def q_profile_top(spark, sf):
    return PR.profile_top_values(events_gaps(spark, sf))

