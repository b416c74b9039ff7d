"""Queries for predicates, the clean step and row-local features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import DIGIT_PATTERN
from ..functions.exprs import SQL_EDGE_WHITESPACE_PATTERN as EDGE_WHITESPACE_PATTERN
from ..functions.exprs import SQL_PUNCTUATION_PATTERN as PUNCTUATION_PATTERN
from ..functions.exprs import SQL_WHITESPACE_RUN_PATTERN as WHITESPACE_RUN_PATTERN
from ..functions.exprs import SQL_WORD_PATTERN as WORD_PATTERN
from ..operators import clean as C
from ..operators import features as FE
from ..operators import predicates as P
from .registry import (EVENTS_GAPS_SQL, LINEITEM_GAPS_SQL, events_gaps, lineitem_gaps, register, table)

EG = EVENTS_GAPS_SQL
EV_COLS = "event_id, ts, user_id, event_type, value, props"


# ----------------------------------------------------------------- predicates
def _pred(key, column, condition, value, sql_where, source="events"):
    def q(spark, sf):
        df = events_gaps(spark, sf) if source == "events" else table(spark, sf, source)
        return P.filter_rows(df, column, condition, value)
    src = EG if source == "events" else source
    register(key, f"SELECT * FROM {src} t WHERE {sql_where}")(q)


_pred("filter_equals", "event_type", "equals", "click", "event_type = 'click'")
_pred("filter_not_equals", "event_type", "not_equals", "click", "event_type IS DISTINCT FROM 'click'")
_pred("filter_greater_than", "value", "greater_than", 100, "value > 100")
_pred("filter_less_than", "l_quantity", "less_than", 10, "l_quantity < 10", source="lineitem")
_pred("filter_contains", "event_type", "contains", "^(cl|vi)", "regexp_matches(event_type, '^(cl|vi)')")
_pred("filter_in", "event_type", "in", ["click", "view"], "event_type IN ('click', 'view')")
_pred("filter_not_null", "value", "not_null", None, "value IS NOT NULL")
_pred("filter_is_null", "event_type", "is_null", None, "event_type IS NULL")


# ---------------------------------------------------------------------- clean
@register("dedupe_keep_first", f"""
SELECT {EV_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY ts, event_id) AS rn FROM {EG}) WHERE rn = 1""")
def q_dedupe_first(spark, sf):
    return C.dedupe(events_gaps(spark, sf), ["user_id", "event_type"], "first", ["ts", "event_id"])


@register("dedupe_keep_last", f"""
SELECT {EV_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY ts DESC, event_id DESC) AS rn FROM {EG}) WHERE rn = 1""")
def q_dedupe_last(spark, sf):
    return C.dedupe(events_gaps(spark, sf), ["user_id", "event_type"], "last", ["ts", "event_id"])


@register("dedupe_keep_none", """
SELECT * FROM orders o WHERE (SELECT count(*) FROM orders p
  WHERE p.o_custkey = o.o_custkey AND p.o_orderstatus = o.o_orderstatus) = 1""")
def q_dedupe_none(spark, sf):
    return C.dedupe(table(spark, sf, "orders"), ["o_custkey", "o_orderstatus"], "none")


@register("drop_columns", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
  l_returnflag, l_linestatus, l_shipdate FROM lineitem""")
def q_drop(spark, sf):
    return C.drop_columns(table(spark, sf, "lineitem"), ["l_tax", "l_comment"])


@register("rename_columns", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity AS quantity, l_extendedprice,
  l_discount, l_tax AS tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem""")
def q_rename(spark, sf):
    return C.rename_columns(table(spark, sf, "lineitem"), {"l_quantity": "quantity", "l_tax": "tax",
                                                          "missing": "x"})


def _events_text_k(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", "user_id",
                    F.when(F.col("event_id") % 13 == 0, F.lit("bad"))
                    .otherwise(F.get_json_object("props", "$.k")).alias("k"),
                    F.when(F.col("event_id") % 13 == 0, F.lit("bad"))
                    .otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm")).alias("when_text"))


K_SQL = """(SELECT event_id, user_id,
  CASE WHEN event_id % 13 = 0 THEN 'bad' ELSE json_extract_string(props, '$.k') END AS k,
  CASE WHEN event_id % 13 = 0 THEN 'bad' ELSE strftime(ts, '%d/%m/%Y %H:%M') END AS when_text
  FROM events)"""


@register("cast_columns", f"""
SELECT event_id, CAST(user_id AS INTEGER) AS user_id, TRY_CAST(k AS BIGINT) AS k, when_text FROM {K_SQL}""")
def q_cast(spark, sf):
    return C.cast_columns(_events_text_k(spark, sf), {"user_id": "int32", "k": "int"}, on_error="null")


@register("parse_datetime", f"""
SELECT event_id, user_id, k, try_strptime(when_text, '%d/%m/%Y %H:%M') AS when_text FROM {K_SQL}""")
def q_parse_dt(spark, sf):
    return C.parse_datetime(_events_text_k(spark, sf), "when_text", "%d/%m/%Y %H:%M")


def _text_q(key, ops, sql_expr, source="documents", idcols=("doc_id",)):
    def q(spark, sf):
        df = table(spark, sf, source).select(*idcols, "text")
        return C.clean_text(df, "text", ops)
    register(key, f"SELECT {', '.join(idcols)}, {sql_expr} AS text FROM {source}")(q)


_text_q("text_lowercase", ["lowercase"], "lower(text)")
_text_q("text_uppercase", ["uppercase"], "upper(replace(text, 'ß', 'SS'))")  # full case mapping of ß
_text_q("text_strip", ["strip"], f"regexp_replace(text, '{EDGE_WHITESPACE_PATTERN}', '', 'g')",
        "conversations", ("conv_id", "turn"))
_text_q("text_remove_punctuation", ["remove_punctuation"],
        f"regexp_replace(text, '{PUNCTUATION_PATTERN}', '', 'g')")
_text_q("text_remove_digits", ["remove_digits"], f"regexp_replace(text, '{DIGIT_PATTERN}', '', 'g')")
_text_q("text_remove_extra_spaces", ["remove_extra_spaces"], f"regexp_replace(text, '{WHITESPACE_RUN_PATTERN}', ' ', 'g')")


@register("clean_row_filters", f"""
SELECT * FROM {EG} WHERE value > 10 AND event_type IS DISTINCT FROM 'view' AND user_id IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144)""")
def q_row_filters(spark, sf):
    return C.clean_step(events_gaps(spark, sf), {"row_filters": [
        {"column": "value", "condition": "greater_than", "value": 10},
        {"column": "event_type", "condition": "not_equals", "value": "view"},
        {"column": "user_id", "condition": "in", "value": [1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144]},
        {"column": "no_such_column", "condition": "equals", "value": 1},
    ]})


# -------------------------------------------------------------- arithmetic
LG = LINEITEM_GAPS_SQL
ARITH = {
    "feat_sum": ("sum", ["l_quantity", "l_discount", "l_tax"],
                 "coalesce(l_quantity, 0) + coalesce(l_discount, 0) + coalesce(l_tax, 0)"),
    "feat_mean": ("mean", ["l_quantity", "l_discount", "l_tax"],
                  "(coalesce(l_quantity, 0) + coalesce(l_discount, 0) + coalesce(l_tax, 0)) / "
                  "nullif((l_quantity IS NOT NULL)::INT + (l_discount IS NOT NULL)::INT + "
                  "(l_tax IS NOT NULL)::INT, 0)"),
    "feat_difference": ("difference", ["l_extendedprice", "l_discount"], "l_extendedprice - l_discount"),
    "feat_ratio": ("ratio", ["l_extendedprice", "l_discount"], "l_extendedprice / (l_discount + 1e-8)"),
    "feat_product": ("product", ["l_quantity", "l_discount", "l_tax"],
                     "coalesce(l_quantity, 1) * coalesce(l_discount, 1) * coalesce(l_tax, 1)"),
    "feat_max": ("max", ["l_quantity", "l_discount", "l_tax"], "greatest(l_quantity, l_discount, l_tax)"),
    "feat_min": ("min", ["l_quantity", "l_discount", "l_tax"], "least(l_quantity, l_discount, l_tax)"),
}


def _arith_q(key, op, cols, sql_expr):
    def q(spark, sf):
        df = lineitem_gaps(spark, sf).select("l_orderkey", "l_linenumber", *cols)
        return FE.arithmetic_feature(df, "feature", op, cols)
    register(key, f"SELECT l_orderkey, l_linenumber, {', '.join(cols)}, "
                  f"{sql_expr} AS feature FROM {LG}")(q)


for _k, (_op, _cols, _sql) in ARITH.items():
    _arith_q(_k, _op, _cols, _sql)


@register("feat_datetime", """
SELECT o_orderkey, o_orderdate,
  CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year, CAST(month(o_orderdate) AS INTEGER) AS o_orderdate_month,
  CAST(day(o_orderdate) AS INTEGER) AS o_orderdate_day, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS o_orderdate_dayofweek,
  CAST(quarter(o_orderdate) AS INTEGER) AS o_orderdate_quarter, CAST(hour(o_orderdate) AS INTEGER) AS o_orderdate_hour,
  CAST(minute(o_orderdate) AS INTEGER) AS o_orderdate_minute,
  CAST(coalesce(isodow(o_orderdate) >= 6, false) AS INTEGER) AS o_orderdate_is_weekend
FROM orders""")
def q_datetime(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return FE.datetime_features(df, "o_orderdate", list(FE.DATETIME_PARTS))


TEXT_SQL = {
    "length": "length(text)",
    "word_count": f"len(regexp_extract_all(text, '{WORD_PATTERN}'))",
    "char_count": "length(replace(text, ' ', ''))",
    "uppercase_count": "len(regexp_extract_all(text, '[A-Z]'))",
    "digit_count": f"len(regexp_extract_all(text, '{DIGIT_PATTERN}'))",
    "punctuation_count": f"len(regexp_extract_all(text, '{PUNCTUATION_PATTERN}'))",
}


def _text_feat_q(feat):
    def q(spark, sf):
        df = table(spark, sf, "documents").select("doc_id", "text")
        return FE.text_features(df, "text", [feat]).drop("text")
    register(f"feat_text_{feat}", f"SELECT doc_id, CAST({TEXT_SQL[feat]} AS INTEGER) AS text_{feat} "
                                  f"FROM documents")(q)


for _f in FE.TEXT_FEATURES:
    _text_feat_q(_f)


@register("feat_interaction", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
  l_quantity * l_extendedprice AS l_quantity_multiply_l_extendedprice,
  l_quantity * l_discount AS l_quantity_multiply_l_discount,
  l_extendedprice * l_discount AS l_extendedprice_multiply_l_discount
FROM """ + LG)
def q_interaction(spark, sf):
    df = lineitem_gaps(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity",
                                         "l_extendedprice", "l_discount")
    return FE.interaction_features(df, ["l_quantity", "l_extendedprice", "l_discount", "nope"], "multiply")


@register("feat_bin_equal_width", """
WITH s AS (SELECT min(l_extendedprice) AS mn, max(l_extendedprice) AS mx FROM lineitem),
e AS (SELECT mn + (mx - mn) * 1 / 5 AS e1, mn + (mx - mn) * 2 / 5 AS e2,
             mn + (mx - mn) * 3 / 5 AS e3, mn + (mx - mn) * 4 / 5 AS e4 FROM s)
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_extendedprice <= e1 THEN 0 WHEN l_extendedprice <= e2 THEN 1
  WHEN l_extendedprice <= e3 THEN 2 WHEN l_extendedprice <= e4 THEN 3 ELSE 4 END AS INTEGER) AS price_bin
FROM lineitem, e""")
def q_bin_width(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return FE.binned_feature(df, "l_extendedprice", 5, "equal_width", name="price_bin").drop("l_extendedprice")


@register("feat_bin_equal_frequency", """
WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS e1, quantile_cont(l_extendedprice, 0.5) AS e2,
  quantile_cont(l_extendedprice, 0.75) AS e3 FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_extendedprice <= e1 THEN 0 WHEN l_extendedprice <= e2 THEN 1
  WHEN l_extendedprice <= e3 THEN 2 ELSE 3 END AS INTEGER) AS price_quartile
FROM lineitem, q""")
def q_bin_freq(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return FE.binned_feature(df, "l_extendedprice", 4, "equal_frequency",
                             name="price_quartile").drop("l_extendedprice")


@register("feat_polynomial", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount,
  l_quantity * l_quantity AS "l_quantity^2", l_quantity * l_discount AS "l_quantity l_discount",
  l_discount * l_discount AS "l_discount^2"
FROM """ + LG)
def q_poly(spark, sf):
    df = lineitem_gaps(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return FE.polynomial_features(df, ["l_quantity", "l_discount"], 2)



# ------------------------------------------------------------ option variants
@register("feat_bin_labels", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice > 0 AND l_extendedprice <= 20000 THEN 'low'
  WHEN l_extendedprice > 20000 AND l_extendedprice <= 50000 THEN 'mid'
  WHEN l_extendedprice > 50000 AND l_extendedprice <= 100000 THEN 'high' END AS price_band
FROM lineitem""")
def q_bin_labels(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return FE.binned_feature(df, "l_extendedprice", [0, 20000, 50000, 100000], "equal_width",
                             labels=["low", "mid", "high"], name="price_band").drop("l_extendedprice")


@register("cast_columns_keep", f"""
SELECT event_id, CAST(user_id AS INTEGER) AS user_id, k, when_text FROM {K_SQL}""")
def q_cast_keep(spark, sf):
    # "k" holds text that is not a number in some rows: the whole column stays text
    return C.cast_columns(_events_text_k(spark, sf), {"user_id": "int32", "k": "int"}, on_error="keep")
