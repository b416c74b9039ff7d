"""Queries for fitted operators: impute, scale, encode, outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode as E
from ..operators import impute as I
from ..operators import outliers as O
from ..operators import scale as S
from .registry import (EVENTS_EXTREMES_SQL, EVENTS_GAPS_SQL, ORDERS_GAPS_SQL, events_extremes,
                       events_gaps, orders_gaps, register, rounded, table)

EG = EVENTS_GAPS_SQL
OG = ORDERS_GAPS_SQL
EX = EVENTS_EXTREMES_SQL


# --------------------------------------------------------------------- impute
@register("impute_drop", f"SELECT * FROM {EG} WHERE value IS NOT NULL")
def q_impute_drop(spark, sf):
    return I.impute(events_gaps(spark, sf), {"value": "drop"})


@register("impute_mean", f"""
SELECT event_id, (round(coalesce(value, (SELECT avg(value) FROM {EG})), 6) + 0.0) AS value FROM {EG}""")
def q_impute_mean(spark, sf):
    return rounded(I.impute(events_gaps(spark, sf), {"value": "mean"}).select("event_id", "value"))


@register("impute_median", f"""
SELECT event_id, (round(coalesce(value, (SELECT quantile_cont(value, 0.5) FROM {EG})), 6) + 0.0) AS value FROM {EG}""")
def q_impute_median(spark, sf):
    return rounded(I.impute(events_gaps(spark, sf), {"value": "median"}).select("event_id", "value"))


@register("impute_mode", f"""
SELECT event_id, coalesce(event_type, (SELECT event_type FROM {EG} WHERE event_type IS NOT NULL
  GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)) AS event_type FROM {EG}""")
def q_impute_mode(spark, sf):
    return I.impute(events_gaps(spark, sf), {"event_type": "mode"}).select("event_id", "event_type")


@register("impute_constant", f"""
SELECT event_id, coalesce(event_type, 'unknown') AS event_type, coalesce(value, 0.0) AS value FROM {EG}""")
def q_impute_constant(spark, sf):
    df = I.impute(events_gaps(spark, sf), {"event_type": "constant", "value": "constant"},
                  fill_values={"event_type": "unknown", "value": 0.0})
    return df.select("event_id", "event_type", "value")


@register("impute_forward_fill", f"""
SELECT event_id, last_value(value IGNORE NULLS) OVER (ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM {EG}""")
def q_ffill(spark, sf):
    return I.impute(events_gaps(spark, sf), {"value": "forward_fill"},
                    order_by=["ts", "event_id"]).select("event_id", "value")


@register("impute_backward_fill", f"""
SELECT event_id, first_value(value IGNORE NULLS) OVER (ORDER BY ts, event_id
  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value FROM {EG}""")
def q_bfill(spark, sf):
    return I.impute(events_gaps(spark, sf), {"value": "backward_fill"},
                    order_by=["ts", "event_id"]).select("event_id", "value")


@register("impute_forward_fill_keyed", f"""
SELECT event_id, user_id, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM {EG}""")
def q_ffill_keyed(spark, sf):
    return I.impute(events_gaps(spark, sf), {"value": "forward_fill"}, order_by=["ts", "event_id"],
                    partition_by=["user_id"]).select("event_id", "user_id", "value")


@register("impute_backward_fill_keyed", f"""
SELECT event_id, user_id, first_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value FROM {EG}""")
def q_bfill_keyed(spark, sf):
    return I.impute(events_gaps(spark, sf), {"value": "backward_fill"}, order_by=["ts", "event_id"],
                    partition_by=["user_id"]).select("event_id", "user_id", "value")


@register("impute_global_drop_rows", f"SELECT * FROM {EG} WHERE event_type IS NOT NULL AND value IS NOT NULL")
def q_drop_rows(spark, sf):
    return I.impute(events_gaps(spark, sf), {}, global_strategy="drop_rows")


@register("impute_global_drop_columns", f"SELECT event_id, ts, user_id, props FROM {EG}")
def q_drop_cols(spark, sf):
    return I.impute(events_gaps(spark, sf), {}, global_strategy="drop_columns")


# ---------------------------------------------------------------------- scale
SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


def _scale_sql(center, spread):
    sel = ", ".join(f"(round((li.{c} - s.{c}_c) / s.{c}_s, 6) + 0.0) AS {c}" for c in SCALE_COLS)
    stats = ", ".join(f"{center.format(c=c)} AS {c}_c, {spread.format(c=c)} AS {c}_s" for c in SCALE_COLS)
    return f"WITH s AS (SELECT {stats} FROM lineitem) SELECT li.l_orderkey, li.l_linenumber, {sel} FROM lineitem li, s"


def _scale_q(method):
    def q(spark, sf):
        df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *SCALE_COLS)
        return rounded(S.scale(df, SCALE_COLS, method))
    return q


register("scale_standard", _scale_sql("avg({c})", "coalesce(nullif(stddev_pop({c}), 0), 1)"))(
    _scale_q("standard"))
register("scale_minmax", _scale_sql("min({c})", "coalesce(nullif(max({c}) - min({c}), 0), 1)"))(
    _scale_q("minmax"))
register("scale_robust", _scale_sql(
    "quantile_cont({c}, 0.5)",
    "coalesce(nullif(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 0), 1)"))(_scale_q("robust"))


@register("scale_inverse", "SELECT l_orderkey, l_linenumber, " + ", ".join(SCALE_COLS) + " FROM lineitem")
def q_scale_inverse(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *SCALE_COLS)
    model = S.fit_scaler(df, SCALE_COLS, "robust")
    back = model.inverse(model.transform(df))
    return back.withColumns({c: F.round(F.col(c), 6) for c in SCALE_COLS})


# --------------------------------------------------------------------- encode
@register("encode_label", f"""
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY coalesce(o_orderpriority, 'nan')) - 1 AS INTEGER)
  AS o_orderpriority, o_orderstatus FROM {OG}""")
def q_encode_label(spark, sf):
    df = orders_gaps(spark, sf).select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return E.encode_label(df, ["o_orderpriority"])


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("encode_onehot", "SELECT o_orderkey, o_totalprice, " + ", ".join(
    f"coalesce(o_orderpriority = '{p}', false) AS \"prio_{p}\"" for p in PRIORITIES) + f" FROM {OG}")
def q_encode_onehot(spark, sf):
    df = orders_gaps(spark, sf).select("o_orderkey", "o_orderpriority", "o_totalprice")
    return E.encode_onehot(df, ["o_orderpriority"], prefix="prio")


@register("encode_onehot_sparse", f"""
WITH v AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS i
  FROM (SELECT DISTINCT o_orderpriority FROM {OG} WHERE o_orderpriority IS NOT NULL))
SELECT o.o_orderkey, CAST((SELECT count(*) FROM v) AS INTEGER) AS size, CAST(v.i AS INTEGER) AS index
FROM {OG} o LEFT JOIN v ON o.o_orderpriority = v.o_orderpriority""")
def q_encode_onehot_sparse(spark, sf):
    df = orders_gaps(spark, sf).select("o_orderkey", "o_orderpriority")
    return E.encode_onehot_sparse(df, ["o_orderpriority"]).select("o_orderkey", "o_orderpriority_onehot.size",
                                                                  "o_orderpriority_onehot.index")


@register("encode_target", f"""
SELECT o.o_orderkey, o.o_orderstatus, (round(m.te, 6) + 0.0) AS o_orderpriority_target_encoded
FROM {OG} o LEFT JOIN (SELECT o_orderpriority, avg(o_totalprice) AS te FROM {OG}
  WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority) m ON o.o_orderpriority = m.o_orderpriority""")
def q_encode_target(spark, sf):
    df = orders_gaps(spark, sf).select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    out = E.encode_target(df, ["o_orderpriority"], "o_totalprice").drop("o_totalprice")
    return rounded(out)


# ------------------------------------------------------------------- outliers
IQR_BOUNDS = """(SELECT quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo,
  quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi FROM {src})"""


@register("outlier_iqr", f"""
SELECT event_id, value, const, coalesce(value < b.lo OR value > b.hi, false) AS is_outlier
FROM {EX}, {IQR_BOUNDS.format(c='value', src=EX)} b""")
def q_outlier_iqr(spark, sf):
    df = events_extremes(spark, sf).select("event_id", "value", "const")
    return O.detect_outliers(df, ["value"], method="iqr", action="flag")


@register("outlier_zscore", f"""
SELECT event_id, value, const, coalesce(abs(value - s.m) / s.sd > 3, false) AS is_outlier
FROM {EX}, (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM {EX}) s""")
def q_outlier_zscore(spark, sf):
    df = events_extremes(spark, sf).select("event_id", "value", "const")
    return O.detect_outliers(df, ["value", "const"], method="zscore", action="flag", threshold=3)


@register("outlier_flag", f"""
SELECT event_id, user_id, value, coalesce(value < b.lo OR value > b.hi, false)
  OR coalesce(user_id < u.lo OR user_id > u.hi, false) AS flagged
FROM {EX}, {IQR_BOUNDS.format(c='value', src=EX)} b, {IQR_BOUNDS.format(c='user_id', src=EX)} u""")
def q_outlier_flag(spark, sf):
    df = events_extremes(spark, sf).select("event_id", "user_id", "value")
    return O.detect_outliers(df, ["value", "user_id"], method="iqr", action="flag", flag_column="flagged")


@register("outlier_remove", f"""
SELECT event_id, event_type, value FROM {EX}, {IQR_BOUNDS.format(c='value', src=EX)} b
WHERE NOT coalesce(value < b.lo OR value > b.hi, false)""")
def q_outlier_remove(spark, sf):
    df = events_extremes(spark, sf).select("event_id", "event_type", "value")
    return O.detect_outliers(df, ["value"], method="iqr", action="remove")


@register("outlier_cap", f"""
SELECT event_id, (round(CASE WHEN value IS NULL THEN NULL ELSE greatest(q.lo, least(q.hi, value)) END, 6) + 0.0) AS value
FROM {EX}, (SELECT quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi FROM {EX}) q""")
def q_outlier_cap(spark, sf):
    df = events_extremes(spark, sf).select("event_id", "value")
    return rounded(O.detect_outliers(df, ["value"], method="iqr", action="cap"))


KNN_SQL = """
WITH p AS (SELECT p_partkey, p_size,
             CASE WHEN p_partkey % 20 = 0 THEN NULL ELSE p_retailprice END AS p_retailprice FROM part),
r AS (SELECT * FROM p WHERE p_retailprice IS NULL),
d AS (SELECT * FROM p WHERE p_retailprice IS NOT NULL),
c AS (SELECT r.p_partkey AS rk, d.p_retailprice AS y, row_number() OVER (PARTITION BY r.p_partkey
        ORDER BY 3.0 / 2 * ((CAST(r.p_partkey AS DOUBLE) - d.p_partkey) * (CAST(r.p_partkey AS DOUBLE) - d.p_partkey)
                 + (CAST(r.p_size AS DOUBLE) - d.p_size) * (CAST(r.p_size AS DOUBLE) - d.p_size)),
                 d.p_partkey NULLS FIRST, d.p_size NULLS FIRST, d.p_retailprice NULLS FIRST) AS rn
      FROM r, d)
SELECT p.p_partkey, p.p_size, (round(coalesce(p.p_retailprice, m.v), 6) + 0.0) AS p_retailprice
FROM p LEFT JOIN (SELECT rk, avg(y) AS v FROM c WHERE rn <= 5 GROUP BY rk) m ON p.p_partkey = m.rk"""


@register("impute_knn", KNN_SQL)
def q_impute_knn(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey", "p_size",
        F.when(F.col("p_partkey") % 20 == 0, None).otherwise(F.col("p_retailprice")).alias("p_retailprice"))
    return rounded(I.impute(part, {"p_retailprice": "knn"}, knn_neighbors=5))


@register("scale_minmax_range", "WITH s AS (SELECT " + ", ".join(
    f"min({c}) AS {c}_lo, coalesce(nullif(max({c}) - min({c}), 0), 1) AS {c}_rng" for c in SCALE_COLS)
    + " FROM lineitem) SELECT li.l_orderkey, li.l_linenumber, " + ", ".join(
    f"(round((li.{c} - s.{c}_lo) / (s.{c}_rng / 2.0) + -1.0, 6) + 0.0) AS {c}" for c in SCALE_COLS)
    + " FROM lineitem li, s")
def q_scale_minmax_range(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *SCALE_COLS)
    return rounded(S.scale(df, SCALE_COLS, "minmax", feature_range=(-1.0, 1.0)))


@register("encode_onehot_drop_first", "SELECT o_orderkey, o_totalprice, " + ", ".join(
    f"coalesce(o_orderstatus = '{v}', false) AS \"status_{v}\"" for v in ["O", "P"]) + " FROM orders")
def q_onehot_drop_first(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return E.encode_onehot(df, ["o_orderstatus"], prefix="status", drop_first=True)
