"""Queries for selection, PCA, custom expressions and the isolation forest."""

from __future__ import annotations

from ..operators import custom as CU
from ..operators import outliers as O
from ..operators import reduce as RD
from ..operators import selection as SE
from .registry import events_extremes, register, rounded, table

FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lineitem(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", *FEATS)


@register("select_variance", "SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice FROM lineitem")
def q_select_variance(spark, sf):
    return SE.select_variance(_lineitem(spark, sf), 0.01, FEATS)


@register("select_variance_scores", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, (round(var_samp({c}), 6) + 0.0) AS score FROM lineitem" for c in FEATS))
def q_select_variance_scores(spark, sf):
    return rounded(SE.variance_scores(_lineitem(spark, sf), FEATS))


def _anova_sql(c):
    return f"""SELECT '{c}' AS feature,
  ((sum(s * s / n) - sum(s) * sum(s) / sum(n)) / (count(*) - 1))
  / ((sum(q) - sum(s * s / n)) / (sum(n) - count(*))) AS score
FROM (SELECT l_returnflag, count({c}) AS n, sum({c}) AS s, sum({c} * {c}) AS q FROM lineitem GROUP BY l_returnflag)"""


def _ranked_sql(parts, k):
    return f"""SELECT feature, (round(score, 6) + 0.0) AS score,
  row_number() OVER (ORDER BY score DESC NULLS LAST, feature) <= {k} AS selected FROM ({' UNION ALL '.join(parts)})"""


@register("select_univariate_classif", _ranked_sql([_anova_sql(c) for c in FEATS], 2))
def q_select_classif(spark, sf):
    scores = SE.anova_f_scores(_lineitem(spark, sf), "l_returnflag", FEATS)
    return rounded(SE.top_k(scores, 2))


REG_FEATS = ["l_quantity", "l_discount", "l_tax"]


@register("select_univariate_regression", _ranked_sql([
    f"""SELECT '{c}' AS feature, corr({c}, l_extendedprice) * corr({c}, l_extendedprice)
      / (1 - corr({c}, l_extendedprice) * corr({c}, l_extendedprice)) * (count(*) - 2) AS score FROM lineitem"""
    for c in REG_FEATS], 2))
def q_select_regression(spark, sf):
    scores = SE.regression_f_scores(_lineitem(spark, sf), "l_extendedprice", REG_FEATS)
    return rounded(SE.top_k(scores, 2))


@register("pca")
def q_pca(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *FEATS)
    return RD.pca(df, FEATS, 2)


# two columns: eigenvalues and -vectors of a symmetric 2 x 2 matrix in closed form, largest loading positive
PCA2_SQL = """
WITH c AS (SELECT var_samp(l_quantity) AS a, covar_samp(l_quantity, l_extendedprice) AS b, var_samp(l_extendedprice) AS d FROM lineitem),
e AS (SELECT *, (a + d) / 2 + sqrt(((a - d) / 2) ** 2 + b ** 2) AS l1, (a + d) / 2 - sqrt(((a - d) / 2) ** 2 + b ** 2) AS l2 FROM c),
v AS (SELECT 1 AS component, b AS x, l1 - a AS y, l1 / (l1 + l2) AS ratio FROM e
  UNION ALL SELECT 2, b, l2 - a, l2 / (l1 + l2) FROM e),
u AS (SELECT component, ratio, x / sqrt(x * x + y * y) AS x, y / sqrt(x * x + y * y) AS y FROM v),
s AS (SELECT component, ratio, x, y, CASE WHEN (CASE WHEN abs(x) >= abs(y) THEN x ELSE y END) < 0 THEN -1 ELSE 1 END AS sign FROM u)
SELECT component, 'l_quantity' AS "column", round(sign * x, 6) + 0.0 AS loading, round(ratio, 6) + 0.0 AS explained_variance_ratio FROM s
UNION ALL SELECT component, 'l_extendedprice', round(sign * y, 6) + 0.0, round(ratio, 6) + 0.0 FROM s"""


@register("pca_two_columns", PCA2_SQL)
def q_pca_two(spark, sf):
    df = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    return rounded(RD.fit_pca(df, None, 2).components_frame(spark))


@register("custom_column", """SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount, l_tax,
  l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem""")
def q_custom_column(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")
    return CU.custom_column(df, "l_extendedprice * (1 - l_discount) * (1 + l_tax)", "charge")


CUSTOM_TABLE_SQL = """SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS sum_qty,
  (round(avg(l_extendedprice), 6) + 0.0) AS avg_price FROM {data} WHERE l_shipdate <= TIMESTAMP '2001-09-02 00:00:00'
  GROUP BY l_returnflag, l_linestatus"""


@register("custom_table", CUSTOM_TABLE_SQL.replace("{data}", "lineitem"))
def q_custom_table(spark, sf):
    q = CUSTOM_TABLE_SQL.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")
    return CU.custom_table(table(spark, sf, "lineitem"), q)


@register("outlier_isolation_forest")
def q_forest(spark, sf):
    df = events_extremes(spark, sf).select("event_id", "user_id", "value")
    return O.detect_outliers(df, ["value", "user_id"], method="isolation_forest", action="flag",
                             contamination=0.01)

