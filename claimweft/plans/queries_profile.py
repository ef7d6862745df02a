"""Profiles and statistics of whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimweft.operators import profiling
from claimweft.plans.adapters import table
from claimweft.plans.registry import query


def _holes(spark, folder):
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "case when o_custkey % 4 <> 0 then o_custkey end as customer",
        "case when o_custkey % 6 <> 0 then o_orderpriority end as specialty",
        "case when o_orderkey % 5 <> 0 then o_totalprice end as amount",
        "o_orderstatus as status",
    )


@query("q_missing_profile", """
SELECT 'customer' AS "column", COUNT(*) FILTER (WHERE o_custkey % 4 = 0) AS n_missing FROM orders
UNION ALL SELECT 'specialty', COUNT(*) FILTER (WHERE o_custkey % 6 = 0) FROM orders
UNION ALL SELECT 'amount', COUNT(*) FILTER (WHERE o_orderkey % 5 = 0) FROM orders
""")
def missing_profile(spark, folder):
    return profiling.missing_profile(_holes(spark, folder))


_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("q_numeric_summary", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", COUNT({c}) AS n, round(AVG({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, MIN({c}) AS min,
       round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
       round(quantile_cont({c}, 0.75), 6) AS q75, MAX({c}) AS max FROM lineitem""" for c in _NUMERIC))
def numeric_summary(spark, folder):
    out = profiling.numeric_summary(table(spark, folder, "lineitem"), _NUMERIC)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


_CATEGORICAL = {"customer": "CASE WHEN o_custkey % 4 <> 0 THEN o_custkey END",
                "specialty": "CASE WHEN o_custkey % 6 <> 0 THEN o_orderpriority END", "status": "o_orderstatus"}
_LONG_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({e} AS VARCHAR) AS value FROM orders" for c, e in _CATEGORICAL.items()
)


@query("q_categorical_summary", f"""
WITH n AS (SELECT "column", value, COUNT(*) AS n FROM ({_LONG_SQL}) WHERE value IS NOT NULL GROUP BY ALL)
SELECT "column", CAST(SUM(n) AS BIGINT) AS n, COUNT(*) AS n_unique,
       first(value ORDER BY n DESC, value) AS top, MAX(n) AS freq FROM n GROUP BY "column"
""")
def categorical_summary(spark, folder):
    return profiling.categorical_summary(_holes(spark, folder), list(_CATEGORICAL))


@query("q_cardinality", f"""
SELECT "column", COUNT(DISTINCT value) AS n_unique FROM ({_LONG_SQL}) GROUP BY "column"
""")
def cardinality(spark, folder):
    return profiling.cardinality(_holes(spark, folder), list(_CATEGORICAL))


@query("q_tail_quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, round(quantile_cont({c}, {p}), 6) AS value FROM lineitem"
    for c in ("l_extendedprice", "l_quantity") for p in (0.95, 0.99, 0.999)))
def tail_quantiles(spark, folder):
    out = profiling.tail_quantiles(table(spark, folder, "lineitem"), ["l_extendedprice", "l_quantity"])
    return out.withColumn("value", F.round("value", 6))


@query("q_corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 8) AS corr FROM lineitem"
    for a in _NUMERIC for b in _NUMERIC))
def corr_matrix(spark, folder):
    out = profiling.correlation_matrix(table(spark, folder, "lineitem"), _NUMERIC)
    return out.withColumn("corr", F.round("corr", 8))


@query("q_corr_target", " UNION ALL ".join(
    f"SELECT '{a}' AS \"column\", round(corr({a}, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END), 8) AS corr FROM lineitem"
    for a in _NUMERIC))
def corr_target(spark, folder):
    rows = table(spark, folder, "lineitem").withColumn("paid", F.expr("case when l_linestatus = 'F' then 1 else 0 end"))
    return profiling.correlation_with(rows, _NUMERIC, "paid").withColumn("corr", F.round("corr", 8))


_BOX = ("l_extendedprice", "l_quantity")


@query("q_box_stats", "WITH long AS (" + " UNION ALL ".join(
    f"SELECT l_linestatus, '{c}' AS \"column\", {c} AS value FROM lineitem" for c in _BOX) + """),
q AS (SELECT l_linestatus, "column", COUNT(*) AS n, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50,
             quantile_cont(value, 0.75) AS q75 FROM long GROUP BY ALL)
SELECT l_linestatus, "column", n, round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75,
  MIN(value) FILTER (WHERE value >= q25 - 1.5 * (q75 - q25)) AS whisker_low,
  MAX(value) FILTER (WHERE value <= q75 + 1.5 * (q75 - q25)) AS whisker_high,
  COUNT(*) FILTER (WHERE value < q25 - 1.5 * (q75 - q25) OR value > q75 + 1.5 * (q75 - q25)) AS n_outliers
FROM long JOIN q USING (l_linestatus, "column") GROUP BY ALL""")
def box_stats(spark, folder):
    out = profiling.box_numbers(table(spark, folder, "lineitem"), _BOX, "l_linestatus", ["F", "O"])
    return out.withColumns({c: F.round(c, 6) for c in ("q25", "q50", "q75")})


_CHI = {"l_returnflag": "l_returnflag", "l_linenumber": "CAST(l_linenumber AS VARCHAR)",
        "high_tax": "CASE WHEN l_tax > 0.04 THEN 'Y' ELSE 'N' END"}


@query("q_chi_square", "WITH long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {e} AS value, l_linestatus FROM lineitem" for c, e in _CHI.items()) + """),
o AS (SELECT "column", value, l_linestatus, COUNT(*) AS o FROM long GROUP BY ALL),
r AS (SELECT "column", value, SUM(o) AS r FROM o GROUP BY ALL),
c AS (SELECT "column", l_linestatus, SUM(o) AS c FROM o GROUP BY ALL),
t AS (SELECT "column", SUM(r) AS n, COUNT(*) AS nr FROM r GROUP BY ALL),
k AS (SELECT "column", COUNT(*) AS nc FROM c GROUP BY ALL),
e AS (SELECT "column", COALESCE(o, 0) AS o, CAST(r AS DOUBLE) * c / n AS e, n, nr, nc
      FROM r JOIN c USING ("column") JOIN t USING ("column") JOIN k USING ("column")
      LEFT JOIN o USING ("column", value, l_linestatus)),
s AS (
SELECT "column", SUM(CASE WHEN nr = 2 AND nc = 2 THEN pow(abs(o - e) - least(0.5, abs(o - e)), 2) ELSE pow(o - e, 2) END / e) AS x,
       CAST((MAX(nr) - 1) * (MAX(nc) - 1) AS BIGINT) AS dof, CAST(MAX(n) AS BIGINT) AS n
FROM e GROUP BY "column")
SELECT "column", chi2, dof, n, round(p, 8) AS p_value, round(ln(p), 6) AS log_p FROM (
SELECT "column", round(x, 6) AS chi2, dof, n, CASE
    WHEN dof = 1 THEN 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 80),
      lambda i: pow(-1, i) * pow(sqrt(x / 2), 2 * i + 1) / (gamma(i + 1) * (2 * i + 1))))
    ELSE exp(-x / 2) * list_sum(list_transform(range(0, dof // 2), lambda i: pow(x / 2, i) / gamma(i + 1))) END AS p
FROM s)""")
def chi_square(spark, folder):
    rows = table(spark, folder, "lineitem").selectExpr(
        "l_linestatus", "l_returnflag", "l_linenumber", "case when l_tax > 0.04 then 'Y' else 'N' end as high_tax"
    )
    out = profiling.chi_square(rows, list(_CHI), "l_linestatus", ["F", "O"])
    return out.withColumns({"chi2": F.round("chi2", 6), "p_value": F.round("p_value", 8), "log_p": F.round("log_p", 6)})
