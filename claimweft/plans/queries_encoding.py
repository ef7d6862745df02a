"""Encoding, imputation, weights and score quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimweft.operators import encoding, metrics, sampling
from claimweft.plans.adapters import table
from claimweft.plans.queries_windows import PAID_ORDERS_SQL, order_hash, paid_orders
from claimweft.plans.registry import query
from claimweft.session import stage_table


def _provider():
    return F.expr("case when o_custkey % 20 <> 0 then o_custkey end")


def _training(spark, folder):
    return paid_orders(spark, folder).withColumn("provider", _provider())


_TRAIN_SQL = f"""{PAID_ORDERS_SQL},
train AS (SELECT *, CASE WHEN o_custkey % 20 <> 0 THEN o_custkey END AS provider FROM paid_orders)"""
_ENC = "round({m} * (1 - 1 / (1 + exp(-({n} - 20)))) + {s} / {n} * (1 / (1 + exp(-({n} - 20)))), 9)"


@query("q_target_encode", f"""
WITH {_TRAIN_SQL},
g AS (SELECT SUM(paid_flag) / COUNT(*) AS m FROM train),
v AS (SELECT provider, SUM(paid_flag) AS s, COUNT(*) AS n FROM train GROUP BY provider)
SELECT provider AS value, n, {_ENC.format(m='m', n='n', s='s')} AS encoded, m AS global_mean FROM v, g
""")
def target_encode(spark, folder):
    out = encoding.fit_target_encoding(_training(spark, folder), "provider", "paid_flag")
    return out.withColumn("encoded", F.round("encoded", 9))


@query("q_target_encode_apply", f"""
WITH {_TRAIN_SQL},
scored AS (SELECT o_orderkey, provider * 2 AS provider FROM train),
g AS (SELECT SUM(paid_flag) / COUNT(*) AS m FROM train),
v AS (SELECT provider, SUM(paid_flag) AS s, COUNT(*) AS n FROM train GROUP BY provider)
SELECT o_orderkey, scored.provider, COALESCE({_ENC.format(m='m', n='n', s='s')}, round(m, 9)) AS provider_te
FROM scored CROSS JOIN g LEFT JOIN v ON scored.provider IS NOT DISTINCT FROM v.provider
""")
def target_encode_apply(spark, folder):
    rows = _training(spark, folder)
    maps = stage_table(encoding.fit_target_encoding(rows, "provider", "paid_flag"), "encodings")
    scored = rows.selectExpr("o_orderkey", "provider * 2 as provider")  # many providers unseen at fit time
    out = encoding.apply_target_encoding(scored, maps, "provider")
    return out.withColumn("provider_te", F.round("provider_te", 9))


@query("q_kfold_target_encode", f"""
WITH {_TRAIN_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY paid_flag ORDER BY h, o_orderkey) AS rn,
                  COUNT(*) OVER (PARTITION BY paid_flag) AS n FROM train),
folded AS (SELECT * EXCLUDE (n), (rn > n * 1 // 5)::INT + (rn > n * 2 // 5)::INT + (rn > n * 3 // 5)::INT + (rn > n * 4 // 5)::INT AS fold FROM ranked),
folds AS (SELECT DISTINCT fold FROM folded),
g AS (SELECT f.fold, SUM(paid_flag) / COUNT(*) AS m FROM folds f JOIN folded t ON t.fold <> f.fold GROUP BY f.fold),
v AS (SELECT f.fold, provider, SUM(paid_flag) AS s, COUNT(*) AS n FROM folds f JOIN folded t ON t.fold <> f.fold GROUP BY ALL)
SELECT o_orderkey, CAST(t.fold AS INTEGER) AS fold, COALESCE({_ENC.format(m='m', n='n', s='s')}, round(m, 9)) AS provider_te
FROM folded t JOIN g ON t.fold = g.fold LEFT JOIN v ON v.fold = t.fold AND v.provider IS NOT DISTINCT FROM t.provider
""")
def kfold_target_encode(spark, folder):
    rows = stage_table(_training(spark, folder).select("o_orderkey", "provider", "paid_flag"), "paid-orders")
    folded = sampling.stratified_folds(rows, "paid_flag", [0, 1], ["o_orderkey"], 5, order_hash())
    out = encoding.out_of_fold_encode(folded, "provider", "paid_flag")
    return out.select("o_orderkey", "fold", F.round("provider_te", 9).alias("provider_te"))


@query("q_impute", """
WITH h AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS amount,
                  CASE WHEN o_custkey % 6 <> 0 THEN o_orderpriority END AS specialty FROM orders),
n AS (SELECT specialty, COUNT(*) AS n FROM h WHERE specialty IS NOT NULL GROUP BY ALL),
f AS (SELECT (SELECT quantile_cont(amount, 0.5) FROM h) AS med, (SELECT specialty FROM n ORDER BY n DESC, specialty LIMIT 1) AS mode)
SELECT o_orderkey, round(COALESCE(amount, med), 6) AS amount, COALESCE(specialty, mode) AS specialty FROM h, f
""")
def impute(spark, folder):
    rows = table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "case when o_orderkey % 5 <> 0 then o_totalprice end as amount",
        "case when o_custkey % 6 <> 0 then o_orderpriority end as specialty",
    )
    fills = encoding.fit_imputation(rows, ["amount"], ["specialty"])
    return encoding.apply_imputation(rows, fills).withColumn("amount", F.round("amount", 6))


@query("q_one_hot_wide", """
SELECT l_orderkey, l_linenumber, l_partkey,
       (l_returnflag = 'A')::INT AS l_returnflag_A, (l_returnflag = 'N')::INT AS l_returnflag_N,
       (l_returnflag = 'R')::INT AS l_returnflag_R, (l_linestatus = 'F')::INT AS l_linestatus_F, (l_linestatus = 'O')::INT AS l_linestatus_O
FROM lineitem
""")
def one_hot_wide(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")
    values = encoding.one_hot_categories(rows, ["l_returnflag", "l_linestatus"])
    return encoding.one_hot_wide(rows, values).drop("l_returnflag", "l_linestatus")


@query("q_class_weights", """
WITH c AS (SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY ALL)
SELECT o_orderstatus, n, (SELECT SUM(n) FROM c) / ((SELECT COUNT(*) FROM c) * n) AS weight,
       ((SELECT SUM(n) FROM c) - n) / n AS others_per_row FROM c
""")
def class_weights(spark, folder):
    return encoding.class_weights(table(spark, folder, "orders"), "o_orderstatus", ["F", "O", "P"])


def _scores(spark, folder):
    return table(spark, folder, "lineitem").selectExpr(
        "l_extendedprice / 200000 + l_discount as score",
        "case when l_linestatus = 'F' then 1 else 0 end as paid_flag",
    )


_SCORES_SQL = """scores AS (SELECT l_extendedprice / 200000 + l_discount AS score,
  CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS paid_flag FROM lineitem)"""


@query("q_best_f1_threshold", f"""
WITH {_SCORES_SQL},
s AS (SELECT score, SUM(paid_flag) AS pos, COUNT(*) AS n FROM scores GROUP BY score),
c AS (SELECT score, SUM(pos) OVER (ORDER BY score DESC) AS tp, SUM(n) OVER (ORDER BY score DESC) AS flagged,
             (SELECT SUM(paid_flag) FROM scores) AS p FROM s)
SELECT score AS threshold, tp / flagged AS precision, tp / p AS recall, 2 * tp / (flagged + p) AS f1
FROM c ORDER BY f1 DESC, score LIMIT 1
""")
def best_f1_threshold(spark, folder):
    return metrics.best_f1_threshold(_scores(spark, folder), "score", "paid_flag")


@query("q_roc_auc", f"""
WITH {_SCORES_SQL},
s AS (SELECT score, SUM(paid_flag) AS pos, COUNT(*) - SUM(paid_flag) AS neg FROM scores GROUP BY score),
c AS (SELECT pos, neg, COALESCE(SUM(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM s)
SELECT CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg,
       CAST(SUM(neg * (2 * above + pos)) AS DOUBLE) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg) * 2) AS auc FROM c
""")
def roc_auc(spark, folder):
    return metrics.roc_auc(_scores(spark, folder), "score", "paid_flag")


@query("q_classification_metrics", f"""
WITH {_SCORES_SQL}, p AS (SELECT paid_flag AS y, CASE WHEN score >= 0.3 THEN 1 ELSE 0 END AS p FROM scores)
SELECT CAST(k AS INTEGER) AS "class", COUNT(*) FILTER (WHERE p = k AND y = k) / COUNT(*) FILTER (WHERE p = k) AS precision,
       COUNT(*) FILTER (WHERE p = k AND y = k) / COUNT(*) FILTER (WHERE y = k) AS recall,
       2 * COUNT(*) FILTER (WHERE p = k AND y = k) / (COUNT(*) FILTER (WHERE p = k) + COUNT(*) FILTER (WHERE y = k)) AS f1,
       COUNT(*) FILTER (WHERE y = k) AS support, COUNT(*) FILTER (WHERE p = y) / COUNT(*) AS accuracy
FROM p, (SELECT unnest([0, 1]) AS k) GROUP BY k
""")
def classification_metrics(spark, folder):
    rows = _scores(spark, folder).withColumn("prediction", (F.col("score") >= 0.3).cast("int"))
    return metrics.classification_report(rows, "prediction", "paid_flag")


@query("q_confusion_matrix", f"""
WITH {_SCORES_SQL}
SELECT paid_flag, CASE WHEN score >= 0.3 THEN 1 ELSE 0 END AS prediction, COUNT(*) AS n FROM scores GROUP BY ALL
""")
def confusion_matrix(spark, folder):
    rows = _scores(spark, folder).withColumn("prediction", (F.col("score") >= 0.3).cast("int"))
    return metrics.confusion_matrix(rows, "prediction", "paid_flag")
