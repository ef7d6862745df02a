"""Joins between claims, ledger, dimensions and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimweft.operators import joins
from claimweft.operators.aggregates import claim_measures, group_report
from claimweft.operators.dedupe import latest_per_key
from claimweft.operators.filters import model_population
from claimweft.operators.ledger import claims_with_ledger, roll_up
from claimweft.plans.adapters import (
    CLAIMS_SQL, LEDGER_AMOUNTS, ROLLED_SQL, as_double, claims, iso_dates, ledger, model_claims, table,
)
from claimweft.plans.registry import query

_TIES = ("line_number", "part_key", "supplier_key")


@query("q_paid_lookup", f"""
WITH {CLAIMS_SQL},
last AS (SELECT * FROM claims QUALIFY row_number() OVER (PARTITION BY claim_id
  ORDER BY ship_dt DESC, payment_status, line_number, part_key, supplier_key) = 1),
paid AS (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS claimnumber FROM orders WHERE o_orderstatus = 'F')
SELECT claim_id, last.payment_status AS old_status,
       CASE WHEN claimnumber IS NOT NULL THEN 'PAID' ELSE last.payment_status END AS payment_status
FROM last LEFT JOIN paid ON claim_id = claimnumber
""")
def paid_lookup(spark, folder):
    rows = claims(spark, folder, "claim_id", "ship_dt", "payment_status", *_TIES)
    last = latest_per_key(rows, ["claim_id"], "ship_dt", ["payment_status", *_TIES])
    last = last.select("claim_id", F.col("payment_status").alias("old_status"))
    paid = table(spark, folder, "orders").filter("o_orderstatus = 'F'").select("o_orderkey")
    return joins.with_paid_lookup(last, paid, "claim_id", "o_orderkey", "old_status")


@query("q_claims_ledger_join", f"""
WITH {ROLLED_SQL}
SELECT o_orderkey AS claimnumber, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS receiveddate, rolled.*,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS INTEGER) AS days_since_received
FROM orders JOIN rolled ON CAST(o_orderkey AS VARCHAR) = claim_key
WHERE o_orderdate >= DATE '1995-06-01' AND o_orderdate < DATE '1999-06-01'
  AND o_custkey % 11 <> 0 AND o_totalprice - 50000 > 0 AND o_orderstatus <> 'P'
  AND (o_custkey % 5 = 0 OR (CAST(o_custkey * 100 AS VARCHAR) NOT LIKE '800%' AND CAST(o_custkey * 100 AS VARCHAR) NOT LIKE '900%'))
  AND (o_custkey % 3 = 0 OR o_custkey % 7 <> 0) AND o_custkey % 13 <> 0 AND o_custkey <> 8
  AND o_orderpriority <> '5-LOW' AND (o_custkey % 17 = 0 OR o_custkey % 90 < 65)
""")
def claims_ledger_join(spark, folder):
    population = model_population(model_claims(spark, folder), "1995-06-01", "1999-06-01")
    rolled = roll_up(ledger(spark, folder), "claim_number", LEDGER_AMOUNTS)
    rows = population.select("claimnumber", "receiveddate")
    joined = claims_with_ledger(rows, "claimnumber", rolled, "receiveddate", "2001-12-31")
    return joined.transform(as_double).transform(iso_dates)


@query("q_fee_eligible", f"""
WITH {CLAIMS_SQL},
dim AS (SELECT DISTINCT c_mktsegment AS client_cd, 'Brand#' || CAST(c_nationkey + 1 AS VARCHAR) AS network_cd
        FROM customer)
SELECT c.client_cd, c.network_cd, COUNT(*) AS total_records, CAST(SUM(total_charge_amt) AS DOUBLE) AS total_charges,
       CAST(SUM(savings_amt) AS DOUBLE) AS total_savings
FROM claims c JOIN dim d ON c.client_cd = d.client_cd AND c.network_cd = d.network_cd GROUP BY ALL
""")
def fee_eligible(spark, folder):
    rows = claims(spark, folder, "claim_id", "client_cd", "network_cd", "total_charge_amt", "savings_amt")
    dim = table(spark, folder, "customer").selectExpr(
        "c_mktsegment as ccode", "concat('Brand#', cast(c_nationkey + 1 as string)) as productcode",
        "c_acctbal as feetype",
    )
    dim = joins.dedupe_dimension(dim, ["ccode", "productcode"], "feetype")
    kept = joins.eligible_only(rows, dim, {"client_cd": "ccode", "network_cd": "productcode"})
    return group_report(kept, ["client_cd", "network_cd"], claim_measures()).transform(as_double)


@query("q_right_join_labels", """
SELECT l.doc_id, lang, source, quality, toxic
FROM (SELECT doc_id * 2 AS doc_id, lang, source FROM documents) d RIGHT JOIN labels l ON d.doc_id = l.doc_id
""")
def right_join_labels(spark, folder):
    raw = table(spark, folder, "documents").selectExpr("doc_id * 2 as doc_id", "lang", "source")
    return joins.labels_to_rows(raw, table(spark, folder, "labels"), "doc_id")


@query("q_feedback_left_join", """
SELECT d.doc_id, d.source, l.doc_id AS reviewed_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def feedback_left_join(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source")
    feedback = table(spark, folder, "labels").selectExpr("doc_id as reviewed_id", "quality")
    return joins.with_feedback(docs, feedback, "doc_id", "reviewed_id")


@query("q_semi_join", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def semi_join(spark, folder):
    returned = table(spark, folder, "lineitem").filter("l_returnflag = 'R'")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return joins.present_in(orders, returned, "o_orderkey", "l_orderkey")


@query("q_anti_join", """
SELECT o_orderkey, sent_ref FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS sent_ref FROM orders)
WHERE sent_ref IS NULL OR NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = sent_ref AND l_returnflag = 'R')
""")
def anti_join(spark, folder):
    returned = table(spark, folder, "lineitem").filter("l_returnflag = 'R'")
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "case when o_orderkey % 7 <> 0 then o_orderkey end as sent_ref"
    )
    return joins.absent_from(orders, returned, "sent_ref", "l_orderkey")


@query("q_join_quality", """
WITH l AS (SELECT o_orderkey AS k, COUNT(*) AS l FROM orders GROUP BY ALL),
r AS (SELECT l_orderkey AS k, COUNT(*) AS r FROM lineitem GROUP BY ALL),
b AS (SELECT COALESCE(l, 0) AS l, COALESCE(r, 0) AS r FROM l FULL JOIN r USING (k)),
g AS (SELECT CASE WHEN r = 0 THEN 'left_only' WHEN l = 0 THEN 'right_only' WHEN l = 1 AND r = 1 THEN '1:1'
             WHEN l = 1 THEN '1:n' WHEN r = 1 THEN 'n:1' ELSE 'n:m' END AS relationship, COUNT(*) AS n_keys,
             CAST(SUM(l) AS BIGINT) AS left_rows, CAST(SUM(r) AS BIGINT) AS right_rows, CAST(SUM(l * r) AS BIGINT) AS joined_rows
      FROM b GROUP BY ALL)
SELECT *, n_keys / (SELECT SUM(n_keys) FROM g) AS key_share FROM g
""")
def join_quality(spark, folder):
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    return joins.join_quality(orders, lines, "o_orderkey", "l_orderkey")


@query("q_join_quality_many", """
WITH l AS (SELECT user_id AS k, COUNT(*) AS l FROM events GROUP BY ALL),
r AS (SELECT o_custkey AS k, COUNT(*) AS r FROM orders GROUP BY ALL),
b AS (SELECT COALESCE(l, 0) AS l, COALESCE(r, 0) AS r FROM l FULL JOIN r USING (k)),
g AS (SELECT CASE WHEN r = 0 THEN 'left_only' WHEN l = 0 THEN 'right_only' WHEN l = 1 AND r = 1 THEN '1:1'
             WHEN l = 1 THEN '1:n' WHEN r = 1 THEN 'n:1' ELSE 'n:m' END AS relationship, COUNT(*) AS n_keys,
             CAST(SUM(l) AS BIGINT) AS left_rows, CAST(SUM(r) AS BIGINT) AS right_rows, CAST(SUM(l * r) AS BIGINT) AS joined_rows
      FROM b GROUP BY ALL)
SELECT *, n_keys / (SELECT SUM(n_keys) FROM g) AS key_share FROM g
""")
def join_quality_many(spark, folder):
    return joins.join_quality(table(spark, folder, "events"), table(spark, folder, "orders"), "user_id", "o_custkey")


@query("q_posting_lag", """
WITH j AS (SELECT date_diff('day', CAST(o_orderdate AS DATE), CAST(MIN(l_shipdate) AS DATE)) AS lag
           FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderdate)
SELECT COUNT(lag) AS n, CAST(MIN(lag) AS INTEGER) AS min_days, SUM(lag) / COUNT(lag) AS mean_days,
       CAST(MAX(lag) AS INTEGER) AS max_days, COUNT(*) FILTER (WHERE lag < 0) AS n_before_claim
FROM j
""")
def posting_lag(spark, folder):
    rolled = roll_up(ledger(spark, folder), "claim_number", (), attributes=()).select("claim_key", "first_budat")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("claim_key"), F.to_date("o_orderdate").alias("received")
    )
    return joins.posting_lag(orders.join(rolled, "claim_key"), "received", "first_budat")


@query("q_leaf_vs_decision", """
WITH leaves AS (SELECT o_orderkey AS claim_id, o_custkey % 8 AS leaf_label FROM orders)
SELECT leaf_label,
  COUNT(*) FILTER (WHERE claim_id IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')) AS n_paying,
  COUNT(*) FILTER (WHERE claim_id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')) AS n_not_paying
FROM leaves
WHERE claim_id IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F' OR l_returnflag = 'R')
GROUP BY leaf_label
""")
def leaf_vs_decision(spark, folder):
    leaves = table(spark, folder, "orders").selectExpr("o_orderkey as claim_id", "o_custkey % 8 as leaf_label")
    lines = table(spark, folder, "lineitem")
    paying = lines.filter("l_linestatus = 'F'").selectExpr("l_orderkey as claim_id")
    not_paying = lines.filter("l_returnflag = 'R'").selectExpr("l_orderkey as claim_id")
    return joins.leaf_vs_decision(leaves, paying, not_paying)


@query("q_leaf_worklist", """
SELECT o_orderkey AS claim_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS received_dt,
       o_totalprice AS savings_amt, o_custkey % 8 AS leaf_label
FROM orders
WHERE o_orderstatus = 'O' AND o_custkey % 8 IN (1, 3, 5) AND year(o_orderdate) = 1997 AND month(o_orderdate) IN (1, 2, 3, 4, 5)
  AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
ORDER BY savings_amt DESC, claim_id
""")
def leaf_worklist(spark, folder):
    orders = table(spark, folder, "orders")
    labelled = orders.selectExpr("o_orderkey as claim_id", "o_custkey % 8 as leaf_label")
    raw = orders.selectExpr(
        "o_orderkey as claim_id", "cast(o_orderdate as date) as received_dt", "o_totalprice as savings_amt",
        "case when o_orderstatus = 'O' then 'UNPAID' else 'PAID' end as payment_status",
    )
    sent = table(spark, folder, "lineitem").filter("l_returnflag = 'R'").selectExpr("l_orderkey as claim_id")
    out = joins.leaf_worklist(labelled, raw, sent, [1, 3, 5], 1997, [1, 2, 3, 4, 5])
    return out.drop("payment_status").transform(iso_dates)
