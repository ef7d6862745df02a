"""One row per key, samples, ordered reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimweft.operators import dedupe, sampling
from claimweft.operators.encoding import group_mode_fill
from claimweft.operators.joins import dedupe_dimension
from claimweft.operators.ledger import roll_up
from claimweft.operators.profiling import top_values
from claimweft.plans.adapters import CLAIMS_SQL, as_double, claims, iso_dates, ledger, table
from claimweft.plans.registry import query
from claimweft.session import stage_table

HASH_SQL = "((o_orderkey % 2147483648) * 2654435761) % 4294967296"
PAID_ORDERS_SQL = f"""paid_orders AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice, paid_flag, {HASH_SQL} AS h
  FROM orders JOIN (SELECT l_orderkey, MAX(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS paid_flag
                    FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey)"""


def paid_orders(spark, folder):
    """Orders with the paid flag of their rolled-up ledger."""
    rolled = roll_up(ledger(spark, folder), "claim_number", (), attributes=()).select("claim_key", "paid_flag")
    orders = table(spark, folder, "orders").withColumn("claim_key", F.col("o_orderkey").cast("string"))
    return orders.join(rolled, "claim_key").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice", "paid_flag"
    )


def order_hash():
    return sampling.arithmetic_hash("o_orderkey")


_TIES = ("line_number", "part_key", "supplier_key", "total_charge_amt", "savings_amt", "quantity")


@query("q_latest_per_key", f"""
WITH {CLAIMS_SQL}
SELECT claim_id, CAST(ship_dt AS VARCHAR) AS ship_dt, line_number, part_key, supplier_key,
       CAST(total_charge_amt AS DOUBLE) AS total_charge_amt
FROM claims QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY ship_dt DESC, line_number, part_key,
  supplier_key, total_charge_amt, savings_amt, quantity) = 1
""")
def latest_per_key(spark, folder):
    rows = claims(spark, folder, "claim_id", "ship_dt", *_TIES)
    kept = dedupe.latest_per_key(rows, ["claim_id"], "ship_dt", _TIES)
    return kept.drop("savings_amt", "quantity").transform(iso_dates).transform(as_double)


@query("q_priority_dedupe", f"""
WITH {CLAIMS_SQL}
SELECT customer_key, claim_type, adjustmentstatus, payment_status, claim_id, line_number, part_key, supplier_key
FROM claims QUALIFY row_number() OVER (PARTITION BY customer_key, claim_type, adjustmentstatus ORDER BY payment_status,
  claim_id, line_number, part_key, supplier_key) = 1
""")
def priority_dedupe(spark, folder):
    rows = claims(
        spark, folder, "customer_key", "claim_type", "adjustmentstatus", "payment_status",
        "claim_id", "line_number", "part_key", "supplier_key",
    )
    return dedupe.priority_dedupe(
        rows, ["customer_key", "claim_type", "adjustmentstatus"],
        tie=["claim_id", "line_number", "part_key", "supplier_key"],
    )


@query("q_dim_dedupe", """
SELECT p_brand, p_type, p_size, p_partkey FROM part
QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_size, p_partkey) = 1
""")
def dim_dedupe(spark, folder):
    rows = table(spark, folder, "part").select("p_brand", "p_type", "p_size", "p_partkey")
    return dedupe_dimension(rows, ["p_brand", "p_type"], "p_size", ["p_partkey"])


@query("q_exact_dedupe", "SELECT DISTINCT l_orderkey, l_linenumber, l_linestatus FROM lineitem")
def exact_dedupe(spark, folder):
    return dedupe.exact_dedupe(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus"))


@query("q_duplicate_count", """
SELECT COUNT(*) AS n_rows, (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS n_distinct,
       COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS n_duplicates
FROM lineitem
""")
def duplicate_count(spark, folder):
    return dedupe.duplicate_count(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber"))


@query("q_balanced_sample", f"""
WITH {PAID_ORDERS_SQL}
SELECT o_orderkey, paid_flag FROM paid_orders
QUALIFY row_number() OVER (PARTITION BY paid_flag ORDER BY h, o_orderkey) <= 2000
""")
def balanced_sample(spark, folder):
    rows = stage_table(paid_orders(spark, folder).select("o_orderkey", "paid_flag"), "paid-orders")
    return sampling.balanced_sample(rows, "paid_flag", [0, 1], ["o_orderkey"], 2000, order_hash()).select(
        "o_orderkey", "paid_flag"
    )


@query("q_stratified_split", f"""
WITH ranked AS (
  SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {HASH_SQL}, o_orderkey) AS rn,
         COUNT(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
SELECT o_orderkey, o_orderstatus, CASE WHEN rn <= round_even(n * CAST(0.2 AS DOUBLE), 0) THEN 1 ELSE 0 END AS is_test FROM ranked
""")
def stratified_split(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.stratified_split(rows, "o_orderstatus", ["F", "O", "P"], ["o_orderkey"], 0.2, order_hash())


@query("q_stratified_folds", f"""
WITH ranked AS (
  SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {HASH_SQL}, o_orderkey) AS rn,
         COUNT(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
SELECT o_orderkey, o_orderstatus, CAST((rn > n * 1 // 5)::INT + (rn > n * 2 // 5)::INT + (rn > n * 3 // 5)::INT
       + (rn > n * 4 // 5)::INT AS INTEGER) AS fold
FROM ranked
""")
def stratified_folds(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.stratified_folds(rows, "o_orderstatus", ["F", "O", "P"], ["o_orderkey"], 5, order_hash())


@query("q_hash_sample", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {HASH_SQL}, o_orderkey LIMIT 1000")
def hash_sample(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return sampling.hash_sample(rows, ["o_orderkey"], 1000, order_hash())


@query("q_group_mode_impute", """
WITH p AS (SELECT p_partkey, p_size, CASE WHEN p_partkey % 5 <> 0 AND p_size <> 9 THEN p_type END AS p_type FROM part),
n AS (SELECT p_size, p_type, COUNT(*) AS n FROM p WHERE p_type IS NOT NULL GROUP BY ALL),
m AS (SELECT p_size, p_type AS mode FROM n QUALIFY row_number() OVER (PARTITION BY p_size ORDER BY n DESC, p_type) = 1)
SELECT p_partkey, p_size, COALESCE(p.p_type, mode, 'Unknown') AS p_type FROM p LEFT JOIN m USING (p_size)
""")
def group_mode_impute(spark, folder):
    rows = table(spark, folder, "part").selectExpr(
        "p_partkey", "p_size", "case when p_partkey % 5 <> 0 and p_size <> 9 then p_type end as p_type"
    )
    return group_mode_fill(rows, "p_type", ["p_size"]).select("p_partkey", "p_size", "p_type")


@query("q_top_savings", f"""
WITH {CLAIMS_SQL}
SELECT claim_id, line_number, part_key, CAST(savings_amt AS DOUBLE) AS savings_amt FROM claims
WHERE payment_status = 'UNPAID' ORDER BY savings_amt DESC, claim_id, line_number, part_key
""")
def top_savings(spark, folder):
    rows = claims(spark, folder, "claim_id", "line_number", "part_key", "savings_amt", "payment_status")
    unpaid = rows.filter(F.col("payment_status") == "UNPAID").drop("payment_status")
    ordered = unpaid.orderBy(F.col("savings_amt").desc(), "claim_id", "line_number", "part_key")
    return ordered.transform(as_double)


_TOP = ("l_suppkey", "l_partkey", "l_returnflag", "l_quantity")


@query("q_top_values", "WITH long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(CASE WHEN l_linenumber > 1 THEN {e} END AS VARCHAR) AS value FROM lineitem"
    for c, e in zip(_TOP, ("l_suppkey", "l_partkey", "l_returnflag", "CAST(l_quantity AS BIGINT)"))
) + """), n AS (SELECT "column", value, COUNT(*) AS n FROM long GROUP BY ALL)
SELECT * FROM (SELECT "column", value, n, CAST(row_number() OVER (PARTITION BY "column"
  ORDER BY n DESC, value ASC NULLS LAST) AS INTEGER) AS rank FROM n) WHERE rank <= 10""")
def top_value_lists(spark, folder):
    rows = table(spark, folder, "lineitem").selectExpr(*[
        f"case when l_linenumber > 1 then {'cast(l_quantity as bigint)' if c == 'l_quantity' else c} end as {c}"
        for c in _TOP
    ])
    return top_values(rows, _TOP, 10)
