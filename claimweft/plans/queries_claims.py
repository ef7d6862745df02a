"""Filters, projections and sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimweft.functions.dates import age_years
from claimweft.operators.columns import (
    drop_leakage, fill_constants, standardise_types, upper_case_names, zero_missing,
)
from claimweft.operators.filters import (
    anomalies, between_closed, claim_population, exclude_values, model_population, share_of_rows,
)
from claimweft.operators.ledger import roll_up
from claimweft.operators.union import stack
from claimweft.plans.adapters import (
    CLAIMS_SQL, LEDGER_AMOUNTS, ROLLED_SQL, as_double, claims, iso_dates, ledger, model_claims, table,
)
from claimweft.plans.registry import query
from claimweft.plans.worklists import unpaid_worklist
from claimweft.sources.jdbc import run_extract


@query("q_param_sql", """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1997-01-01' AND o_orderstatus = 'F'
""")
def param_sql(spark, folder):
    return run_extract(
        spark,
        """SELECT o_orderkey, o_orderpriority, o_totalprice FROM {orders}
           WHERE o_orderdate >= CAST(:start_date AS DATE) AND o_orderdate < CAST(:end_date AS DATE)
             AND o_orderstatus = :status""",
        {"start_date": "1996-01-01", "end_date": "1997-01-01", "status": "F"},
        orders=table(spark, folder, "orders"),
    )


@query("q_multi_part_union", """
SELECT 'documents' AS part, doc_id AS item_id, length(text) AS n_chars FROM documents
UNION ALL SELECT 'benchmark', item_id, length(text) FROM benchmark
UNION ALL SELECT 'conversations', conv_id, length(text) FROM conversations
""")
def multi_part_union(spark, folder):
    keys = {"documents": "doc_id", "benchmark": "item_id", "conversations": "conv_id"}
    return stack([
        table(spark, folder, name).select(
            F.lit(name).alias("part"), F.col(key).alias("item_id"), F.length("text").cast("long").alias("n_chars")
        )
        for name, key in keys.items()
    ])


@query("q_union_by_name", """
SELECT c_name AS party, c_nationkey AS nation_key, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS supplier_key FROM customer
UNION ALL SELECT s_name, s_nationkey, NULL, s_suppkey FROM supplier
""")
def union_by_name(spark, folder):
    customers = table(spark, folder, "customer").selectExpr(
        "c_name as party", "c_nationkey as nation_key", "c_mktsegment as segment"
    )
    suppliers = table(spark, folder, "supplier").selectExpr(
        "s_suppkey as supplier_key", "s_name as party", "s_nationkey as nation_key"
    )
    return stack([customers, suppliers], allow_missing=True)


@query("q_unpaid_worklist", f"""
WITH {CLAIMS_SQL}
SELECT client_cd, claim_id, CAST(processed_dt AS VARCHAR) AS received_dt,
       CAST(total_charge_amt AS DOUBLE) AS total_charge_amt, CAST(savings_amt AS DOUBLE) AS savings_amt,
       claim_specialty, claim_type, network_cd, pcode, payment_status,
       substr(lpad(CAST(part_key AS VARCHAR), 5, '0'), 1, 3) AS zip3
FROM claims WHERE payment_status = 'UNPAID' AND savings_amt > 0 AND processed_dt > DATE '1998-12-31'
""")
def unpaid(spark, folder):
    rows = claims(
        spark, folder, "client_cd", "claim_id", "processed_dt", "total_charge_amt", "savings_amt",
        "claim_specialty", "claim_type", "network_cd", "pcode", "payment_status", "part_key",
    ).withColumnRenamed("processed_dt", "received_dt")
    rows = rows.withColumn("provider_zip_code", F.concat(F.col("part_key").cast("string"), F.lit(".0")))
    kept = [
        "client_cd", "claim_id", "received_dt", "total_charge_amt", "savings_amt", "claim_specialty",
        "claim_type", "network_cd", "pcode", "payment_status", "zip3",
    ]
    return unpaid_worklist(rows, "1998-12-31", kept).transform(iso_dates).transform(as_double)


@query("q_rename_upper", """
SELECT c_custkey AS "CLIENT_ID", c_name AS "CLIENT_NM", c_mktsegment AS "CLIENT_CD" FROM customer
""")
def rename_upper(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    renamed = rows.withColumnsRenamed(
        {"c_custkey": "client_id", "c_name": "client_nm", "c_mktsegment": "client_cd"}
    )
    return upper_case_names(renamed)


@query("q_drop_leakage", f"""
WITH {ROLLED_SQL}
SELECT claim_key, billed_amount_sum, accounting_row_count, paid_flag, rev_specialist FROM rolled
""")
def without_leakage(spark, folder):
    rolled = roll_up(ledger(spark, folder), "claim_number", LEDGER_AMOUNTS)
    dates = ("first_payment_date", "first_budat", "last_budat", "gpart", "no_such_column")
    return rolled.transform(drop_leakage).drop(*dates).transform(as_double)


@query("q_claim_filter", f"""
WITH {CLAIMS_SQL},
marked AS (
  SELECT *, CASE WHEN claim_specialty = '1-URGENT' THEN 'Yes' ELSE 'No' END AS over_65,
         CASE WHEN network_cd = 'Brand#1' THEN 'TEST' WHEN network_cd <> 'Brand#2' THEN client_cd END AS last_nm,
         CASE WHEN line_number = 7 THEN 1009 WHEN line_number > 1 THEN 1007 END AS claimstatus
  FROM claims)
SELECT claim_id, line_number, part_key, CAST(savings_amt AS DOUBLE) AS savings_amt, adjustmentstatus
FROM marked
WHERE savings_amt > 0 AND over_65 = 'No' AND (last_nm IS NULL OR last_nm <> 'TEST')
  AND (claimstatus IS NULL OR claimstatus <> 1009) AND adjustmentstatus IN ('A', 'N')
""")
def claim_filter(spark, folder):
    rows = claims(
        spark, folder, "claim_id", "line_number", "part_key", "savings_amt", "adjustmentstatus",
        "claim_specialty", "network_cd", "client_cd",
    ).withColumns({
        "patient_age_65_ind": F.expr("case when claim_specialty = '1-URGENT' then 'Yes' else 'No' end"),
        "patient_last_nm": F.expr(
            "case when network_cd = 'Brand#1' then 'TEST' when network_cd <> 'Brand#2' then client_cd end"
        ),
        "claimstatus": F.expr("case when line_number = 7 then 1009 when line_number > 1 then 1007 end"),
    })
    kept = claim_population(rows, adjustments=("A", "N"))
    return kept.select("claim_id", "line_number", "part_key", "savings_amt", "adjustmentstatus").transform(as_double)


@query("q_null_tolerant_filter", """
SELECT o_orderkey AS claimnumber, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS receiveddate,
       o_totalprice - 50000 AS savings
FROM orders
WHERE o_orderdate >= DATE '1995-06-01' AND o_orderdate < DATE '1999-06-01'
  AND o_custkey % 11 <> 0 AND o_totalprice - 50000 > 0
  AND o_orderstatus <> 'P'
  AND (o_custkey % 5 = 0 OR (CAST(o_custkey * 100 AS VARCHAR) NOT LIKE '800%' AND CAST(o_custkey * 100 AS VARCHAR) NOT LIKE '900%'))
  AND (o_custkey % 3 = 0 OR o_custkey % 7 <> 0)
  AND o_custkey % 13 <> 0
  AND o_custkey <> 8
  AND o_orderpriority <> '5-LOW'
  AND (o_custkey % 17 = 0 OR o_custkey % 90 < 65)
""")
def null_tolerant_filter(spark, folder):
    rows = model_population(model_claims(spark, folder), "1995-06-01", "1999-06-01")
    return rows.select("claimnumber", "receiveddate", "savings").transform(iso_dates)


@query("q_age_years_filter", """
WITH people AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS seen,
         CAST(CAST(o_orderdate AS DATE) - INTERVAL 768 MONTH AS DATE) AS born
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, l_partkey, CAST(seen AS VARCHAR) AS seen FROM people
WHERE seen < CAST(born + INTERVAL 780 MONTH AS DATE)
""")
def age_years_filter(spark, folder):
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    people = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.to_date("l_shipdate").alias("seen"),
        F.add_months(F.to_date("o_orderdate"), -768).alias("born"),
    )
    return people.filter(age_years(F.col("seen"), F.col("born")) < 65).drop("born").transform(iso_dates)


@query("q_date_between", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-02-29' AND DATE '1998-12-31'
""")
def date_between(spark, folder):
    rows = table(spark, folder, "orders").filter(
        F.col("o_orderdate").between(F.lit("1996-02-29").cast("timestamp_ntz"), F.lit("1998-12-31 23:59:59.999999").cast("timestamp_ntz"))
    )
    days = rows.select("o_orderkey", F.to_date("o_orderdate").alias("order_day"))
    return between_closed(days, "order_day", "1996-02-29", "1998-12-31").transform(iso_dates)


@query("q_exclude_list", """
SELECT c_custkey, c_segment FROM (
  SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS c_segment FROM customer)
WHERE c_segment IS NULL OR c_segment NOT IN ('HOUSEHOLD', 'MACHINERY')
""")
def exclude_list(spark, folder):
    rows = table(spark, folder, "customer").selectExpr(
        "c_custkey", "case when c_custkey % 9 <> 0 then c_mktsegment end as c_segment"
    )
    return exclude_values(rows, "c_segment", ["HOUSEHOLD", "MACHINERY"])


@query("q_cast_standardise", """
SELECT CAST(o_orderkey AS VARCHAR) AS claim_id, lower(o_orderpriority) AS specialty,
       TRY_CAST(CASE WHEN o_orderkey % 4 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) || '.50' END AS DOUBLE) AS amount
FROM orders
""")
def cast_standardise(spark, folder):
    rows = table(spark, folder, "orders").selectExpr(
        "o_orderkey as claim_id",
        "o_orderpriority as specialty",
        "case when o_orderkey % 4 = 0 then 'n/a' else concat(cast(o_custkey as string), '.50') end as amount",
    )
    return standardise_types(rows, ["claim_id"], ["specialty"], ["amount"])


@query("q_constant_fill", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'unknown' ELSE o_orderpriority END AS placeofservice,
       CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE o_totalprice END AS reasonableandcustomary
FROM orders
""")
def constant_fill(spark, folder):
    rows = table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "case when o_orderkey % 3 <> 0 then o_orderpriority end as placeofservice",
        "case when o_orderkey % 5 <> 0 then o_totalprice end as reasonableandcustomary",
    )
    return fill_constants(rows)


@query("q_zero_missing", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '0' ELSE o_orderpriority END AS specialty,
       CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE o_totalprice END AS amount,
       CASE WHEN o_orderkey % 7 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_day
FROM orders
""")
def zero_missing_values(spark, folder):
    rows = table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "case when o_orderkey % 3 <> 0 then o_orderpriority end as specialty",
        "case when o_orderkey % 5 <> 0 then o_totalprice end as amount",
        "case when o_orderkey % 7 <> 0 then cast(o_orderdate as date) end as order_day",
    )
    return zero_missing(rows).transform(iso_dates)


_LINE_AMOUNTS = """
  SELECT l_orderkey, l_linenumber, l_partkey,
         CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS savings_amt,
         CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS total_charge_amt
  FROM lineitem"""


def _line_amounts(spark, folder):
    price = "cast(l_extendedprice as decimal(18,2))"
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey",
        f"{price} * cast(l_discount as decimal(4,2)) as savings_amt",
        f"{price} * cast(l_tax as decimal(4,2)) as total_charge_amt",
    )


@query("q_anomaly_rows", f"""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(savings_amt AS DOUBLE) AS savings_amt,
       CAST(total_charge_amt AS DOUBLE) AS total_charge_amt
FROM ({_LINE_AMOUNTS}) WHERE savings_amt > total_charge_amt
""")
def anomaly_rows(spark, folder):
    return anomalies(_line_amounts(spark, folder)).transform(as_double)


@query("q_anomaly_share", f"""
SELECT COUNT(*) FILTER (WHERE savings_amt > total_charge_amt) AS n_rows, COUNT(*) AS n_total,
       COUNT(*) FILTER (WHERE savings_amt > total_charge_amt) / COUNT(*) AS share
FROM ({_LINE_AMOUNTS})
""")
def anomaly_share(spark, folder):
    return share_of_rows(_line_amounts(spark, folder), F.col("savings_amt") > F.col("total_charge_amt"))
