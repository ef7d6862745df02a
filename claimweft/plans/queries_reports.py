"""Monthly reports: pay rates, booking curve, summaries, revenue, roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimweft.operators import aggregates as agg
from claimweft.operators import booking, revenue
from claimweft.operators.filters import between_open
from claimweft.operators.ledger import roll_up
from claimweft.plans.adapters import (
    CLAIMS_SQL, LEDGER_AMOUNTS, ROLLED_SQL, as_double, claims, iso_dates, ledger, table,
)
from claimweft.plans.registry import query
from claimweft.session import stage_table


@query("q_monthly_pay_rate", f"""
WITH {CLAIMS_SQL},
c AS (SELECT pcode, processed_month, COUNT(*) FILTER (WHERE payment_status = 'PAID') AS paid,
             COUNT(*) FILTER (WHERE payment_status = 'UNPAID') AS unpaid
      FROM claims WHERE processed_dt > DATE '1994-12-31' AND processed_dt < DATE '1999-01-01' GROUP BY ALL)
SELECT pcode, processed_month, paid, unpaid, paid + unpaid AS claim_total,
       round_even(paid / (paid + unpaid), 2) * 100 AS paid_rate,
       round_even(unpaid / (paid + unpaid), 2) * 100 AS unpaid_rate
FROM c
""")
def monthly_pay_rate(spark, folder):
    rows = claims(spark, folder, "claim_id", "pcode", "processed_dt", "processed_month", "payment_status")
    return rows.transform(between_open, "processed_dt", "1994-12-31", "1999-01-01").transform(agg.monthly_pay_rate)


_BOOKING_COLUMNS = ("claim_id", "pcode", "processed_dt", "entry_dt", "payment_status", "savings_amt")
_BOOKING_SQL = f"""{CLAIMS_SQL},
kept AS (SELECT *, strftime(entry_dt, '%Y-%m') AS entry_month FROM claims
         WHERE savings_amt > 0 AND (entry_dt > processed_dt OR entry_dt IS NULL))"""


@query("q_booking_long", f"""
WITH {_BOOKING_SQL},
total AS (SELECT pcode, processed_month, COUNT(*) AS n_month FROM kept GROUP BY ALL),
cell AS (SELECT pcode, processed_month, entry_month, COUNT(*) AS n_claims FROM kept
         WHERE entry_month IS NOT NULL GROUP BY ALL)
SELECT pcode, processed_month, entry_month, n_claims, n_month,
       round_even(n_claims / n_month * 100, 1) AS percent
FROM cell JOIN total USING (pcode, processed_month)
""")
def booking_long(spark, folder):
    return booking.booking_long(claims(spark, folder, *_BOOKING_COLUMNS))


_STATUS_SQL = """
  COUNT(*) FILTER (WHERE payment_status = 'PAID') AS paid_claim_count,
  COUNT(*) FILTER (WHERE payment_status = 'UNPAID') AS unpaid_claim_count,
  CAST(COALESCE(SUM(savings_amt) FILTER (WHERE payment_status = 'PAID'), 0) AS DOUBLE) AS paid_savings_total,
  CAST(COALESCE(SUM(savings_amt) FILTER (WHERE payment_status = 'UNPAID'), 0) AS DOUBLE) AS unpaid_savings_total,
  COUNT(*) AS total_claim_count,
  COUNT(*) FILTER (WHERE payment_status = 'PAID') / COUNT(*) AS pay_rate"""


@query("q_booking_status", f"""
WITH {_BOOKING_SQL}
SELECT pcode, processed_month, {_STATUS_SQL} FROM kept GROUP BY pcode, processed_month
""")
def booking_status(spark, folder):
    return booking.booking_status(claims(spark, folder, *_BOOKING_COLUMNS)).transform(as_double)


# the months become columns; the pivot's input has to stand inside it
_PERCENT_SQL = f"""WITH {_BOOKING_SQL},
  total AS (SELECT pcode, processed_month, COUNT(*) AS n_month FROM kept GROUP BY ALL)
  SELECT pcode, processed_month, 'entry_' || replace(entry_month, '-', '_') AS entry, round_even(COUNT(*) / any_value(n_month) * 100, 1) AS percent
  FROM kept JOIN total USING (pcode, processed_month) WHERE entry_month IS NOT NULL GROUP BY ALL"""


@query("q_booking_pivot", f"""
WITH {_BOOKING_SQL},
s AS (SELECT pcode, processed_month, {_STATUS_SQL}, COUNT(entry_month) > 0 AS any_entry FROM kept GROUP BY pcode, processed_month),
p AS (PIVOT ({_PERCENT_SQL}) ON entry USING first(percent) GROUP BY pcode, processed_month)
SELECT s.* EXCLUDE (any_entry), CASE WHEN any_entry THEN COALESCE(COLUMNS('entry_[0-9]+_[0-9]+'), 0) END
FROM s LEFT JOIN p USING (pcode, processed_month)
""")
def booking_pivot(spark, folder):
    return booking.booking_pivot(claims(spark, folder, *_BOOKING_COLUMNS)).transform(as_double)


@query("q_booking_completeness", f"""
WITH {_BOOKING_SQL}
SELECT CAST(COUNT(entry_month) AS BIGINT) AS n_entered, CAST(COUNT(entry_month) AS BIGINT) AS n_shown, TRUE AS complete FROM kept
""")
def booking_completeness(spark, folder):
    """Every entered claim is in a month that the pivot has a column for."""
    cells = stage_table(booking.booking_cells(claims(spark, folder, *_BOOKING_COLUMNS)), "booking-cells")
    return booking.pivot_completeness(cells, booking.pivot_of_cells(cells, booking.entry_months(cells)))


@query("q_summary_month_client", f"""
WITH {CLAIMS_SQL}
SELECT processed_month, client_cd, payment_status, COUNT(claim_id) AS total_records,
       CAST(SUM(total_charge_amt) AS DOUBLE) AS total_charges, CAST(SUM(savings_amt) AS DOUBLE) AS total_savings
FROM claims GROUP BY ALL
""")
def summary_month_client(spark, folder):
    keys = ["processed_month", "client_cd", "payment_status"]
    rows = claims(spark, folder, "claim_id", "total_charge_amt", "savings_amt", *keys)
    return agg.group_report(rows, keys, agg.claim_measures()).transform(as_double)


@query("q_summary_status", """
WITH s AS (
  SELECT CASE WHEN l_linestatus = 'F' THEN 'PAID' ELSE 'UNPAID' END AS payment_status, COUNT(*) AS total_records,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_charges,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS total_savings
  FROM lineitem GROUP BY ALL)
SELECT *, total_records / (SELECT SUM(total_records) FROM s) AS percentage FROM s
""")
def summary_status(spark, folder):
    rows = claims(spark, folder, "claim_id", "total_charge_amt", "savings_amt", "payment_status")
    report = stage_table(agg.group_report(rows, ["payment_status"], agg.claim_measures()), "status-report")
    return agg.with_share_of_all(report, "total_records", "percentage").transform(as_double)


@query("q_share_of_client", f"""
WITH {CLAIMS_SQL},
g AS (SELECT processed_month, client_cd, payment_status, COUNT(*) AS total_records FROM claims GROUP BY ALL),
t AS (SELECT client_cd, COUNT(*) AS n FROM claims GROUP BY ALL)
SELECT processed_month, client_cd, payment_status, total_records, total_records / n AS percentage
FROM g JOIN t USING (client_cd)
""")
def share_of_client(spark, folder):
    keys = ["processed_month", "client_cd", "payment_status"]
    rows = claims(spark, folder, "claim_id", *keys)
    report = agg.group_report(rows, keys, {"total_records": F.count("claim_id")})
    return agg.with_share_of_group(report, "total_records", ["client_cd"], "percentage")


_FEE_SQL = f"""{CLAIMS_SQL},
c AS (SELECT * REPLACE (nullif(network_cd, 'Brand#3') AS network_cd) FROM claims),
fees AS (
  SELECT pcode, CAST(MIN(fee_amount) AS DOUBLE) AS min_fee,
         CAST(SUM(fee_amount) FILTER (WHERE client_cd IS NOT NULL AND network_cd IS NOT NULL) AS DOUBLE) / COUNT(*) AS weighted_fee,
         COUNT(*) AS n_paid
  FROM c WHERE payment_status = 'PAID' AND fee_amount > 0 GROUP BY pcode)"""


def _fee_claims(spark, folder, *columns):
    rows = claims(spark, folder, "pcode", "client_cd", "network_cd", "payment_status", "fee_amount", *columns)
    return rows.withColumn("network_cd", F.nullif("network_cd", F.lit("Brand#3")))


@query("q_fee_bounds", f"WITH {_FEE_SQL} SELECT * FROM fees")
def fee_bounds(spark, folder):
    return revenue.fee_bounds(_fee_claims(spark, folder), ["pcode"])


@query("q_status_revenue", f"""
WITH {CLAIMS_SQL},
c AS (SELECT * REPLACE (nullif(network_cd, 'Brand#3') AS network_cd) FROM claims),
fees AS (SELECT pcode, CAST(MIN(fee_amount) AS DOUBLE) AS min_fee,
                CAST(SUM(fee_amount) FILTER (WHERE network_cd IS NOT NULL) AS DOUBLE) / COUNT(*) AS weighted_fee
         FROM c WHERE payment_status = 'PAID' AND fee_amount > 0 GROUP BY pcode),
s AS (SELECT pcode, payment_status, COUNT(*) AS total_records, CAST(SUM(total_charge_amt) AS DOUBLE) AS total_charges,
             CAST(SUM(savings_amt) AS DOUBLE) AS total_savings FROM c GROUP BY ALL),
n AS (SELECT pcode, SUM(total_records) AS n FROM s GROUP BY pcode)
SELECT s.*, min_fee, weighted_fee, min_fee * 0.01 * total_savings AS revenue_lower,
       weighted_fee * 0.01 * total_savings AS revenue_upper, total_records / n AS percentage
FROM s JOIN n USING (pcode) LEFT JOIN fees USING (pcode)
""")
def status_revenue(spark, folder):
    rows = _fee_claims(spark, folder, "claim_id", "total_charge_amt", "savings_amt")
    return revenue.status_summary(rows).transform(as_double)


@query("q_revenue_estimate", f"""
WITH {CLAIMS_SQL},
b AS (SELECT CAST(MIN(fee_amount) AS DOUBLE) AS low, CAST(SUM(fee_amount) AS DOUBLE) / COUNT(*) AS high
      FROM claims WHERE payment_status = 'PAID' AND fee_amount > 0)
SELECT claim_id, line_number, part_key, low * 0.01 * CAST(savings_amt AS DOUBLE) AS revenue_estimate_lower,
       high * 0.01 * CAST(savings_amt AS DOUBLE) AS revenue_estimate_upper
FROM claims, b
""")
def revenue_estimate(spark, folder):
    rows = claims(
        spark, folder, "claim_id", "line_number", "part_key", "payment_status", "fee_amount", "savings_amt",
        "client_cd", "network_cd",
    )
    return revenue.with_revenue_estimates(rows).select(
        "claim_id", "line_number", "part_key", "revenue_estimate_lower", "revenue_estimate_upper"
    )


_PIVOT_SQL = f"""{_FEE_SQL},
cells AS (
  SELECT pcode, processed_month, client_cd, payment_status, COUNT(*) AS total_records,
         SUM(total_charge_amt) AS total_charges, SUM(savings_amt) AS total_savings
  FROM c GROUP BY ALL),
money AS (SELECT * FROM cells LEFT JOIN fees USING (pcode)),
wide AS (
  SELECT pcode, processed_month,
    CAST(SUM(total_records) FILTER (WHERE payment_status = 'PAID') AS BIGINT) AS total_records_paid,
    CAST(SUM(total_records) FILTER (WHERE payment_status = 'UNPAID') AS BIGINT) AS total_records_unpaid,
    CAST(SUM(total_charges) FILTER (WHERE payment_status = 'PAID') AS DOUBLE) AS total_charges_paid,
    CAST(SUM(total_charges) FILTER (WHERE payment_status = 'UNPAID') AS DOUBLE) AS total_charges_unpaid,
    CAST(SUM(total_savings) FILTER (WHERE payment_status = 'PAID') AS DOUBLE) AS total_savings_paid,
    CAST(SUM(total_savings) FILTER (WHERE payment_status = 'UNPAID') AS DOUBLE) AS total_savings_unpaid,
    MAX(min_fee) * 0.01 * CAST(SUM(total_savings) FILTER (WHERE payment_status = 'PAID') AS DOUBLE) AS revenue_lower_paid,
    MAX(min_fee) * 0.01 * CAST(SUM(total_savings) FILTER (WHERE payment_status = 'UNPAID') AS DOUBLE) AS revenue_lower_unpaid,
    MAX(weighted_fee) * 0.01 * CAST(SUM(total_savings) FILTER (WHERE payment_status = 'PAID') AS DOUBLE) AS revenue_upper_paid,
    MAX(weighted_fee) * 0.01 * CAST(SUM(total_savings) FILTER (WHERE payment_status = 'UNPAID') AS DOUBLE) AS revenue_upper_unpaid
  FROM money GROUP BY ALL),
rated AS (
  SELECT *, total_records_paid / (total_records_paid + total_records_unpaid) AS paid_rate,
         total_records_unpaid / (total_records_paid + total_records_unpaid) AS unpaid_rate,
         total_records_paid + total_records_unpaid AS all_claims_total
  FROM wide)"""


def _summary_pivot(spark, folder):
    rows = _fee_claims(spark, folder, "claim_id", "processed_month", "total_charge_amt", "savings_amt")
    cells = revenue.month_client_status(rows)
    return revenue.status_pivot(cells, ["pcode", "processed_month"])


@query("q_summary_pivot", f"WITH {_PIVOT_SQL} SELECT * FROM rated")
def summary_pivot(spark, folder):
    return _summary_pivot(spark, folder).transform(as_double)


@query("q_remaining_to_pay", f"""
WITH {_PIVOT_SQL},
aged AS (SELECT *, row_number() OVER (PARTITION BY pcode ORDER BY processed_month DESC) AS age FROM rated),
older AS (SELECT pcode, AVG(paid_rate) AS expected FROM aged WHERE age > 3 GROUP BY pcode),
gap AS (SELECT a.*, CASE WHEN age <= 3 THEN COALESCE(expected, 0) - paid_rate ELSE 0 END AS remaining_rate
        FROM aged a LEFT JOIN older USING (pcode))
SELECT pcode, processed_month, paid_rate, round(remaining_rate, 9) AS remaining_rate,
       round(remaining_rate * revenue_lower_unpaid, 6) AS remaining_lower,
       round(remaining_rate * revenue_upper_unpaid, 6) AS remaining_upper
FROM gap
""")
def remaining_to_pay(spark, folder):
    rows = revenue.remaining_to_pay(_summary_pivot(spark, folder))
    return rows.select(
        "pcode", "processed_month", "paid_rate",
        F.round("remaining_rate", 9).alias("remaining_rate"),
        F.round("remaining_lower", 6).alias("remaining_lower"),
        F.round("remaining_upper", 6).alias("remaining_upper"),
    )


@query("q_revenue_by_rate_dim", f"""
WITH {CLAIMS_SQL},
dim AS (
  SELECT n_name AS parent_client, MIN(s_acctbal) / 100000 AS min_rate,
         CAST(SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) / 100000 AS avg_rate
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  GROUP BY n_name),
cells AS (
  SELECT pcode, processed_month, payment_status, COUNT(*) AS total_records,
         CAST(SUM(total_charge_amt) AS DOUBLE) AS total_charges, CAST(SUM(savings_amt) AS DOUBLE) AS total_savings
  FROM claims GROUP BY ALL)
SELECT cells.*, COALESCE(min_rate, 0) * total_savings AS revenue_lower, COALESCE(avg_rate, 0) * total_savings AS revenue_upper
FROM cells LEFT JOIN dim ON lower(pcode) = lower(parent_client)
""")
def revenue_by_rate_dim(spark, folder):
    rows = claims(
        spark, folder, "claim_id", "pcode", "processed_month", "payment_status", "total_charge_amt", "savings_amt"
    )
    supplier = table(spark, folder, "supplier")
    nation = table(spark, folder, "nation")
    balance = F.sum(F.col("s_acctbal").cast("decimal(18,2)")).cast("double")
    rates = (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .groupBy(F.concat(F.lit(" "), F.upper("n_name"), F.lit(" ")).alias("parent_client"))
        .agg(
            (F.min("s_acctbal") / 100000).alias("min_rate"),
            (balance / F.count("*") / 100000).alias("avg_rate"),
        )
    )
    return revenue.revenue_by_rate_dim(rows, rates).transform(as_double)


_CATEGORIES = ("claim_type", "claim_specialty", "client_cd", "pcode", "network_cd")


@query("q_payrate_by_category", "WITH " + CLAIMS_SQL + ", long AS (\n" + "\nUNION ALL ".join(
    f"SELECT processed_month, payment_status, '{c}' AS category, {c} AS value FROM claims" for c in _CATEGORIES
) + """)
SELECT processed_month, category, value, COUNT(*) FILTER (WHERE payment_status = 'PAID') AS paid,
       COUNT(*) FILTER (WHERE payment_status = 'UNPAID') AS unpaid, COUNT(*) AS total_count,
       COUNT(*) FILTER (WHERE payment_status = 'PAID') / COUNT(*) AS paid_rate
FROM long GROUP BY ALL""")
def payrate_by_category(spark, folder):
    rows = claims(spark, folder, "processed_month", "payment_status", *_CATEGORIES)
    return agg.pay_rate_by_category(rows, _CATEGORIES)


@query("q_ledger_rollup", f"WITH {ROLLED_SQL} SELECT * FROM rolled")
def ledger_rollup(spark, folder):
    rolled = roll_up(ledger(spark, folder), "claim_number", LEDGER_AMOUNTS)
    return rolled.transform(as_double).transform(iso_dates)


@query("q_pepm_monthly", """
WITH census AS (SELECT c_custkey AS group_id, c_mktsegment AS pcode, c_name AS client_nm,
                       c_nationkey AS census, '2024-01-01' AS census_eff_dt
                FROM customer)
SELECT pcode, client_nm, strftime(date_trunc('month', ts), '%Y-%m-%d') AS date, event_type AS acctid,
       substr(event_type, 1, 1) AS ccode, census, group_id, census_eff_dt, COUNT(*) AS total_claims
FROM events JOIN census ON user_id = group_id GROUP BY ALL
""")
def pepm_monthly(spark, folder):
    counts = table(spark, folder, "events").selectExpr(
        "user_id as group_id", "event_type as acctid", "substr(event_type, 1, 1) as ccode",
        "year(ts) as year", "month(ts) as month", "1L as claim_ct",
    )
    census = table(spark, folder, "customer").selectExpr(
        "c_custkey as group_id", "c_mktsegment as pcode", "c_name as client_nm",
        "c_nationkey as census", "'2024-01-01' as census_eff_dt",
    )
    return agg.per_member_monthly(counts, census).transform(iso_dates)


@query("q_product_monthly", f"""
WITH {CLAIMS_SQL}
SELECT processed_month, COUNT(*) AS total_records, CAST(SUM(total_charge_amt) AS DOUBLE) AS total_charges,
       CAST(SUM(savings_amt) AS DOUBLE) AS total_savings
FROM claims WHERE network_cd = 'Brand#7' GROUP BY ALL
""")
def product_monthly(spark, folder):
    rows = claims(spark, folder, "claim_id", "network_cd", "processed_month", "total_charge_amt", "savings_amt")
    one = rows.filter(F.col("network_cd") == "Brand#7")
    return agg.group_report(one, ["processed_month"], agg.claim_measures()).transform(as_double)


@query("q_value_counts", """
WITH v AS (SELECT event_type, COUNT(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY ALL)
SELECT event_type, n, n / (SELECT SUM(n) FROM v) AS share FROM v
""")
def value_counts(spark, folder):
    return agg.value_counts(table(spark, folder, "events"), "event_type")


@query("q_row_frequency", """
SELECT l_orderkey, l_linenumber, l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY ALL
""")
def row_frequency(spark, folder):
    return agg.row_frequency(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


@query("q_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct(spark, folder):
    return table(spark, folder, "part").select("p_brand", "p_type").distinct()


@query("q_unpivot_means", """
WITH m AS (
  SELECT l_returnflag, 'charge' AS measure, CAST(l_extendedprice AS DECIMAL(18,2)) AS value FROM lineitem
  UNION ALL SELECT l_returnflag, 'quantity', CAST(l_quantity AS DECIMAL(18,2)) FROM lineitem)
SELECT l_returnflag, measure, CAST(SUM(value) AS DOUBLE) / COUNT(*) AS mean_value, COUNT(*) AS n FROM m GROUP BY ALL
""")
def unpivot_means(spark, folder):
    rows = table(spark, folder, "lineitem").selectExpr("l_returnflag", "l_extendedprice as charge", "l_quantity as quantity")
    return agg.long_means(rows, ["l_returnflag"], ["charge", "quantity"])


@query("q_class_by_category", """
SELECT 'lang' AS category, lang AS value, quality, COUNT(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL
UNION ALL
SELECT 'source', source, quality, COUNT(*) FROM documents JOIN labels USING (doc_id) GROUP BY ALL
""")
def class_by_category(spark, folder):
    rows = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    return agg.class_by_category(rows, ["lang", "source"], "quality")


@query("q_crosstab", """
SELECT o_orderpriority, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS F,
       COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS O, COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS P
FROM orders GROUP BY o_orderpriority
""")
def crosstab(spark, folder):
    return agg.cross_tab(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("q_target_rate", """
WITH r AS (SELECT CASE WHEN l_suppkey % 4 <> 0 THEN l_suppkey END AS supplier,
                  CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS paid FROM lineitem)
SELECT supplier, SUM(paid) / COUNT(*) AS rate, COUNT(*) AS n FROM r GROUP BY supplier
ORDER BY n DESC, supplier ASC NULLS LAST LIMIT 20
""")
def target_rate(spark, folder):
    rows = table(spark, folder, "lineitem").selectExpr(
        "case when l_suppkey % 4 <> 0 then l_suppkey end as supplier",
        "case when l_linestatus = 'F' then 1 else 0 end as paid",
    )
    return agg.target_rate(rows, "supplier", "paid")
