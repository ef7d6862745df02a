"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimweft.functions import amounts, codes, dates, flags, text
from claimweft.operators.columns import align_columns
from claimweft.plans.adapters import iso_dates, table
from claimweft.plans.registry import query


@query("q_zip3", """
SELECT o_orderkey, substr(lpad(CAST(o_custkey AS VARCHAR), 5, '0'), 1, 3) AS zip3 FROM orders
""")
def zip3(spark, folder):
    raw = """case o_orderkey % 3 when 0 then lpad(cast(o_custkey as string), 5, '0')
             when 1 then concat(cast(o_custkey as string), '.0')
             else concat(lpad(cast(o_custkey as string), 5, '0'), '-1234') end"""
    rows = table(spark, folder, "orders").selectExpr("o_orderkey", f"{raw} as zip")
    return rows.select("o_orderkey", text.zip3(F.col("zip")).alias("zip3"))


@query("q_text_clean", r"""
SELECT doc_id, replace(text, 'a', '') AS no_delimiter,
       regexp_replace(text, '[^\p{L}\p{M}\p{Nd}\p{Pc}]', '', 'g') AS words, upper(lang) AS lang
FROM documents
""")
def text_clean(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id",
        text.strip_delimiter(F.col("text"), "a").alias("no_delimiter"),
        text.strip_non_word(F.col("text")).alias("words"),
        F.upper("lang").alias("lang"),
    )


@query("q_key_normalise", """
SELECT p_partkey, lower(p_brand) AS client_key FROM part
""")
def key_normalise(spark, folder):
    dirty = F.concat(F.lit(" \t"), F.col("p_brand"), F.lit("  "))
    return table(spark, folder, "part").select("p_partkey", text.normalise_key(dirty).alias("client_key"))


_INDICATOR = """CASE WHEN l_linenumber = 4 THEN NULL WHEN l_linenumber = 5 THEN '' ELSE
  'ADJ=' || CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END ||
  ';BMP=' || CASE l_linenumber WHEN 1 THEN 'E' WHEN 2 THEN 'EN' WHEN 3 THEN 'EY' WHEN 6 THEN 'N' ELSE 'O' END ||
  ';' || CASE WHEN l_returnflag = 'R' THEN 'FSER=F;' ELSE '' END ||
  'CFR=' || CASE WHEN l_quantity > 40 THEN 'E401' WHEN l_quantity > 30 THEN 'E404' WHEN l_quantity > 20 THEN 'E411' WHEN l_quantity > 10 THEN 'E416' ELSE 'X' END ||
  ';MRB=' || CASE l_linenumber WHEN 1 THEN 'EF' WHEN 2 THEN 'EYCN' WHEN 3 THEN 'NN' ELSE 'EYCY' END ||
  ';OTP=' || CASE WHEN l_returnflag = 'A' THEN 'EN' ELSE 'E' END || ';WAF=' || CASE WHEN l_tax > 0.03 THEN 'Y' ELSE 'N' END || ';' END"""


@query("q_flag_decode", f"""
WITH lines AS (SELECT *, {_INDICATOR} AS ind FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN contains(ind, 'ADJ=Y;') THEN 'ADJ=Y;' WHEN contains(ind, 'ADJ=N;') THEN 'ADJ=N;' ELSE 'NA' END AS claim_indicator_adj,
  CASE WHEN contains(ind, 'BMP=E;') THEN 'E' WHEN contains(ind, 'BMP=EN;') THEN 'EN' WHEN contains(ind, 'BMP=EY;') THEN 'EY'
       WHEN contains(ind, 'BMP=N;') THEN 'N' WHEN contains(ind, 'BMP=O;') THEN 'O' ELSE 'NA' END AS claim_indicator_bmp,
  CASE WHEN contains(ind, 'FSER=F;') THEN 'FSER=F' ELSE 'NA' END AS claim_indicator_fser,
  CASE WHEN contains(ind, 'CFR=E401;') THEN 'CFR=E401' WHEN contains(ind, 'CFR=E404;') THEN 'CFR=E404'
       WHEN contains(ind, 'CFR=E411;') THEN 'CFR=E411' WHEN contains(ind, 'CFR=E416;') THEN 'CFR=E416' ELSE 'NA' END AS claim_indicator_cfr,
  CASE WHEN contains(ind, 'MRB=EF;') THEN 'E' WHEN contains(ind, 'MRB=EN;') THEN 'EN' WHEN contains(ind, 'MRB=EY;') THEN 'EY'
       WHEN contains(ind, 'MRB=EYCN;') THEN 'EYCN' WHEN contains(ind, 'MRB=EYCY;') THEN 'EYCY' WHEN contains(ind, 'MRB=NN;') THEN 'NN' ELSE 'NA' END AS claim_indicator_mrb,
  CASE WHEN contains(ind, 'OTP=E;') THEN 'OTP=E' WHEN contains(ind, 'OTP=EN;') THEN 'OTP=EN' WHEN contains(ind, 'OTP=EY;') THEN 'OTP=EY'
       WHEN contains(ind, 'OTP=N;') THEN 'OTP=N' ELSE 'NA' END AS claim_indicator_otp,
  CASE WHEN contains(ind, 'WAF=Y;') THEN 'WAF=Y' WHEN contains(ind, 'WAF=N;') THEN 'WAF=N' ELSE 'NA' END AS claim_indicator_waf
FROM lines
""")
def flag_decode(spark, folder):
    rows = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", f"{_INDICATOR} as ind"
    )
    return rows.withColumns(flags.decode_indicator(F.col("ind"))).drop("ind")


@query("q_conditional_remap", """
SELECT p_partkey,
  CASE WHEN p_partkey % 4 = 0 AND p_partkey % 6 <> 0 THEN CASE WHEN p_type = 'SMALL' THEN 'SML' ELSE p_type END
       WHEN p_partkey % 4 = 0 THEN 'Net eXTender' ELSE p_brand END AS network_cd
FROM part
""")
def conditional_remap(spark, folder):
    rows = table(spark, folder, "part").selectExpr(
        "p_partkey",
        "case when p_partkey % 4 = 0 then 'Net eXTender' else p_brand end as network",
        "case when p_partkey % 6 <> 0 then p_type end as product",
    )
    product = flags.remap(F.col("product"), {"SMALL": "SML"})
    return rows.select(
        "p_partkey", flags.overwrite_where_contains(F.col("network"), "Ext", product).alias("network_cd")
    )


@query("q_paid_flag", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN 1 ELSE 0 END AS paid_flag FROM orders
""")
def paid_flag(spark, folder):
    spelled = F.expr("case o_orderkey % 4 when 0 then 'Paid' when 1 then 'PAID' when 2 then 'unpaid' end")
    return table(spark, folder, "orders").select("o_orderkey", text.paid_flag(spelled).alias("paid_flag"))


@query("q_lenient_date", """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 9 < 6 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS parsed
FROM orders
""")
def lenient_date(spark, folder):
    raw = """case o_orderkey % 9
        when 0 then date_format(o_orderdate, 'yyyy-MM-dd')
        when 1 then date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')
        when 2 then date_format(o_orderdate, 'M/d/yyyy')
        when 3 then date_format(o_orderdate, 'd-MMM-yyyy')
        when 4 then date_format(o_orderdate, 'yyyyMMdd')
        when 5 then concat(' ', date_format(o_orderdate, 'M-d-yyyy'))
        when 6 then '0' when 7 then '' else '2020-13-45' end"""
    rows = table(spark, folder, "orders").selectExpr("o_orderkey", f"{raw} as raw")
    return rows.select("o_orderkey", dates.lenient_date(F.col("raw")).alias("parsed")).transform(iso_dates)


@query("q_date_parts", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month_label, CAST(year(o_orderdate) AS INTEGER) AS y,
       CAST(month(o_orderdate) AS INTEGER) AS m, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start
FROM orders
""")
def date_parts(spark, folder):
    day = F.to_date("o_orderdate")
    return (
        table(spark, folder, "orders")
        .select(
            "o_orderkey",
            dates.month_label(dates.month_of(day)).alias("month_label"),
            F.year(day).alias("y"),
            F.month(day).alias("m"),
        )
        .withColumn("month_start", dates.month_start(F.col("y"), F.col("m")))
        .transform(iso_dates)
    )


@query("q_claim_age", """
WITH aged AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0
    THEN CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '1999-06-30') AS INTEGER) END AS days_since_received
  FROM orders)
SELECT *, CASE WHEN days_since_received <= 30 THEN '0-30' WHEN days_since_received <= 90 THEN '31-90'
  WHEN days_since_received <= 180 THEN '91-180' WHEN days_since_received <= 365 THEN '181-365'
  WHEN days_since_received IS NOT NULL THEN '365+' END AS claim_age_bucket
FROM aged
""")
def claim_age(spark, folder):
    received = F.expr("case when o_orderkey % 10 <> 0 then cast(o_orderdate as date) end")
    as_of = F.to_date(F.lit("1999-06-30"))
    rows = table(spark, folder, "orders").select(
        "o_orderkey", dates.days_since(as_of, received).alias("days_since_received")
    )
    return rows.withColumn("claim_age_bucket", amounts.age_bucket(F.col("days_since_received")))


@query("q_amount_features", """
WITH a AS (
  SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal - 3000 END AS billed,
         CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey - 12 END AS noncovered FROM customer),
b AS (SELECT *, CASE WHEN billed < 0 THEN 0 ELSE billed END AS billed0,
             CASE WHEN noncovered < 0 THEN 0 ELSE noncovered END AS noncovered0 FROM a)
SELECT c_custkey, round(ln(1 + billed0), 8) AS log_billed, CASE WHEN noncovered > 0 THEN 1 ELSE 0 END AS has_noncovered,
       round(ln(1 + noncovered0), 8) AS log_noncovered, round(noncovered0 / (billed0 + 1.0), 12) AS noncovered_ratio
FROM b
""")
def amount_features(spark, folder):
    rows = table(spark, folder, "customer").selectExpr(
        "c_custkey",
        "case when c_custkey % 10 <> 0 then c_acctbal - 3000 end as billed",
        "case when c_custkey % 7 <> 0 then c_nationkey - 12 end as noncovered",
    )
    billed, noncovered = F.col("billed"), F.col("noncovered")
    return rows.select(
        "c_custkey",
        F.round(amounts.log_amount(billed), 8).alias("log_billed"),
        amounts.positive_flag(noncovered).alias("has_noncovered"),
        F.round(amounts.log_amount(noncovered), 8).alias("log_noncovered"),
        F.round(amounts.ratio_plus_one(noncovered, billed), 12).alias("noncovered_ratio"),
    )


@query("q_savings_rate", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_discount = 0 THEN 0.0 ELSE l_tax / l_discount END AS savings_rate
FROM lineitem
""")
def savings_rate(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        amounts.savings_rate(F.col("l_tax"), F.col("l_discount")).alias("savings_rate"),
    )


@query("q_inf_nan_clean", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_discount <> 0 THEN l_tax / l_discount WHEN l_tax > 0 THEN 1.0 ELSE 0.0 END AS rate
FROM lineitem
""")
def inf_nan_clean(spark, folder):
    raw = amounts.raw_ratio(F.col("l_tax"), F.col("l_discount"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", amounts.clean_infinite(raw).alias("rate")
    )


@query("q_code_map", """
SELECT o_orderkey,
  CASE o_custkey % 8 WHEN 1 THEN 'Married' WHEN 2 THEN 'Widowed' WHEN 3 THEN 'Divorced' WHEN 4 THEN 'Separated'
    WHEN 5 THEN 'Never married' WHEN 6 THEN '6' WHEN 7 THEN '7' END AS mar,
  CASE WHEN s = 0 THEN 'N/A' WHEN s = 1 THEN 'No schooling' WHEN s <= 7 THEN 'Pre-K to Grade 4' WHEN s <= 11 THEN 'Grade 5-8'
    WHEN s <= 15 THEN 'Grade 9-12 (no diploma)' WHEN s <= 17 THEN 'High School Graduate' WHEN s <= 19 THEN 'Some College'
    WHEN s = 20 THEN 'Associate''s' WHEN s = 21 THEN 'Bachelor''s' WHEN s <= 23 THEN 'Graduate Degree'
    ELSE CAST(s AS VARCHAR) END AS schl,
  CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS status
FROM (SELECT *, o_custkey % 26 AS s FROM orders)
""")
def code_map(spark, folder):
    rows = table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "cast(nullif(o_custkey % 8, 0) as string) as mar",
        "o_custkey % 26 as schl",
        "o_orderstatus as status",
    )
    return rows.select(
        "o_orderkey",
        codes.label_code(F.col("mar"), codes.CODE_BOOKS["MAR"]).alias("mar"),
        codes.label_code(F.col("schl"), codes.CODE_BOOKS["SCHL"]).alias("schl"),
        codes.label_code(F.col("status"), {"F": "Final", "O": "Open"}).alias("status"),
    )


@query("q_binary_label", """
SELECT c_custkey, CASE WHEN c_custkey % 6 <> 0 AND c_acctbal > 5000 THEN 1 ELSE 0 END AS income_label,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS used
FROM customer WHERE c_nationkey >= 16
""")
def binary_label(spark, folder):
    rows = table(spark, folder, "customer").filter(F.col("c_nationkey") >= 16)
    wage = F.expr("case when c_custkey % 6 <> 0 then c_acctbal end")
    spelled = F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" "))
    return rows.select(
        "c_custkey",
        amounts.above_threshold(wage, 5000).alias("income_label"),
        text.is_text(spelled, "HOUSEHOLD").alias("used"),
    )


@query("q_lenient_number", r"""
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
  ELSE CAST(regexp_extract(props, '(\d+)', 1) AS DOUBLE) END AS k
FROM events
""")
def lenient_number(spark, folder):
    raw = F.when(F.col("event_type") == "error", F.col("props")).otherwise(
        F.concat(F.lit(" "), F.regexp_extract("props", r"(\d+)", 1))
    )
    return table(spark, folder, "events").select("event_id", text.to_number(raw).alias("k"))


@query("q_align_columns", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0.0 ELSE o_totalprice END AS amount,
       0.0::DOUBLE AS never_seen, CAST(o_custkey AS DOUBLE) AS customer
FROM orders
""")
def align(spark, folder):
    rows = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "o_custkey as customer", "o_orderstatus as extra",
        "case when o_orderkey % 3 <> 0 then o_totalprice end as amount",
    )
    return align_columns(rows, ["amount", "never_seen", "customer"], keep=["o_orderkey"])
