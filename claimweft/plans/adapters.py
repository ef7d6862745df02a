"""Claims, ledger and link tables over the star-schema test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# claims column -> (table that holds it, expression)
CLAIM_COLUMNS = {
    "claim_id": ("lineitem", "cast(l_orderkey as string)"),
    "line_number": ("lineitem", "l_linenumber"),
    "part_key": ("lineitem", "l_partkey"),
    "supplier_key": ("lineitem", "l_suppkey"),
    "quantity": ("lineitem", "l_quantity"),
    "ship_dt": ("lineitem", "cast(l_shipdate as date)"),
    "payment_status": ("lineitem", "case when l_linestatus = 'F' then 'PAID' else 'UNPAID' end"),
    "entry_dt": ("lineitem", "case when l_linestatus = 'F' then cast(l_shipdate as date) end"),
    "adjustmentstatus": ("lineitem", "l_returnflag"),
    "total_charge_amt": ("lineitem", "cast(l_extendedprice as decimal(18,2))"),
    "savings_amt": ("lineitem", "cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2))"),
    "fee_amount": ("lineitem", "cast(l_tax as decimal(4,2)) * 100"),
    "processed_dt": ("orders", "cast(o_orderdate as date)"),
    "processed_month": ("orders", "date_format(o_orderdate, 'yyyy-MM')"),
    "claim_specialty": ("orders", "o_orderpriority"),
    "customer_key": ("orders", "o_custkey"),
    "client_cd": ("customer", "c_mktsegment"),
    "pcode": ("nation", "n_name"),
    "network_cd": ("part", "p_brand"),
    "claim_type": ("part", "p_type"),
}


def claims(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The asked claim columns; only the tables that hold them are joined.

    Every line item has its order, customer, nation and part, so leaving out an unused join
    loses no rows. The small side of the chain (orders with their client) is joined first.
    """
    columns = columns or tuple(CLAIM_COLUMNS)
    needed = {CLAIM_COLUMNS[c][0] for c in columns}
    rows = table(spark, folder, "lineitem")
    if needed & {"orders", "customer", "nation"}:
        header = table(spark, folder, "orders")
        if needed & {"customer", "nation"}:
            customer = table(spark, folder, "customer")
            if "nation" in needed:
                nation = table(spark, folder, "nation")
                customer = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
            header = header.join(customer, header.o_custkey == customer.c_custkey)
        rows = rows.join(header, rows.l_orderkey == header.o_orderkey)
    if "part" in needed:
        part = table(spark, folder, "part")
        rows = rows.join(part, rows.l_partkey == part.p_partkey)
    return rows.select(*[F.expr(CLAIM_COLUMNS[c][1]).alias(c) for c in columns])


CLAIMS_SQL = """claims AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS claim_id, l_linenumber AS line_number, l_partkey AS part_key,
         l_suppkey AS supplier_key, l_quantity AS quantity, CAST(l_shipdate AS DATE) AS ship_dt,
         CASE WHEN l_linestatus = 'F' THEN 'PAID' ELSE 'UNPAID' END AS payment_status,
         CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS entry_dt,
         l_returnflag AS adjustmentstatus,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS total_charge_amt,
         CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS savings_amt,
         CAST(l_tax AS DECIMAL(4,2)) * 100 AS fee_amount,
         CAST(o_orderdate AS DATE) AS processed_dt, strftime(o_orderdate, '%Y-%m') AS processed_month,
         o_orderpriority AS claim_specialty, o_custkey AS customer_key, c_mktsegment AS client_cd,
         n_name AS pcode, p_brand AS network_cd, p_type AS claim_type
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey)"""


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as accounting rows of the order they belong to."""
    price = "cast(l_extendedprice as decimal(18,2))"
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey as claim_number",
        f"{price} as billed_amount",
        f"case when l_linestatus = 'F' then {price} end as payments",
        f"case when l_returnflag = 'R' then {price} end as refunds",
        f"{price} * cast(l_discount as decimal(4,2)) as writeoffs",
        "case when l_linestatus = 'F' then 'PY' else 'IN' end as blart",
        "cast(l_shipdate as date) as budat",
        "l_returnflag as rev_specialist",
        "l_suppkey as gpart",
    )


LEDGER_AMOUNTS = ("billed_amount", "payments", "refunds", "writeoffs")

ROLLED_SQL = """rolled AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS claim_key,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS billed_amount_sum,
         CAST(SUM(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS payments_sum,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS refunds_sum,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS writeoffs_sum,
         COUNT(*) AS accounting_row_count,
         MAX(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS paid_flag,
         CAST(MIN(CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END) AS VARCHAR) AS first_payment_date,
         CAST(MIN(CAST(l_shipdate AS DATE)) AS VARCHAR) AS first_budat,
         CAST(MAX(CAST(l_shipdate AS DATE)) AS VARCHAR) AS last_budat,
         MAX(l_returnflag) AS rev_specialist, MAX(l_suppkey) AS gpart
  FROM lineitem GROUP BY l_orderkey)"""


def model_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as claims of the payment model, with NULLs and test records among them."""
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey as claimnumber",
        "cast(o_orderdate as date) as receiveddate",
        "case when o_custkey % 11 = 0 then null else o_totalprice - 50000 end as savings",
        "case when o_orderstatus = 'P' then 1009 else 1007 end as claimstatus",
        "case when o_custkey % 5 = 0 then null else cast(o_custkey * 100 as string) end as status_code",
        "case when o_custkey % 3 = 0 then null when o_custkey % 7 = 0 then 'a Test name' else 'Ann' end as patientfirstname",
        "case when o_custkey % 13 = 0 then 'testing' else 'Lee' end as patientlastname",
        "nullif(o_custkey, 8) as mpi_claim_id",
        "case when o_orderpriority = '5-LOW' then 2000 when o_orderpriority = '1-URGENT' then 0 else 2004 end as adjustmentstatus",
        "case when o_custkey % 17 = 0 then null else add_months(cast(o_orderdate as date), cast(-12 * (o_custkey % 90) as int)) end as patientdateofbirth",
        "o_custkey as provider",
        "o_orderpriority as claim_type",
    )


def published_files(spark: SparkSession, folder: str) -> DataFrame:
    """One download link per order: the order date in one of several spellings in the file name."""
    d = "cast(o_orderdate as date)"
    stamp = f"""case o_orderkey % 6
        when 0 then date_format({d}, 'M-d-yyyy')
        when 1 then date_format({d}, 'M_d_yyyy')
        when 2 then date_format({d}, 'MM.dd.yyyy')
        when 3 then date_format({d}, 'MMddyyyy')
        when 4 then concat('CY', cast(year({d}) as string))
        else '13-45-2020' end"""
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey as position",
        "o_custkey as site",
        f"concat('https://files.example.org/Data/Details_', {stamp}, '.xlsx?v=1#top') as href",
        "concat('Technical Details (XLSX) ', o_orderpriority) as text",
    )


PUBLISHED_SQL = """published AS (
  SELECT o_orderkey AS position, o_custkey AS site,
         'https://files.example.org/Data/Details_' || CASE o_orderkey % 6
           WHEN 0 THEN strftime(o_orderdate, '%-m-%-d-%Y')
           WHEN 1 THEN strftime(o_orderdate, '%-m_%-d_%Y')
           WHEN 2 THEN strftime(o_orderdate, '%m.%d.%Y')
           WHEN 3 THEN strftime(o_orderdate, '%m%d%Y')
           WHEN 4 THEN 'CY' || CAST(year(o_orderdate) AS VARCHAR)
           ELSE '13-45-2020' END || '.xlsx?v=1#top' AS href,
         'Technical Details (XLSX) ' || o_orderpriority AS text
  FROM orders)"""

# names hold years 20xx only for part of the orders; the others have no usable date
DATED_SQL = """dated AS (
  SELECT *, CASE
      WHEN year(o_orderdate) >= 2000 AND year(o_orderdate) < 2100 AND o_orderkey % 6 < 4
      THEN CAST(o_orderdate AS DATE) END AS posted,
    nullif(regexp_extract(lower(text || ' ' || href), '20[0-9][0-9]'), '') AS plain_year
  FROM published JOIN orders ON position = o_orderkey)"""


def page_links(spark: SparkSession, folder: str) -> DataFrame:
    from claimweft.operators.links import extract_links

    return extract_links(table(spark, folder, "pages"))


LINKS_SQL = r"""links AS (
  SELECT page_id, position - 1 AS position, trim(hrefs[position]) AS href,
         trim(regexp_replace(texts[position], '<[^>]*>', '', 'g')) AS text
  FROM (SELECT page_id, hrefs, texts, unnest(range(1, len(hrefs) + 1)) AS position
        FROM (SELECT page_id,
                regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1) AS hrefs,
                regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 2) AS texts
              FROM pages))
  WHERE trim(hrefs[position]) <> '')"""


def iso_dates(df: DataFrame) -> DataFrame:
    """Dates as ISO text, for reports."""
    return df.withColumns({c: F.col(c).cast("string") for c, t in df.dtypes if t == "date"})


def as_double(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, for reports."""
    return df.withColumns({c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")})
