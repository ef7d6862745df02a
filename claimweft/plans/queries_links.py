"""Link mining and record counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimweft.operators import links
from claimweft.operators.dedupe import first_seen
from claimweft.plans.adapters import (
    DATED_SQL, LINKS_SQL, PUBLISHED_SQL, iso_dates, page_links, published_files, table,
)
from claimweft.plans.registry import query


@query("q_link_extract", f"WITH {LINKS_SQL} SELECT page_id, position, href, text FROM links")
def link_extract(spark, folder):
    return page_links(spark, folder).withColumn("position", F.col("position").cast("long"))


@query("q_link_filter", f"WITH {LINKS_SQL} SELECT page_id, position, href, text FROM links WHERE href LIKE '%e' AND contains(text, 'e')")
def link_filter(spark, folder):
    found = links.extract_links(table(spark, folder, "pages"), extensions=["e"], text_contains="e")
    return found.withColumn("position", F.col("position").cast("long"))


@query("q_date_from_name", f"WITH {PUBLISHED_SQL}, {DATED_SQL} SELECT position, CAST(posted AS VARCHAR) AS posted FROM dated")
def date_from_name(spark, folder):
    rows = published_files(spark, folder)
    return rows.select("position", links.posted_date(F.col("href")).alias("posted")).transform(iso_dates)


@query("q_year_from_text", f"WITH {PUBLISHED_SQL}, {DATED_SQL} SELECT position, plain_year AS year FROM dated")
def year_from_text(spark, folder):
    rows = published_files(spark, folder)
    return rows.select("position", links.named_year(F.col("href"), F.col("text")).alias("year"))


@query("q_latest_link", f"""
WITH {PUBLISHED_SQL}, {DATED_SQL}
SELECT site, href, text, CAST(posted AS VARCHAR) AS posted, plain_year AS year FROM dated
QUALIFY row_number() OVER (PARTITION BY site ORDER BY (posted IS NOT NULL) DESC, posted DESC NULLS LAST,
  CASE WHEN posted IS NULL THEN COALESCE(CAST(plain_year AS INTEGER), -1) END DESC NULLS LAST,
  CASE WHEN posted IS NULL THEN href END DESC NULLS LAST, position DESC) = 1
""")
def latest_link(spark, folder):
    return links.latest_link(published_files(spark, folder), ["site"]).transform(iso_dates)


@query("q_latest_year_page", """
WITH l AS (SELECT o_custkey AS site, o_orderkey AS position, CAST(year(o_orderdate) + 6 AS VARCHAR) AS year,
                  '/data/' || CAST(year(o_orderdate) + 6 AS VARCHAR) || '-model-software?o=' || CAST(o_orderkey AS VARCHAR) AS href
           FROM orders)
SELECT site, year, href FROM l WHERE year LIKE '20%'
QUALIFY row_number() OVER (PARTITION BY site ORDER BY year DESC, position DESC) = 1
""")
def latest_year_page(spark, folder):
    rows = table(spark, folder, "orders").selectExpr(
        "o_custkey as site", "o_orderkey as position",
        "concat('/data/', cast(year(o_orderdate) + 6 as string), '-model-software?o=', cast(o_orderkey as string)) as href",
    )
    return links.latest_year_page(rows, ["site"])


@query("q_first_seen_dedupe", f"""
WITH {LINKS_SQL}
SELECT href, page_id, position FROM links QUALIFY row_number() OVER (PARTITION BY href ORDER BY page_id, position) = 1
""")
def first_seen_dedupe(spark, folder):
    rows = page_links(spark, folder).withColumn("position", F.col("position").cast("long"))
    return first_seen(rows, "href", ["page_id", "position"])


@query("q_next_iteration", """
SELECT d.doc_id AS conv_id, COALESCE(MAX(turn), 0) + 1 AS next_iteration, COUNT(turn) AS n_records
FROM documents d LEFT JOIN conversations c ON d.doc_id = c.conv_id GROUP BY d.doc_id
""")
def next_iteration(spark, folder):
    projects = table(spark, folder, "documents").select(F.col("doc_id").alias("conv_id"))
    return links.next_iteration(table(spark, folder, "conversations"), projects, "conv_id", "turn")
