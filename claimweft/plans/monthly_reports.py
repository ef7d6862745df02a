"""The monthly claim reporting job, for all clients in one run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from claimweft.functions.amounts import clean_infinite
from claimweft.functions.dates import lenient_date, month_label
from claimweft.functions.flags import decode_indicator, overwrite_where_contains, remap
from claimweft.functions.text import strip_non_word
from claimweft.operators.booking import curve_of_cells, status_of_cells
from claimweft.operators.columns import zero_missing
from claimweft.operators.dedupe import EVENT_KEYS, priority_dedupe
from claimweft.operators.filters import claim_population, exclude_values
from claimweft.operators.joins import dedupe_dimension, eligible_only
from claimweft.operators.revenue import (
    booked_cells, month_client_status, month_client_status_of, remaining_to_pay, report_cells, revenue_by_rate_dim_of, status_pivot,
)
from claimweft.plans.worklists import WORKLIST_COLUMNS, unpaid_worklist
from claimweft.session import stage_table
from claimweft.sources.files import write_per_client


def typed_extract(
    raw: DataFrame, dates: Sequence[str], amounts: Sequence[str], quality: Observation | None = None
) -> DataFrame:
    """Text extract to dates and amounts; junk becomes NULL.

    ``quality`` is told, by whatever writes or reads the rows first, the number of rows and how many
    texts of each column gave no value (``unparsed_<column>``); no pass of its own is made. In Spark 4.1 a
    logistic model cannot score in the session it was fitted in once that session has observed
    rows, so extracts that are counted are best read in a session of their own (``spark.newSession()``).
    """
    money = {c: F.col(c).try_cast("decimal(18,2)") for c in amounts}
    parsed = {**{c: lenient_date(F.col(c)) for c in dates}, **money}
    if quality is not None:
        filled = {c: ~F.coalesce(F.trim(F.col(c).cast("string")).isin("", "0"), F.lit(True)) for c in parsed}
        lost = [F.count_if(filled[c] & value.isNull()).alias(f"unparsed_{c}") for c, value in parsed.items()]
        raw = raw.observe(quality, F.count("*").alias("n_rows"), *lost)
    return raw.withColumns(parsed)


def clean_claims(
    typed: DataFrame,
    excluded_clients: Sequence[str] = (),
    eligible: DataFrame | None = None,
    product_names: Mapping[str, str] | None = None,
    network_names: Mapping[str, str] | None = None,
    tie: Sequence[str] = ("claim_id",),
) -> DataFrame:
    """Population filter, text clean-up, indicator columns, one row per event.

    Either a list of clients is excluded, or only (client, network) pairs of the fee
    dimension stay (columns ccode, productcode, feetype).
    """
    rows = claim_population(typed).withColumns(
        {
            "contract_name": strip_non_word(F.col("contract_name")),
            "provider_state": F.upper("provider_state"),
            **decode_indicator(F.col("claim_indicator")),
        }
    )
    doubles = [c for c, t in rows.dtypes if t in ("double", "float")]
    rows = rows.withColumns({c: clean_infinite(F.col(c)) for c in doubles})
    rows = priority_dedupe(rows, EVENT_KEYS, tie=tie)
    if eligible is None:
        return exclude_values(rows, "client_cd", excluded_clients) if excluded_clients else rows
    dim = eligible.withColumn("productcode", remap(F.col("productcode"), product_names or {}))
    dim = dedupe_dimension(dim, ["productcode", "ccode"], "feetype")
    network = remap(F.col("last_closure_network_cd"), network_names or {})
    rows = rows.withColumn(
        "last_closure_network_cd", overwrite_where_contains(network, "Ext", F.col("productcode"))
    )
    return eligible_only(rows, dim, {"client_cd": "ccode", "last_closure_network_cd": "productcode"})


def export_form(cleaned: DataFrame, strict_compat: bool = False) -> DataFrame:
    """Blanket fill of missing values, the last projection before writing."""
    return zero_missing(cleaned, strict_compat)


def summary(claims: DataFrame) -> DataFrame:
    """Status summary per client and month with revenue bounds and what remains to be paid.

    Claims need processed_dt, network_cd and a numeric fee_amount.
    """
    rows = claims.withColumn("processed_month", month_label(F.col("processed_dt")))
    return summary_of_cells(month_client_status(rows))


def summary_of_cells(cells: DataFrame) -> DataFrame:
    return remaining_to_pay(status_pivot(cells, ["pcode", "processed_month"]))


def write_reports(
    claims: DataFrame, root: str, pull_date: str, rates: DataFrame | None = None, worklist_after: str | None = None
) -> dict[str, str]:
    """All reports of a pull, one folder per client and pull date under one folder per report.

    Booking curve (long), booking status and summary; with ``rates`` the rate-table revenue; with
    ``worklist_after`` the unpaid claims received after that day. The claims are read once: every
    table of counts follows from one staged table of cells, and the work-list, whose rows are claims,
    is written from the claims that the cells were counted on.
    """
    if worklist_after is not None:
        claims = stage_table(claims, "report-claims")
    cells = stage_table(report_cells(claims), "report-cells")
    booked = booked_cells(cells)
    reports = {
        "booking_curve": curve_of_cells(booked),
        "booking_status": status_of_cells(booked),
        "summary_stats": summary_of_cells(month_client_status_of(cells)),
    }
    if rates is not None:
        reports["rate_revenue"] = revenue_by_rate_dim_of(cells, rates)
    if worklist_after is not None:
        known = {c.lower() for c in [*claims.columns, "zip3"]}
        reports["worklist"] = unpaid_worklist(claims, worklist_after, ["pcode", *[c for c in WORKLIST_COLUMNS if c.lower() in known]])
    paths = {}
    for name, df in reports.items():
        paths[name] = f"{root}/{name}"
        write_per_client(df.withColumn("pull_date", F.lit(pull_date)), paths[name])
    return paths

