"""Work-lists for account managers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweft.functions.text import zip3
from claimweft.operators.columns import keep_columns
from claimweft.operators.filters import received_after

# Columns of the work-list, in output order.
WORKLIST_COLUMNS = (
    "CLIENT_CD", "CLAIM_ID", "SUBMITTERCLAIMNUMBER", "CLIENT_ADJUSTMENT_CLAIM_NUMBER",
    "FIRST_DOS", "RECEIVED_DT", "MEMBER_ID", "PATIENT_FIRST_NM", "PATIENT_LAST_NM",
    "PATIENT_BIRTH_DT", "SOURCE_CD", "TOTAL_CHARGE_AMT", "SAVINGS_AMT", "ALLOWED_CHARGE_AMT",
    "APPEALED_FLAG", "CLAIM_INDICATOR", "CLAIM_SPECIALTY", "CLAIM_TYPE", "CLIENT_NM",
    "CONTRACT_TYPE", "LAST_CLOSURE_NETWORK_CD", "MBM_VALID_CHARGES", "MPI_SURPRISE_BILL_IND",
    "PARENTCLIENTCODE", "POS_DESCRIPTION_HCE", "CITY_NM", "PROVIDER_STATE",
    "PROVIDER_STATE_RENDERING", "PROVIDER_COUNTY_NAME", "PROVIDER_ZIP_CODE",
    "PROVIDERGROUPNAME", "REASONABLE_AND_CUSTOMARY_AMT", "RENDERING_PROVIDER_TIN",
    "ORIGINAL_PROVIDER_TAX_ID", "PROVIDER_NPI", "BNR_TRANSACTIONTYPE", "ZIP3", "PAYMENT_STATUS",
)
ID_COLUMNS = ("CLAIM_ID", "SUBMITTERCLAIMNUMBER", "CLIENT_ADJUSTMENT_CLAIM_NUMBER")


def unpaid_worklist(
    claims: DataFrame,
    after: str,
    columns: Sequence[str] = WORKLIST_COLUMNS,
    zip_col: str = "provider_zip_code",
    received: str = "received_dt",
) -> DataFrame:
    """Unpaid claims with savings received after a day; ids as text, ZIP3 added."""
    rows = claims.filter((F.col("payment_status") == "UNPAID") & (F.col("savings_amt") > 0))
    rows = received_after(rows, received, after).withColumn("zip3", zip3(F.col(zip_col)))
    rows = keep_columns(rows, columns)
    ids = [c for c in rows.columns if c.upper() in ID_COLUMNS]
    return rows.withColumns({c: F.col(c).cast("string") for c in ids})
