"""Raw-to-staging projections: renames and column-level transforms, one output column per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.mapping import marker, sales_role

# Raw column name -> staging column name, for columns that are only renamed.
CUSTOMER_RENAMES = {
    "CUST_NBR": "CUSTOMER_ID",
    "REGION_KEY": "REGION_CODE",
    "TEL_NBR_1": "PRIMARY_PHONE",
    "ANNUAL_SALES": "ANNUAL_REVENUE",
    "CENTRAL_SALES_BLK": "SALES_BLOCK_FLAG",
    "ADRS_NBR": "ADDRESS_ID",
    "ACCT_GRP": "ACCOUNT_GROUP",
    "CENTRAL_POST_BLK": "POSTING_BLOCK_FLAG",
    "CENTRAL_ORDR_BLK": "ORDER_BLOCK_FLAG",
    "SALES_REP_CMPNY_CD": "SALES_COMPANY_CODE",
    "CREATED_BY": "CREATED_USER",
    "FIVETRANSYNC_DATE": "FIVETRANSYNC_DATE",
}
MATERIAL_RENAMES = {
    "PRODUCT": "M_NBR",
    "PRODHIERARCHY": "LVL_CD",
    "PRODGROUP": "M_GRP",
    "PRODOLDID": "OM_NBR",
    "PRODTYPE": "M_TP",
    "TSHELFLIFE": "T_SH_LF",
    "MSHELF": "M_SH_LF",
}
# The order of the staging columns.
CUSTOMER_COLUMNS = [
    "CUSTOMER_ID",
    "ADDRESS",
    "REGION_CODE",
    "PRIMARY_PHONE",
    "ANNUAL_REVENUE",
    "SALES_BLOCK_FLAG",
    "ADDRESS_ID",
    "ACCOUNT_GROUP",
    "POSTING_BLOCK_FLAG",
    "LANGUAGE_CODE",
    "ORDER_BLOCK_FLAG",
    "SALES_REP_TYPE",
    "SALES_REP_ROLE",
    "SALES_COMPANY_CODE",
    "SALES_REP_NAME",
    "CREATED_USER",
    "CREATED_TIMESTAMP",
    "FIVETRANSYNC_DATE",
]
MATERIAL_COLUMNS = ["M_NBR", "LVL_CD", "M_GRP", "OM_NBR", "M_TP", "T_SH_LF", "M_SH_LF", "BA_UOM", "B_M_IND"]
CUSTOMER_KEY = "CUSTOMER_ID"
MATERIAL_KEY = "M_NBR"
SYNC_COLUMN = "FIVETRANSYNC_DATE"


def project(raw: DataFrame, renames: dict[str, str], computed: dict[str, Column], order: list[str]) -> DataFrame:
    """Select renamed and computed columns of a raw table in the given order."""
    columns = {new: F.col(old) for old, new in renames.items()} | computed
    return raw.select(*[columns[name].alias(name) for name in order])


def stage_customers(raw: DataFrame) -> DataFrame:
    """Customer master data in staging form; the address is null when any of its parts is."""
    blank = F.lit(" ")
    return project(
        raw,
        CUSTOMER_RENAMES,
        {
            "ADDRESS": F.concat("STREET", blank, "CITY", blank, "PO_CD"),
            "LANGUAGE_CODE": F.trim("LANG_KEY"),
            "SALES_REP_TYPE": F.replace(F.col("SALES_REP_TP"), F.lit("C"), F.lit("Z")),
            "SALES_REP_ROLE": sales_role(F.col("SALES_REP_ROLE_CLASSIFICATION")),
            "SALES_REP_NAME": F.lower("SALES_REP_MISC_CD"),
            "CREATED_TIMESTAMP": F.date_format("CREATED_DT", "yyyy-MM-dd"),
        },
        CUSTOMER_COLUMNS,
    )


def stage_material(raw: DataFrame) -> DataFrame:
    """Material master data in staging form."""
    return project(
        raw,
        MATERIAL_RENAMES,
        {"BA_UOM": F.upper("BUNIT"), "B_M_IND": marker(F.col("ISBMREQUIRED"), "True")},
        MATERIAL_COLUMNS,
    )
