"""Table schemas and key columns."""

from __future__ import annotations

# Header spellings of a raw statement landing, by the name used inside.
RAW_HEADERS = {
    "organisation_name": ["OrganisationName", "Organisation Name"],
    "worksheet_name": ["WorkSheetName"],
    "table_id": ["TableID"],
    "main_code": ["MainCode"],
    "row_num": ["RowNumber"],
    "sub_code": ["SubCode"],
    "total": ["Total", "Value number", "Value Number"],
}

# Header spellings of a provider landing; surrounding blanks are ignored.
PROVIDER_HEADERS = {
    "organisation_name": ["Full name of Provider"],
    "org_code": ["NHS code"],
    "region": ["Region"],
    "sector": ["Sector"],
    "comments": ["Comments"],
}

SCOPE = ["financial_year", "trust_type"]
FACT_KEY = ["org_code", "financial_year", "main_code", "sub_code"]
ORG_YEAR = ["org_code", "financial_year"]
ORG_ATTRIBUTES = ["organisation_name", "sector", "region", "trust_type"]
VIEW_KEY = ["org_code", "organisation_name", "sector", "region", "trust_type", "financial_year"]

STAGED_SCHEMA = (
    "organisation_name string, worksheet_name string, table_id smallint, main_code string, "
    "row_num int, sub_code string, total bigint, source_file string, trust_type string, "
    "financial_year string, year_type string"
)
PROVIDER_SCHEMA = (
    "organisation_name string, org_code string, region string, sector string, comments string, "
    "source_file string, trust_type string, financial_year string"
)
TRUST_SCHEMA = (
    "org_code string, organisation_name string, trust_type string, sector string, region string, "
    "is_foundation int, first_year_seen string, last_year_seen string"
)
FACT_SCHEMA = (
    "org_code string, financial_year string, worksheet_name string, table_id smallint, "
    "main_code string, sub_code string, total_000s bigint, trust_type string, source_file string"
)

# Stored beside the columns above: who wrote a row last, and when. ``batch_id`` names the commit.
STAMPED_FACT_SCHEMA = FACT_SCHEMA + ", org_bucket int, batch_id string, load_ts timestamp"
STAMPED_TRUST_SCHEMA = TRUST_SCHEMA + ", batch_id string, updated_ts timestamp"
YEAR_SCHEMA = "financial_year string, start_date date, end_date date, year_label_short string, is_complete int"
