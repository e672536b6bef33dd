"""Fixed values of the published statutory-accounts format, stated as plain tables.

These must equal the format's own codes and labels for results to be right.
The longer per-schedule code list is not stated here: it is built from template
sheets by ``operators.dictionary``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerwide.sources.literal import literal_table

# Schedules read by the gold views.
SOCI = "TAC02 SoCI"
SOFP = "TAC03 SoFP"
INCOME_1 = "TAC06 Op Inc 1"
INCOME_2 = "TAC07 Op Inc 2"
EXPENDITURE = "TAC08 Op Exp"
STAFF = "TAC09 Staff"

# Worksheet name, title, category, code prefix.
WORKSHEETS = [
    ("TAC02 SoCI", "Statement of Comprehensive Income", "SUMMARY", "SCI"),
    ("TAC03 SoFP", "Statement of Financial Position", "BALANCE_SHEET", "BAL"),
    ("TAC04 SOCIE", "Statement of Changes in Equity", "EQUITY", "SCE"),
    ("TAC05 SoCF", "Statement of Cash Flows", "CASH_FLOW", "SCF"),
    ("TAC06 Op Inc 1", "Operating Income from Patient Care", "INCOME", "INC0"),
    ("TAC07 Op Inc 2", "Other Operating Income", "INCOME", "INC1"),
    ("TAC08 Op Exp", "Operating Expenditure", "EXPENDITURE", "EXP"),
    ("TAC09 Staff", "Staff Costs and WTE Numbers", "STAFF", "STA"),
    ("TAC11 Finance & other", "Finance Income, Expense and PDC", "FINANCE", "FIN"),
    ("TAC12 Impairment", "Asset Impairments", "OTHER", "IMP"),
    ("TAC13 Intangibles", "Intangible Assets", "BALANCE_SHEET", "INT"),
    ("TAC14 PPE", "Property Plant and Equipment", "BALANCE_SHEET", "PPE"),
    ("TAC14A RoU Assets", "Right-of-Use Assets (IFRS 16)", "BALANCE_SHEET", "ROU"),
    ("TAC14X RoU Assets PY", "Right-of-Use Assets (IFRS 16) — Prior Year", "BALANCE_SHEET", "ROU"),
    ("TAC15 Investments & groups", "Investments in Joint Ventures and Associates", "BALANCE_SHEET", "IGR"),
    ("TAC16 AHFS", "Assets Held for Sale and Disposal Groups", "BALANCE_SHEET", "AHF"),
    ("TAC17 Inventories", "Inventories", "BALANCE_SHEET", "INV"),
    ("TAC18 Receivables", "Receivables and Debtors", "BALANCE_SHEET", "REC"),
    ("TAC19 CCE", "Cash and Cash Equivalents", "BALANCE_SHEET", "CCE"),
    ("TAC20 Payables", "Payables and Creditors", "BALANCE_SHEET", "PAY"),
    ("TAC21 Borrowings", "Borrowings", "BALANCE_SHEET", "BOR"),
    ("TAC22 Provisions", "Provisions for Liabilities", "BALANCE_SHEET", "PRV"),
    ("TAC24 On-SoFP PFI", "On-SoFP PFI and Other Service Concessions", "BALANCE_SHEET", "PFI"),
    ("TAC25 Off-SoFP PFI", "Off-SoFP PFI Residual Interests", "OTHER", "PFI"),
    ("TAC26 Pension", "Pension Liabilities", "BALANCE_SHEET", "PEN"),
    ("TAC27 Fin Inst", "Financial Instruments", "OTHER", "FI"),
    ("TAC28 Disclosures", "Statutory Disclosures (NHS Trusts only)", "OTHER", "DIS"),
    ("TAC29 Losses+SP", "Losses and Special Payments", "OTHER", "LSP"),
]

# Sub code, worksheet, description, expected sign, unit, subtotal flag, category.
CURATED_CODES = [
    ("SCI0100A", SOCI, "Operating income from patient care activities", "+", "£000", 1, "PATIENT_INCOME"),
    ("SCI0110A", SOCI, "Other operating income", "+", "£000", 1, "OTHER_INCOME"),
    ("SCI0125A", SOCI, "Operating expenses (total)", "-", "£000", 1, "TOTAL_EXPENDITURE"),
    ("SCI0140A", SOCI, "Operating surplus / (deficit)", "+/-", "£000", 1, "OPERATING_SURPLUS"),
    ("SCI0150", SOCI, "Finance income", "+", "£000", 0, None),
    ("SCI0160", SOCI, "Finance expense", "-", "£000", 0, None),
    ("SCI0170", SOCI, "PDC dividend expense", "-", "£000", 0, None),
    ("SCI0240", SOCI, "Surplus / (deficit) for the year", "+/-", "£000", 1, "NET_SURPLUS"),
    ("SOC0190", SOCI, "Total comprehensive income / (expense)", "+/-", "£000", 1, None),
    ("INC0197", INCOME_1, "API income - Variable (acute)", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0198", INCOME_1, "API income - Fixed (acute)", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0200", INCOME_1, "High cost drugs income from commissioners", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0210", INCOME_1, "Other NHS clinical income (acute)", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0231", INCOME_1, "API income (mental health)", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0302", INCOME_1, "API income (community)", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0330", INCOME_1, "Private patient income", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0332", INCOME_1, "Pay award central funding", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0340", INCOME_1, "Other clinical income", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0350", INCOME_1, "Total income from patient care activities", "+", "£000", 1, "PATIENT_INCOME"),
    ("INC1100", INCOME_1, "Patient care income from NHS England", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC1115", INCOME_1, "Patient care income from Integrated Care Boards", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC1140", INCOME_1, "Patient care income from Local Authorities", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC1170", INCOME_1, "Non-NHS: private patients", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC1220", INCOME_1, "Total income from patient care (by source)", "+", "£000", 1, "PATIENT_INCOME"),
    ("INC1230A", INCOME_2, "Research and development income (IFRS 15)", "+", "£000", 0, "OTHER_INCOME"),
    ("INC1240A", INCOME_2, "Education and training income", "+", "£000", 0, "OTHER_INCOME"),
    ("INC1280A", INCOME_2, "Non-patient care services to other bodies", "+", "£000", 0, "OTHER_INCOME"),
    ("INC1360", INCOME_2, "Total other operating income", "+", "£000", 1, "OTHER_INCOME"),
    ("INC1365", INCOME_2, "Total operating income", "+", "£000", 1, "TOTAL_INCOME"),
    ("EXP0100", EXPENDITURE, "Purchase of healthcare from NHS bodies", "+", "£000", 0, "NON_PAY"),
    ("EXP0110", EXPENDITURE, "Purchase of healthcare from non-NHS bodies", "+", "£000", 0, "NON_PAY"),
    ("EXP0130", EXPENDITURE, "Staff and executive directors costs", "+", "£000", 0, "PAY"),
    ("EXP0140", EXPENDITURE, "Non-executive directors costs", "+", "£000", 0, "PAY"),
    ("EXP0150", EXPENDITURE, "Supplies and services - clinical", "+", "£000", 0, "NON_PAY"),
    ("EXP0160", EXPENDITURE, "Supplies and services - general", "+", "£000", 0, "NON_PAY"),
    ("EXP0170", EXPENDITURE, "Drugs costs", "+", "£000", 0, "NON_PAY"),
    ("EXP0190", EXPENDITURE, "Consultancy", "+", "£000", 0, "NON_PAY"),
    ("EXP0200", EXPENDITURE, "Establishment costs", "+", "£000", 0, "NON_PAY"),
    ("EXP0210", EXPENDITURE, "Premises - business rates", "+", "£000", 0, "NON_PAY"),
    ("EXP0220", EXPENDITURE, "Premises - other", "+", "£000", 0, "NON_PAY"),
    ("EXP0240", EXPENDITURE, "Depreciation", "+", "£000", 0, "NON_PAY_EXCL_EBITDA"),
    ("EXP0250", EXPENDITURE, "Amortisation", "+", "£000", 0, "NON_PAY_EXCL_EBITDA"),
    ("EXP0260", EXPENDITURE, "Impairments net of reversals", "+/-", "£000", 0, "NON_PAY_EXCL_EBITDA"),
    ("EXP0290A", EXPENDITURE, "Clinical negligence premium (NHS Resolution)", "+", "£000", 0, "NON_PAY"),
    ("EXP0300", EXPENDITURE, "Research and development - staff costs", "+", "£000", 0, "PAY"),
    ("EXP0320", EXPENDITURE, "Education and training - staff costs", "+", "£000", 0, "PAY"),
    ("EXP0350", EXPENDITURE, "Redundancy costs - staff", "+", "£000", 0, "PAY"),
    ("EXP0370", EXPENDITURE, "PFI / LIFT charges (on-SoFP)", "+", "£000", 0, "NON_PAY"),
    ("EXP0390", EXPENDITURE, "Total operating expenditure", "+", "£000", 1, "TOTAL_EXPENDITURE"),
    ("STA0220", STAFF, "Total gross staff costs", "+", "£000", 1, "PAY"),
    ("STA0250", STAFF, "Total staff costs (net of recoveries)", "+", "£000", 1, "PAY"),
    ("STA0310", STAFF, "Medical and dental WTE", "+", "No.", 0, "STAFF_WTE"),
    ("STA0330", STAFF, "Administration and estates WTE", "+", "No.", 0, "STAFF_WTE"),
    ("STA0340", STAFF, "Healthcare assistants WTE", "+", "No.", 0, "STAFF_WTE"),
    ("STA0350", STAFF, "Nursing, midwifery and health visiting WTE", "+", "No.", 0, "STAFF_WTE"),
    ("STA0370", STAFF, "Scientific, therapeutic and technical WTE", "+", "No.", 0, "STAFF_WTE"),
    ("STA0410", STAFF, "Total average WTE", "+", "No.", 1, "STAFF_WTE"),
    ("STA0530", STAFF, "Total days lost to sickness", "+", "No.", 0, "STAFF_WTE"),
    ("STA0550", STAFF, "Average working days lost per WTE", "+", "No.", 0, "STAFF_WTE"),
]

# Schedules whose codes are curated above, and the one schedule whose
# codes repeat another's. Template extraction skips both.
CURATED_WORKSHEETS = [SOCI, INCOME_1, INCOME_2, EXPENDITURE, STAFF]
COLLIDING_WORKSHEETS = ["TAC14X RoU Assets PY"]

# Code -> column of the income statement.
PROFIT_AND_LOSS_LINES = {
    "SCI0100A": "patient_care_income_000s",
    "SCI0110A": "other_operating_income_000s",
    "SCI0125A": "operating_expenses_000s",
    "SCI0140A": "operating_surplus_000s",
    "SCI0150": "finance_income_000s",
    "SCI0160": "finance_expense_000s",
    "SCI0170": "pdc_dividend_expense_000s",
    "SCI0180": "net_finance_costs_000s",
    "SCI0190A": "other_gains_losses_000s",
    "SCI0200": "share_of_associates_jv_000s",
    "SCI0210": "gains_losses_transfers_absorption_000s",
    "SCI0230": "corporation_tax_expense_000s",
    "SCI0240A": "surplus_continuing_operations_000s",
    "SCI0240B": "surplus_discontinued_operations_000s",
    "SCI0240": "surplus_for_year_000s",
    "SOC0100": "oci_impairments_000s",
    "SOC0110": "oci_revaluations_000s",
    "SOC0120": "oci_share_ci_associates_jv_000s",
    "SOC0125": "oci_fv_gains_equity_instruments_000s",
    "SOC0130": "oci_other_gains_losses_000s",
    "SOC0140": "oci_pension_remeasurement_000s",
    "SOC0145": "oci_gain_loss_transfers_absorption_000s",
    "SOC0150": "oci_other_reserve_movements_000s",
    "SOC0160": "oci_fv_gains_financial_assets_000s",
    "SOC0170": "oci_recycling_gains_disposal_000s",
    "SOC0180": "oci_foreign_exchange_gains_000s",
    "SOC0190": "total_comprehensive_income_000s",
}

# Code -> column of the balance sheet.
BALANCE_SHEET_LINES = {
    "BAL1100": "intangible_assets_000s",
    "BAL1110": "property_plant_equipment_000s",
    "BAL1115": "right_of_use_assets_000s",
    "BAL1120": "investment_property_000s",
    "BAL1130": "investments_jv_associates_000s",
    "BAL1140": "other_investments_nca_000s",
    "BAL1150": "receivables_nca_000s",
    "BAL1170": "other_assets_nca_000s",
    "BAL1180": "total_non_current_assets_000s",
    "BAL1190": "inventories_000s",
    "BAL1200": "receivables_ca_000s",
    "BAL1210": "other_investments_ca_000s",
    "BAL1220": "other_assets_ca_000s",
    "BAL1230": "assets_held_for_sale_000s",
    "BAL1240": "cash_and_cash_equivalents_000s",
    "BAL1250": "total_current_assets_000s",
    "BAL1260": "payables_cl_000s",
    "BAL1270": "borrowings_cl_000s",
    "BAL1280": "other_financial_liabilities_cl_000s",
    "BAL1290": "provisions_cl_000s",
    "BAL1300": "other_liabilities_cl_000s",
    "BAL1310": "liabilities_disposal_groups_000s",
    "BAL1320": "total_current_liabilities_000s",
    "BAL1330": "total_assets_less_current_liabilities_000s",
    "BAL1340": "payables_ncl_000s",
    "BAL1350": "borrowings_ncl_000s",
    "BAL1360": "other_financial_liabilities_ncl_000s",
    "BAL1370": "provisions_ncl_000s",
    "BAL1380": "other_liabilities_ncl_000s",
    "BAL1390": "total_non_current_liabilities_000s",
    "BAL1400": "total_assets_employed_000s",
    "BAL1410": "public_dividend_capital_000s",
    "BAL1420": "revaluation_reserve_000s",
    "BAL1430": "fv_through_oci_reserve_000s",
    "BAL1440": "other_reserves_000s",
    "BAL1450": "merger_reserve_000s",
    "BAL1460": "income_expenditure_reserve_000s",
    "BAL1470": "non_controlling_interest_000s",
    "BAL1490": "charitable_fund_reserves_000s",
    "BAL1500": "total_equity_000s",
}

# Code -> column of the expenditure breakdown's single lines.
EXPENDITURE_LINES = {
    "EXP0130": "staff_cost_000s",
    "EXP0170": "drugs_cost_000s",
    "EXP0240": "depreciation_000s",
    "EXP0250": "amortisation_000s",
    "EXP0150": "clinical_supplies_000s",
    "EXP0160": "general_supplies_000s",
    "EXP0290A": "clinical_negligence_000s",
    "EXP0200": "establishment_costs_000s",
    "EXP0210": "premises_rates_000s",
    "EXP0220": "premises_other_000s",
    "EXP0390": "total_expenditure_000s",
}

# Category -> column of the expenditure breakdown's totals.
EXPENDITURE_CATEGORIES = {
    "PAY": "pay_000s",
    "NON_PAY": "non_pay_000s",
    "NON_PAY_EXCL_EBITDA": "depreciation_amort_000s",
}

# Code -> column of the workforce view.
WORKFORCE_LINES = {
    "STA0250": "total_staff_cost_000s",
    "STA0220": "gross_staff_cost_000s",
    "STA0410": "total_wte",
    "STA0310": "medical_wte",
    "STA0350": "nursing_wte",
    "STA0330": "admin_estates_wte",
    "STA0340": "healthcare_assistant_wte",
    "STA0370": "scientific_tech_wte",
    "STA0530": "total_days_lost_sickness",
    "STA0550": "avg_days_lost_per_wte",
}

# Code -> column of the lines the scorecard adds, on whatever schedule they stand.
SCORECARD_LINES = {
    "INC0197": "api_variable_income_000s",
    "INC0198": "api_fixed_income_000s",
    "INC0200": "high_cost_drugs_income_000s",
    "INC0330": "private_patient_income_000s",
    "INC0350": "total_patient_income_tac06_000s",
    "INC1230A": "rd_income_000s",
    "INC1240A": "education_training_income_000s",
    "INC1360": "total_other_income_tac07_000s",
    "EXP0150": "clinical_supplies_000s",
    "EXP0160": "general_supplies_000s",
    "EXP0290A": "clinical_negligence_000s",
    "EXP0240": "depreciation_000s",
    "EXP0250": "amortisation_000s",
    "SCI0150": "finance_income_000s",
    "SCI0160": "finance_expense_000s",
    "SCI0170": "pdc_dividend_000s",
}

# Years the source publishes, by first calendar year.
FIRST_YEAR, LAST_YEAR = 2019, 2023
LOADED_YEARS = ["2021/22", "2022/23", "2023/24"]

CODE_SCHEMA = (
    "sub_code string, worksheet_name string, description string, expected_sign string, "
    "unit string, is_subtotal int, analytics_category string"
)
WORKSHEET_SCHEMA = "worksheet_name string, schedule_title string, category string, sub_code_prefix string"


def worksheet_dimension(spark: SparkSession) -> DataFrame:
    return literal_table(spark, WORKSHEETS, WORKSHEET_SCHEMA)


def code_dimension(spark: SparkSession) -> DataFrame:
    """Curated codes. Extend with ``operators.dictionary.extend_codes``."""
    return literal_table(spark, CURATED_CODES, CODE_SCHEMA)
