"""Seeded reference data and business-rule defaults.

Everything here is a fixed value of the domain (codes, labels, cut-offs), kept as plain text.
``dim_*`` functions turn the seeds into DataFrames through SQL ``VALUES``, which Spark plans as a
``LocalRelation``: its exact size is known, so joins against it are broadcast by Spark's own size check.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

# Worksheet names the views read.
WS_SOCI = "TAC02 SoCI"
WS_PATIENT_INCOME = "TAC06 Op Inc 1"
WS_OTHER_INCOME = "TAC07 Op Inc 2"
WS_EXPENDITURE = "TAC08 Op Exp"
WS_STAFF = "TAC09 Staff"

# Financial years (label, first day, last day, short label, complete flag).
FINANCIAL_YEARS = [
    ("2019/20", "2019-04-01", "2020-03-31", "19/20", 1),
    ("2020/21", "2020-04-01", "2021-03-31", "20/21", 1),
    ("2021/22", "2021-04-01", "2022-03-31", "21/22", 1),
    ("2022/23", "2022-04-01", "2023-03-31", "22/23", 1),
    ("2023/24", "2023-04-01", "2024-03-31", "23/24", 1),
]

# Worksheets (name, title, category, sub-code prefix).
WORKSHEETS = [
    ("TAC02 SoCI", "Statement of Comprehensive Income", "SUMMARY", "SCI"),
    ("TAC03 SoFP", "Statement of Financial Position", "BALANCE_SHEET", "SFP"),
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
    ("TAC18 Receivables", "Receivables and Debtors", "BALANCE_SHEET", "REC"),
    ("TAC19 CCE", "Cash and Cash Equivalents", "BALANCE_SHEET", "CCE"),
    ("TAC20 Payables", "Payables and Creditors", "BALANCE_SHEET", "PAY"),
    ("TAC22 Provisions", "Provisions for Liabilities", "BALANCE_SHEET", "PRV"),
    ("TAC28 Disclosures", "Statutory Disclosures (NHS Trusts only)", "OTHER", "DIS"),
    ("TAC29 Losses+SP", "Losses and Special Payments", "OTHER", "LSP"),
]

# Sub-codes (code, worksheet, description, expected sign, unit, is_subtotal, category).
SUBCODES = [
    ("SCI0100A", WS_SOCI, "Operating income from patient care activities", "+", "£000", 1, "PATIENT_INCOME"),
    ("SCI0110A", WS_SOCI, "Other operating income", "+", "£000", 1, "OTHER_INCOME"),
    ("SCI0125A", WS_SOCI, "Operating expenses (total)", "-", "£000", 1, "TOTAL_EXPENDITURE"),
    ("SCI0140A", WS_SOCI, "Operating surplus / (deficit)", "+/-", "£000", 1, "OPERATING_SURPLUS"),
    ("SCI0150", WS_SOCI, "Finance income", "+", "£000", 0, None),
    ("SCI0160", WS_SOCI, "Finance expense", "-", "£000", 0, None),
    ("SCI0170", WS_SOCI, "PDC dividend expense", "-", "£000", 0, None),
    ("SCI0240", WS_SOCI, "Surplus / (deficit) for the year", "+/-", "£000", 1, "NET_SURPLUS"),
    ("SOC0190", WS_SOCI, "Total comprehensive income / (expense)", "+/-", "£000", 1, None),
    ("INC0197", WS_PATIENT_INCOME, "API income - Variable (acute)", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0198", WS_PATIENT_INCOME, "API income - Fixed (acute)", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0200", WS_PATIENT_INCOME, "High cost drugs income from commissioners", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0210", WS_PATIENT_INCOME, "Other NHS clinical income (acute)", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0231", WS_PATIENT_INCOME, "API income (mental health)", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0302", WS_PATIENT_INCOME, "API income (community)", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0330", WS_PATIENT_INCOME, "Private patient income", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0332", WS_PATIENT_INCOME, "Pay award central funding", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0340", WS_PATIENT_INCOME, "Other clinical income", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC0350", WS_PATIENT_INCOME, "Total income from patient care activities", "+", "£000", 1, "PATIENT_INCOME"),
    ("INC1100", WS_PATIENT_INCOME, "Patient care income from NHS England", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC1115", WS_PATIENT_INCOME, "Patient care income from Integrated Care Boards", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC1140", WS_PATIENT_INCOME, "Patient care income from Local Authorities", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC1170", WS_PATIENT_INCOME, "Non-NHS: private patients", "+", "£000", 0, "PATIENT_INCOME"),
    ("INC1220", WS_PATIENT_INCOME, "Total income from patient care (by source)", "+", "£000", 1, "PATIENT_INCOME"),
    ("INC1230A", WS_OTHER_INCOME, "Research and development income (IFRS 15)", "+", "£000", 0, "OTHER_INCOME"),
    ("INC1240A", WS_OTHER_INCOME, "Education and training income", "+", "£000", 0, "OTHER_INCOME"),
    ("INC1280A", WS_OTHER_INCOME, "Non-patient care services to other bodies", "+", "£000", 0, "OTHER_INCOME"),
    ("INC1360", WS_OTHER_INCOME, "Total other operating income", "+", "£000", 1, "OTHER_INCOME"),
    ("INC1365", WS_OTHER_INCOME, "Total operating income", "+", "£000", 1, "TOTAL_INCOME"),
    ("EXP0100", WS_EXPENDITURE, "Purchase of healthcare from NHS bodies", "+", "£000", 0, "NON_PAY"),
    ("EXP0110", WS_EXPENDITURE, "Purchase of healthcare from non-NHS bodies", "+", "£000", 0, "NON_PAY"),
    ("EXP0130", WS_EXPENDITURE, "Staff and executive directors costs", "+", "£000", 0, "PAY"),
    ("EXP0140", WS_EXPENDITURE, "Non-executive directors costs", "+", "£000", 0, "PAY"),
    ("EXP0150", WS_EXPENDITURE, "Supplies and services - clinical", "+", "£000", 0, "NON_PAY"),
    ("EXP0160", WS_EXPENDITURE, "Supplies and services - general", "+", "£000", 0, "NON_PAY"),
    ("EXP0170", WS_EXPENDITURE, "Drugs costs", "+", "£000", 0, "NON_PAY"),
    ("EXP0190", WS_EXPENDITURE, "Consultancy", "+", "£000", 0, "NON_PAY"),
    ("EXP0200", WS_EXPENDITURE, "Establishment costs", "+", "£000", 0, "NON_PAY"),
    ("EXP0210", WS_EXPENDITURE, "Premises - business rates", "+", "£000", 0, "NON_PAY"),
    ("EXP0220", WS_EXPENDITURE, "Premises - other", "+", "£000", 0, "NON_PAY"),
    ("EXP0240", WS_EXPENDITURE, "Depreciation", "+", "£000", 0, "NON_PAY_EXCL_EBITDA"),
    ("EXP0250", WS_EXPENDITURE, "Amortisation", "+", "£000", 0, "NON_PAY_EXCL_EBITDA"),
    ("EXP0260", WS_EXPENDITURE, "Impairments net of reversals", "+/-", "£000", 0, "NON_PAY_EXCL_EBITDA"),
    ("EXP0290A", WS_EXPENDITURE, "Clinical negligence premium (NHS Resolution)", "+", "£000", 0, "NON_PAY"),
    ("EXP0300", WS_EXPENDITURE, "Research and development - staff costs", "+", "£000", 0, "PAY"),
    ("EXP0320", WS_EXPENDITURE, "Education and training - staff costs", "+", "£000", 0, "PAY"),
    ("EXP0350", WS_EXPENDITURE, "Redundancy costs - staff", "+", "£000", 0, "PAY"),
    ("EXP0370", WS_EXPENDITURE, "PFI / LIFT charges (on-SoFP)", "+", "£000", 0, "NON_PAY"),
    ("EXP0390", WS_EXPENDITURE, "Total operating expenditure", "+", "£000", 1, "TOTAL_EXPENDITURE"),
    ("STA0220", WS_STAFF, "Total gross staff costs", "+", "£000", 1, "PAY"),
    ("STA0250", WS_STAFF, "Total staff costs (net of recoveries)", "+", "£000", 1, "PAY"),
    ("STA0310", WS_STAFF, "Medical and dental WTE", "+", "No.", 0, "STAFF_WTE"),
    ("STA0330", WS_STAFF, "Administration and estates WTE", "+", "No.", 0, "STAFF_WTE"),
    ("STA0340", WS_STAFF, "Healthcare assistants WTE", "+", "No.", 0, "STAFF_WTE"),
    ("STA0350", WS_STAFF, "Nursing, midwifery and health visiting WTE", "+", "No.", 0, "STAFF_WTE"),
    ("STA0370", WS_STAFF, "Scientific, therapeutic and technical WTE", "+", "No.", 0, "STAFF_WTE"),
    ("STA0410", WS_STAFF, "Total average WTE", "+", "No.", 1, "STAFF_WTE"),
    ("STA0530", WS_STAFF, "Total days lost to sickness", "+", "No.", 0, "STAFF_WTE"),
    ("STA0550", WS_STAFF, "Average working days lost per WTE", "+", "No.", 0, "STAFF_WTE"),
]

# The lines that make up each subtotal, those that are taken off with a minus sign in front.
SUBTOTALS = {
    "INC0350": "INC0197 INC0198 INC0200 INC0210 INC0231 INC0302 INC0330 INC0332 INC0340",
    "INC1220": "INC1100 INC1115 INC1140 INC1170",
    "INC1360": "INC1230A INC1240A INC1280A",
    "INC1365": "INC0350 INC1360",
    "EXP0390": "EXP0100 EXP0110 EXP0130 EXP0140 EXP0150 EXP0160 EXP0170 EXP0190 EXP0200 EXP0210 EXP0220 EXP0240 EXP0250 "
    "EXP0260 EXP0290A EXP0300 EXP0320 EXP0350 EXP0370",
    "SCI0100A": "INC0350",
    "SCI0110A": "INC1360",
    "SCI0125A": "-EXP0390",
    "SCI0140A": "SCI0100A SCI0110A SCI0125A",
    "SCI0240": "SCI0140A SCI0150 -SCI0160 -SCI0170",
}

# Sector spellings and the label each stands for.
SECTOR_ALIASES = {
    "Acute": "Acute",
    "ACUTE": "Acute",
    "Acute Trust": "Acute",
    "Mental Health": "Mental Health",
    "MENTAL_HEALTH": "Mental Health",
    "Mental Health Trust": "Mental Health",
    "Community": "Community",
    "COMMUNITY": "Community",
    "Community Trust": "Community",
    "Ambulance": "Ambulance",
    "AMBULANCE": "Ambulance",
    "Ambulance Trust": "Ambulance",
    "Specialist": "Specialist",
    "SPECIALIST": "Specialist",
    "Specialist Trust": "Specialist",
}

# Pay as % of income above which a sector is under pay pressure.
PAY_AMBER_THRESHOLD = {
    "Acute": Decimal("65.0"),
    "Mental Health": Decimal("70.0"),
    "Community": Decimal("70.0"),
    "Ambulance": Decimal("68.0"),
    "Specialist": Decimal("60.0"),
}
PAY_AMBER_DEFAULT = Decimal("65.0")

# Cut-offs (green from, amber from) and other rule parameters.
EBITDA_RAG = (5, 2)
SURPLUS_RAG = (0, -2)
PAY_RAG = (65, 70)
CIP_RAG = (100, 80)
CAPITAL_RAG = (75, 90, 110)
VARIANCE_AMBER_PCT = 2
AGENCY_CEILING_PCT = "3.5"
LARGE_INCOME_000S = 1_000_000
BALANCE_TOLERANCE_000S = 1_000
WTE_MAX = 50_000
WORKING_DAYS = 225

# Colours for RAG states, and the colour of anything else.
RAG_COLOURS = {"Green": "#009639", "Amber": "#FFB81C", "Red": "#DA291C"}
RAG_COLOUR_OTHER = "#E8EDEE"

# The prior year of each reported year.
PRIOR_YEAR = {"2023/24": "2022/23", "2022/23": "2021/22", "2021/22": "2020/21"}

# Expected ranges of a full three-year load.
EXPECTED = {
    "years": ["2021/22", "2022/23", "2023/24"],
    "year": "2023/24",
    "fact_row_min": 2_000_000,
    "trust_count_min": 200,
    "income_bn": (125, 135),
    "deficit_trusts": (100, 140),
    "avg_ebitda_pct": (2, 6),
    "avg_pay_pct": (60, 75),
    "pay_sector": "Acute",
}

# Alternative headers of the two extracts, keyed by the name used here.
LINE_HEADERS = {
    "organisation_name": ["OrganisationName", "Organisation Name"],
    "worksheet_name": ["WorkSheetName"],
    "table_id": ["TableID"],
    "main_code": ["MainCode"],
    "row_num": ["RowNumber"],
    "sub_code": ["SubCode"],
    "total": ["Total", "Value number", "Value Number"],
}
PROVIDER_HEADERS = {
    "organisation_name": ["Full name of Provider"],
    "org_code": ["NHS code"],
    "region": ["Region"],
    "sector": ["Sector"],
    "comments": ["Comments ", "Comments"],
}

# File-name patterns.
FILE_GLOB = "TAC_NHS_*"
FILE_EXCLUDE = "illustrative"
FILE_YEAR_PATTERN = r"(\d{4})-(\d{2})"


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def values_sql(rows: list[tuple], columns: list[str]) -> str:
    """An inline table both Spark and DuckDB accept."""
    body = ",\n".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(columns)})"


SUBCODE_COLUMNS = ["sub_code", "worksheet_name", "description", "expected_sign", "unit", "is_subtotal", "analytics_category"]
WORKSHEET_COLUMNS = ["worksheet_name", "schedule_title", "category", "sub_code_prefix"]
YEAR_COLUMNS = ["financial_year", "start_date", "end_date", "year_label_short", "is_complete"]


def dim_subcode(spark: SparkSession) -> DataFrame:
    return spark.sql(values_sql(SUBCODES, SUBCODE_COLUMNS))


def subtotal_rows() -> list[tuple[str, str, int]]:
    """Subtotal, line and sign."""
    return [(whole, part.removeprefix("-"), -1 if part[0] == "-" else 1) for whole, parts in SUBTOTALS.items() for part in parts.split()]


def dim_subtotal(spark: SparkSession) -> DataFrame:
    """The tree of subtotals: whole, part, sign."""
    return spark.sql(values_sql(subtotal_rows(), ["whole", "part", "sign"]))


def dim_worksheet(spark: SparkSession) -> DataFrame:
    return spark.sql(values_sql(WORKSHEETS, WORKSHEET_COLUMNS))


def dim_financial_year(spark: SparkSession) -> DataFrame:
    seeds = spark.sql(values_sql(FINANCIAL_YEARS, YEAR_COLUMNS))
    return seeds.withColumns({c: seeds[c].cast("date") for c in ("start_date", "end_date")})
