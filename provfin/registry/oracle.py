"""DuckDB statements that state what each named query must return.

They are written independently of the Spark plans: facts come from separate UNION branches, and the
scorecard is composed view by view with joins, where Spark makes one pass. Percentages are whole tenths
(``*_t``) and every rounding is exact integer arithmetic.
"""

from __future__ import annotations

import re

from provfin.plans.benchmark import SIZE_BANDS
from provfin.plans.totals import AXES, SUMS
from provfin.refdata import (
    PAY_AMBER_THRESHOLD,
    RAG_COLOUR_OTHER,
    RAG_COLOURS,
    SECTOR_ALIASES,
    SUBCODE_COLUMNS,
    SUBCODES,
    SUBTOTALS,
    WORKSHEET_COLUMNS,
    WORKSHEETS,
    values_sql,
)
from provfin.registry.queries import EXPECTED
from provfin.sources.fixture import BASE, CODE_WIDTH, PRIOR, PRIOR_YEARS, SECTORS, SLOTS, YEAR

# --- rounding ----------------------------------------------------------------------------------------


def units(num: str, den: str, digits: int = 0) -> str:
    """num / den in units of 10^-digits, rounded half away from zero; NULL if den is 0 or NULL."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return (
        f"CASE WHEN {d} <> 0 THEN CAST(sign({n}) * sign({d}) * "
        f"((2 * abs({n}) * {10**digits} + abs({d})) // (2 * abs({d}))) AS BIGINT) END"
    )


def units_even(num: str, den: str, digits: int = 0) -> str:
    """As ``units``, rounded half to even."""
    n, d = f"abs(CAST({num} AS HUGEINT)) * {10**digits}", f"abs(CAST({den} AS HUGEINT))"
    up = f"((2 * {n} + {d}) // (2 * {d}))"
    tie = f"((2 * {n} + {d}) % (2 * {d}) = 0 AND {up} % 2 = 1)"
    sign = f"sign(CAST({num} AS HUGEINT)) * sign(CAST({den} AS HUGEINT))"
    return f"CASE WHEN {d} <> 0 THEN CAST({sign} * ({up} - CASE WHEN {tie} THEN 1 ELSE 0 END) AS BIGINT) END"


def number(num: str, den: str, digits: int = 1) -> str:
    return f"CAST({units(num, den, digits)} AS DOUBLE) / {10**digits}"


def tenths(column: str) -> str:
    return f"CAST({column} AS DOUBLE) / 10"


def bn(column: str, digits: int = 1) -> str:
    return number(f"sum({column})", "1000000", digits)


def m(column: str, digits: int = 0) -> str:
    return number(f"sum({column})", "1000", digits)


def avg(column_t: str) -> str:
    """Average of tenths, to one digit."""
    return number(f"sum({column_t})", f"(10 * count({column_t}))", 1)


def avg_even(column_t: str) -> str:
    return f"CAST({units_even(f'sum({column_t})', f'(10 * count({column_t}))', 1)} AS DOUBLE) / 10"


def mean_of(ten_digits: str, digits: int) -> str:
    """Average of values in units of 10^-10."""
    return number(f"sum({ten_digits})", f"(10000000000 * count({ten_digits}))", digits)


def wpct(num: str, den: str, digits: int = 1) -> str:
    return number(f"(100 * sum({num}))", f"sum({den})", digits)


def total(column: str) -> str:
    return f"CAST(sum({column}) AS BIGINT)"


def share(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0) * 100)"


# --- tables ------------------------------------------------------------------------------------------

CODE = f"lpad(CAST({{0}} AS VARCHAR), CAST(greatest({CODE_WIDTH}, length(CAST({{0}} AS VARCHAR))) AS INT), '0')"
TYPE = "CASE WHEN {} % 3 = 0 THEN 'NHS_TRUST' ELSE 'FOUNDATION_TRUST' END"
SECTOR = "(['" + "', '".join(SECTORS) + "'])[CAST({} % 5 AS INT) + 1]"
LABEL = "CAST({0} AS VARCHAR) || '/' || lpad(CAST(({0} + 1) % 100 AS VARCHAR), 2, '0')"
START = "year({} - INTERVAL 3 MONTH)"

_slot_rows = ", ".join(
    f"({i}, '{ws}', '{code}')" for first, last, ws, code in SLOTS for i in range(first, last + 1)
)
_from_tot = [
    ("TAC02 SoCI", "", "SCI0100A", "pc"),
    ("TAC02 SoCI", "", "SCI0110A", "oi"),
    ("TAC02 SoCI", "", "SCI0125A", "-ex"),
    ("TAC02 SoCI", "", "SCI0140A", "coalesce(pc, 0) + coalesce(oi, 0) - coalesce(ex, 0)"),
    ("TAC02 SoCI", "", "SCI0150", "s % 7 * 100"),
    ("TAC02 SoCI", "", "SCI0160", "s % 5 * 150"),
    ("TAC02 SoCI", "", "SCI0170", "s % 4 * 5000"),
    (
        "TAC02 SoCI",
        "",
        "SCI0240",
        "coalesce(pc, 0) + coalesce(oi, 0) - coalesce(ex, 0) + s % 7 * 100 - s % 5 * 150 - s % 4 * 5000",
    ),
    ("TAC06 Op Inc 1", "", "INC0350", "pc"),
    ("TAC07 Op Inc 2", "", "INC1360", "oi"),
    ("TAC08 Op Exp", "", "EXP0390", "ex"),
    ("TAC08 Op Exp", "", "EXP0200", "ex // 50"),
    ("TAC08 Op Exp", "", "EXP0210", "ex // 80"),
    ("TAC08 Op Exp", "", "EXP0220", "ex // 120"),
    ("TAC09 Staff", "", "STA0220", "pay + 1000"),
    ("TAC09 Staff", "", "STA0250", "pay"),
]
_from_wte = [
    ("TAC09 Staff", "", "STA0410", "w * 10"),
    ("TAC09 Staff", "P", "STA0410", "w * 8"),
    ("TAC09 Staff", "", "STA0310", "med * 10"),
    ("TAC09 Staff", "", "STA0350", "nur * 10"),
    ("TAC09 Staff", "", "STA0550", "w % 15 + 5"),
    ("TAC09 Staff", "", "STA0330", "w * 2"),
    ("TAC09 Staff", "", "STA0340", "w * 3"),
    ("TAC09 Staff", "", "STA0370", "w"),
    ("TAC09 Staff", "", "STA0530", "w * (w % 15 + 5)"),
]
_branches = " UNION ALL ".join(
    f"SELECT s, fy0, yt, '{ws}' AS ws, '{sfx}' AS sfx, '{code}' AS sub_code, {v} AS v FROM {source}"
    for source, lines in (("tot", _from_tot), ("wte", _from_wte))
    for ws, sfx, code, v in lines
)

CTES = {
    "slots": f"SELECT * FROM (VALUES {_slot_rows}) AS u(slot, ws, sub_code)",
    "posted": f"""SELECT l_suppkey AS s, {START.format('l_shipdate')} AS fy0,
        CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'PY' ELSE 'CY' END AS yt,
        (l_partkey * 7 + l_linenumber * 3 + l_orderkey) % 24 AS slot,
        CAST(floor(l_extendedprice / 2) AS BIGINT) AS v, CAST(floor(l_quantity) AS BIGINT) AS q FROM lineitem""",
    "det": """SELECT s, fy0, yt, ws, sub_code, sum(v) AS v FROM posted JOIN slots USING (slot)
        GROUP BY ALL""",
    "tot": """SELECT s, fy0, yt, sum(v) FILTER (WHERE ws = 'TAC06 Op Inc 1') AS pc,
        sum(v) FILTER (WHERE ws = 'TAC07 Op Inc 2') AS oi, sum(v) FILTER (WHERE ws = 'TAC08 Op Exp') AS ex,
        sum(v) FILTER (WHERE sub_code IN ('EXP0130', 'EXP0300')) AS pay FROM det GROUP BY ALL""",
    "wte": """SELECT s, fy0, yt, sum(q) AS w, sum(q) FILTER (WHERE slot < 3) AS med,
        sum(q) FILTER (WHERE slot BETWEEN 3 AND 10) AS nur FROM posted WHERE (s + fy0) % 11 <> 0 GROUP BY s, fy0, yt""",
    "fact_all": f"""SELECT {CODE.format('s')} AS org_code, {LABEL.format('fy0')} AS financial_year,
        ws AS worksheet_name, 'A' || substr(ws, 4, 2) || yt || '01' || sfx AS main_code, sub_code,
        CAST(v AS BIGINT) AS total, {TYPE.format('s')} AS trust_type
        FROM (SELECT s, fy0, yt, ws, '' AS sfx, sub_code, v FROM det UNION ALL {_branches}) WHERE v IS NOT NULL""",
    "fact": "SELECT * FROM fact_all WHERE main_code NOT LIKE '%PY%'",
    "trust": f"""SELECT {CODE.format('s_suppkey')} AS org_code, s_name AS organisation_name,
        {TYPE.format('s_suppkey')} AS trust_type, {SECTOR.format('s_suppkey')} AS sector, r_name AS region,
        CAST(s_suppkey % 3 <> 0 AS INT) AS is_foundation, s_suppkey AS s
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "code": values_sql(SUBCODES, SUBCODE_COLUMNS),
}

HEAD = "org_code, organisation_name, sector, region, trust_type, financial_year"
ORG = "t.org_code, t.organisation_name, t.sector, t.region, t.trust_type, f.financial_year"


def line(sub_code: str, name: str) -> str:
    return f"max(total) FILTER (WHERE f.sub_code = '{sub_code}') AS {name}"


def category(name: str, column: str) -> str:
    hits = f"sum(total) FILTER (WHERE analytics_category = '{name}')"
    return f"CAST(coalesce({hits}, 0) AS BIGINT) AS {column}"


_v2_lines = {
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
_v3_lines = {
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
_v5_lines = {
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


def lines(table: dict[str, str]) -> str:
    return ", ".join(line(code, name) for code, name in table.items())


def rag(value: str, green, amber) -> str:
    return (
        f"CASE WHEN {value} IS NULL THEN 'Grey' WHEN {value} >= {green} THEN 'Green' "
        f"WHEN {value} >= {amber} THEN 'Amber' ELSE 'Red' END"
    )


CTES |= {
    "v1": f"""SELECT {ORG}, {line('SCI0100A', 'patient_care_income_000s')}, {line('SCI0110A', 'other_income_000s')},
        coalesce(max(total) FILTER (WHERE f.sub_code = 'SCI0100A'), 0)
          + coalesce(max(total) FILTER (WHERE f.sub_code = 'SCI0110A'), 0) AS total_income_000s,
        abs(coalesce(max(total) FILTER (WHERE f.sub_code = 'SCI0125A'), 0)) AS total_expenditure_000s,
        {line('SCI0140A', 'operating_surplus_000s')}, {line('SCI0240', 'net_surplus_000s')}
        FROM fact f JOIN trust t USING (org_code) WHERE worksheet_name = 'TAC02 SoCI' GROUP BY {ORG}""",
    "v2": f"""SELECT {ORG}, {category('PAY', 'pay_000s')}, {category('NON_PAY', 'non_pay_000s')},
        {category('NON_PAY_EXCL_EBITDA', 'depreciation_amort_000s')}, {lines(_v2_lines)}
        FROM fact f JOIN trust t USING (org_code) JOIN code c ON c.sub_code = f.sub_code
        WHERE f.worksheet_name = 'TAC08 Op Exp' GROUP BY {ORG}""",
    "v3": f"""SELECT {ORG}, {lines(_v3_lines)} FROM fact f JOIN trust t USING (org_code)
        WHERE worksheet_name = 'TAC09 Staff' GROUP BY {ORG}""",
    "joined": """SELECT v1.*, pay_000s, non_pay_000s, depreciation_amort_000s, staff_cost_000s, drugs_cost_000s,
        clinical_negligence_000s, total_wte, medical_wte, nursing_wte, avg_days_lost_per_wte,
        total_staff_cost_000s, gross_staff_cost_000s,
        operating_surplus_000s + coalesce(depreciation_amort_000s, 0) AS ebitda_000s
        FROM v1 LEFT JOIN v2 USING (org_code, financial_year) LEFT JOIN v3 USING (org_code, financial_year)
        WHERE v1.total_income_000s > 0""".replace("v1.*", "v1.* EXCLUDE (total_expenditure_000s), v1.total_expenditure_000s"),
    "v4": f"""SELECT *, {units('(100 * ebitda_000s)', 'total_income_000s', 1)} AS ebitda_t,
        {units('(100 * pay_000s)', 'total_income_000s', 1)} AS pay_t,
        {units('staff_cost_000s', 'total_wte', 1)} AS cost_t,
        {units('(100 * net_surplus_000s)', 'total_income_000s', 1)} AS net_t,
        CASE WHEN operating_surplus_000s < 0 THEN 1 ELSE 0 END AS is_deficit FROM joined""",
    "extra": f"SELECT org_code, financial_year, {lines(_v5_lines)} FROM fact f GROUP BY org_code, financial_year",
    "v5": f"""SELECT v4.* EXCLUDE (clinical_negligence_000s), extra.* EXCLUDE (org_code, financial_year),
        {rag('ebitda_t', 50, 20)} AS ebitda_rag,
        CASE WHEN net_surplus_000s IS NULL THEN 'Grey' WHEN net_surplus_000s < 0 THEN 'Red'
             WHEN net_surplus_000s = 0 THEN 'Amber' ELSE 'Green' END AS surplus_rag
        FROM v4 LEFT JOIN extra USING (org_code, financial_year)""",
}

# Raw extracts, cleaned.
_raw_name = "'Supplier#' || " + CODE.format("l_suppkey")
_slot_code = "CASE " + " ".join(f"WHEN slot <= {last} THEN '{code}'" for _, last, _, code in SLOTS) + " END"
CTES |= {
    "raw": f"""SELECT l_orderkey + l_linenumber AS mix, l_orderkey * 8 + l_linenumber AS row_num,
        (l_partkey * 7 + l_linenumber * 3 + l_orderkey) % 24 AS slot, {_raw_name} AS name,
        CAST(floor(l_extendedprice / 2) AS BIGINT) AS value, {TYPE.format('l_suppkey')} AS trust_type,
        {LABEL.format(f"({START.format('l_shipdate')})")} AS financial_year,
        NOT (l_returnflag = 'R' AND l_linestatus = 'F') AS current FROM lineitem""",
    "named": """SELECT *, CASE trust_type WHEN 'NHS_TRUST' THEN 'TAC_NHS_trusts_' ELSE 'TAC_NHS_foundation_trusts_' END
        || replace(financial_year, '/', '-') AS source_file FROM raw""",
    "clean": f"""SELECT CASE WHEN mix % 3 = 1 THEN upper(name) ELSE name END AS organisation_name,
        CASE WHEN slot <= 8 THEN 'TAC06 Op Inc 1' WHEN slot <= 11 THEN 'TAC07 Op Inc 2'
             WHEN slot <= 22 THEN 'TAC08 Op Exp' ELSE 'TAC08 Extra' END AS worksheet_name,
        CAST(1 AS SMALLINT) AS table_id,
        CASE WHEN slot <= 8 THEN 'A06CY01' WHEN slot <= 11 THEN 'A07CY01' ELSE 'A08CY01' END AS main_code,
        row_num, {_slot_code} AS sub_code,
        CASE WHEN mix % 11 <> 0 AND mix % 13 <> 0 AND mix % 17 = 0 THEN 0 ELSE value END AS total,
        source_file, 'CY' AS year_type, trust_type, financial_year
        FROM named WHERE current AND (mix % 3 < 2 OR mix % 97 <> 0) AND mix % 89 <> 0
        AND (mix % 11 = 0 OR mix % 13 = 0 OR mix % 17 = 0 OR (mix % 83 <> 0 AND mix % 79 <> 0))""",
    "years": f"""SELECT DISTINCT l_suppkey AS s, {LABEL.format(f"({START.format('l_shipdate')})")} AS financial_year FROM lineitem""",
    "prov": f"""SELECT CASE WHEN s % 19 = 18 AND financial_year >= '{YEAR}' THEN organisation_name || ' Group'
        ELSE organisation_name END AS organisation_name, org_code, region,
        CASE WHEN s % 13 = 12 AND financial_year >= '{YEAR}' THEN NULL ELSE sector END AS sector,
        CAST(NULL AS VARCHAR) AS comments,
        CASE trust_type WHEN 'NHS_TRUST' THEN 'TAC_NHS_trusts_' ELSE 'TAC_NHS_foundation_trusts_' END
          || replace(financial_year, '/', '-') AS source_file, trust_type, financial_year
        FROM trust JOIN years USING (s)
        WHERE s % 17 <> 16 AND s % 46 NOT IN (22, 45)""",
    "built": """SELECT org_code, arg_min(organisation_name, financial_year) AS organisation_name,
        any_value(trust_type) AS trust_type,
        arg_max(sector, financial_year) FILTER (WHERE sector IS NOT NULL) AS sector, any_value(region) AS region,
        CAST(any_value(trust_type) = 'FOUNDATION_TRUST' AS INT) AS is_foundation,
        min(financial_year) AS first_year_seen, max(financial_year) AS last_year_seen FROM prov GROUP BY org_code""",
    "matched": """SELECT p.org_code, c.*, row_num % 8 > 3 AS batch FROM clean c JOIN prov p
        ON lower(c.organisation_name) = lower(p.organisation_name) AND c.financial_year = p.financial_year
        AND c.trust_type = p.trust_type""",
    "placed": """SELECT *, row_number() OVER (PARTITION BY org_code, financial_year, main_code, sub_code
          ORDER BY batch DESC, source_file DESC, row_num DESC, total DESC) AS newest,
        first_value(worksheet_name) OVER (PARTITION BY org_code, financial_year, main_code, sub_code
          ORDER BY batch, source_file, row_num, total) AS first_sheet FROM matched""",
    "promoted": """SELECT org_code, financial_year, first_sheet AS worksheet_name, table_id, main_code, sub_code,
        CAST(total AS DECIMAL(14,0)) AS total_000s, trust_type, source_file FROM placed WHERE newest = 1""",
}

# One load of published files, which come in four parts by row number.
CTES |= {
    "placed_files": CTES["placed"].replace("batch DESC, source_file DESC", "row_num % 4 DESC").replace("batch, source_file", "row_num % 4"),
    "promoted_files": CTES["promoted"].replace("source_file FROM placed", "source_file || '_p' || row_num % 4 || '.csv' AS source_file FROM placed_files"),
}

# Views over facts that came through files: postings of organisations whose name is in that year's provider list.
_from_files = {n: f"{n}_files" for n in ("fact", "v1", "v2", "v3", "joined", "v4", "extra", "v5")} | {"trust": "built"}
CTES |= {
    "fact_files": """SELECT f.* FROM fact f JOIN trust t USING (org_code) JOIN prov p ON p.org_code = f.org_code
        AND p.financial_year = f.financial_year AND lower(p.organisation_name) = lower(t.organisation_name)""",
}
CTES |= {
    f"{name}_files": re.sub(r"\b(fact|v[1-5]|joined|extra|trust)\b", lambda m: _from_files[m[1]], CTES[name])
    for name in ("v1", "v2", "v3", "joined", "v4", "extra", "v5")
}

# The same facts with the fractions of the staff lines, in hundredths.
CTES |= {
    "fact_hundredths": """SELECT * REPLACE (100 * total + CASE WHEN sub_code LIKE 'STA%'
        THEN (7 * CAST(org_code AS BIGINT) + CAST(substr(sub_code, 4) AS INTEGER)) % 100 ELSE 0 END AS total) FROM fact_files""",
}
CTES |= {
    f"{name}_hundredths": re.sub(r"\b(fact|v[1-4]|joined)_files\b", r"\1_hundredths", CTES[f"{name}_files"])
    for name in ("v1", "v2", "v3", "joined", "v4")
}

# Facts with every fault the audit looks for.
_org = "CAST(org_code AS BIGINT)"
CTES |= {
    "fact_dirty": f"""SELECT CASE WHEN {_org} % 50 = 7 THEN 'X' || org_code WHEN {_org} % 60 = 9 THEN ' ' WHEN {_org} % 70 = 11 THEN NULL
          ELSE org_code END AS org_code, financial_year, worksheet_name, main_code, sub_code,
        CASE WHEN sub_code = 'SCI0140A' AND {_org} % 8 = 1 THEN total + 5000 WHEN sub_code = 'STA0410' AND {_org} % 9 = 2
          THEN total * 1000 ELSE total END AS total, trust_type
        FROM (SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE sub_code = 'INC0350' AND {_org} % 10 = 0)""",
}
CTES |= {
    f"{name}_dirty": re.sub(r"\b(fact|v[1-5]|joined|extra)\b", r"\1_dirty", CTES[name])
    for name in ("v1", "v2", "v3", "joined", "v4", "extra", "v5")
}

# Monthly returns.
CTES |= {
    "monthly": f"""SELECT {CODE.format('(o_custkey // 50)')} AS org_code,
        {LABEL.format(f"({START.format('o_orderdate')})")} AS financial_year,
        'M' || lpad(CAST(month(o_orderdate - INTERVAL 3 MONTH) AS VARCHAR), 2, '0') AS period,
        CASE WHEN o_orderkey % 7 < 3 THEN 'INCOME' WHEN o_orderkey % 7 = 3 THEN 'PAY' WHEN o_orderkey % 7 = 4 THEN 'NON_PAY'
             WHEN o_orderkey % 7 = 5 THEN 'CAPITAL' ELSE 'CIP' END AS account_type,
        o_orderkey % 7 = 4 AND o_orderkey % 3 = 0 AS agency, CAST(floor(o_totalprice / 100) AS BIGINT) AS actual,
        CAST(floor(o_totalprice / 100) AS BIGINT) * (85 + o_orderkey % 31) // 100 AS budget FROM orders""",
}

NEEDS = {
    "fact_dirty": ["fact"], "v1_dirty": ["fact_dirty", "trust"], "v2_dirty": ["fact_dirty", "trust", "code"],
    "v3_dirty": ["fact_dirty", "trust"], "joined_dirty": ["v1_dirty", "v2_dirty", "v3_dirty"], "v4_dirty": ["joined_dirty"],
    "extra_dirty": ["fact_dirty"], "v5_dirty": ["v4_dirty", "extra_dirty"],
    "fact_files": ["fact", "trust", "prov"], "v1_files": ["fact_files", "built"], "v2_files": ["fact_files", "built", "code"],
    "v3_files": ["fact_files", "built"], "joined_files": ["v1_files", "v2_files", "v3_files"], "v4_files": ["joined_files"],
    "extra_files": ["fact_files"], "v5_files": ["v4_files", "extra_files"],
    "fact_hundredths": ["fact_files"], "v1_hundredths": ["fact_hundredths", "built"], "v2_hundredths": ["fact_hundredths", "built", "code"],
    "v3_hundredths": ["fact_hundredths", "built"], "joined_hundredths": ["v1_hundredths", "v2_hundredths", "v3_hundredths"],
    "v4_hundredths": ["joined_hundredths"],
    "placed_files": ["matched"], "promoted_files": ["placed_files"], "monthly": [],
    "posted": [], "slots": [], "det": ["posted", "slots"], "tot": ["det"], "wte": ["posted"],
    "fact_all": ["det", "tot", "wte"], "fact": ["fact_all"], "trust": [], "code": [],
    "v1": ["fact", "trust"], "v2": ["fact", "trust", "code"], "v3": ["fact", "trust"],
    "joined": ["v1", "v2", "v3"], "v4": ["joined"], "extra": ["fact"], "v5": ["v4", "extra"],
    "raw": [], "named": ["raw"], "clean": ["named"], "years": [], "prov": ["trust", "years"], "built": ["prov"],
    "matched": ["clean", "prov"], "placed": ["matched"], "promoted": ["placed"],
}


def statement(body: str, *needs: str) -> str:
    """``body`` with the tables it needs, each computed once."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dependency in NEEDS[name]:
            visit(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in ordered)
    return f"WITH {ctes}\n{body}" if ordered else body


# --- statements --------------------------------------------------------------------------------------

IN_YEAR = f"financial_year = '{YEAR}'"
MONEY_V1 = (
    "patient_care_income_000s, other_income_000s, total_income_000s, total_expenditure_000s, "
    "operating_surplus_000s, net_surplus_000s"
)
KPI_NUMBERS = (
    f"{tenths('ebitda_t')} AS ebitda_margin_pct, {tenths('pay_t')} AS pay_pct_income, "
    f"{tenths('cost_t')} AS cost_per_wte_000s, {tenths('net_t')} AS net_surplus_margin_pct"
)
STATUS = "CASE WHEN is_deficit = 1 THEN 'DEFICIT' ELSE 'SURPLUS' END"
DEFICITS = total("is_deficit")
FLAGS = (
    "CAST(total_income_000s >= 1000000 AS INT) AS is_large, "
    "CAST(coalesce(pay_t > CASE sector "
    + " ".join(f"WHEN '{s}' THEN {int(t * 10)}" for s, t in PAY_AMBER_THRESHOLD.items())
    + " END, false) AS INT) AS pay_pressure_flag"
)
PRIOR_T = "lag(ebitda_t) OVER (PARTITION BY org_code ORDER BY financial_year)"
MIX = ", ".join(
    f"CAST({units_even(f'(100 * {source})', 'total_income_000s', 1)} AS DOUBLE) / 10 AS {name}"
    for source, name in (
        ("patient_care_income_000s", "patient_income_pct"),
        ("other_income_000s", "other_income_pct"),
    )
)


def _detail(columns: str, where: str, fact: str = "fact") -> str:
    return statement(
        f"SELECT {columns} FROM {fact} f JOIN trust t USING (org_code) JOIN code c ON c.sub_code = f.sub_code "
        f"WHERE {where}",
        fact,
        "trust",
        "code",
    )


def _top(columns: str, source: str, where: str, order: str, limit: int) -> str:
    return f"SELECT {columns} FROM {source} WHERE {where} ORDER BY {order} LIMIT {limit}"


def _unpivot(parts: dict[str, str], source: str, name: str, value: str) -> str:
    return " UNION ALL ".join(
        f"SELECT financial_year, '{label}' AS {name}, {sql} AS {value} FROM {source} GROUP BY financial_year"
        for label, sql in parts.items()
    )


def ingest_sql() -> dict[str, str]:
    files = "FROM named GROUP BY source_file"
    shown = ", ".join(f"'{ws}'" for ws, *_ in WORKSHEETS)
    plain = "mix % 11 <> 0 AND mix % 13 <> 0 AND mix % 17"
    faults = " UNION ALL ".join(
        f"SELECT source_file, '{name}' AS check_name, '{severity}' AS severity, count(*) FILTER (WHERE {fault}) AS failures,"
        f" count(*) FILTER (WHERE {fault}) = 0 AS passed FROM named WHERE current GROUP BY source_file"
        for name, severity, fault in (
            ("nulls in organisation_name", "CRITICAL", "mix % 3 = 2 AND mix % 97 = 0"),
            ("nulls in sub_code", "CRITICAL", "mix % 89 = 0"),
            ("nulls in total", "CRITICAL", f"{plain} <> 0 AND mix % 79 <> 0 AND mix % 83 = 0"),
            ("nulls in financial_year", "CRITICAL", "financial_year IS NULL"),
            ("totals that do not fit", "CRITICAL", f"{plain} <> 0 AND mix % 79 = 0"),
            ("unreadable totals", "WARNING", f"{plain} = 0"),
        )
    )
    refusals = {
        "prior year": "NOT current",
        "no organisation": "mix % 3 = 2 AND mix % 97 = 0",
        "no sub-code": "mix % 89 = 0",
        "no total": f"{plain} <> 0 AND mix % 79 <> 0 AND mix % 83 = 0",
        "total does not fit": f"{plain} <> 0 AND mix % 79 = 0",
    }
    refused = " OR ".join(f"({fault})" for fault in refusals.values())
    clean_name = "CASE WHEN mix % 3 = 1 THEN upper(name) ELSE name END"
    return {
        "fact_from_stream": statement("SELECT * FROM promoted_files", "promoted_files"),
        "stg_rejects": statement(
            f"""SELECT source_file, CASE WHEN NOT ({refusals['no organisation']}) THEN {clean_name} END AS organisation_name,
            'A' || CASE WHEN slot <= 8 THEN '06' WHEN slot <= 11 THEN '07' ELSE '08' END || CASE WHEN current THEN 'CY01' ELSE 'PY01' END
              AS main_code, CAST(row_num AS VARCHAR) AS row_num, CASE WHEN mix % 89 <> 0 THEN {_slot_code} END AS sub_code,
            CASE WHEN mix % 11 = 0 THEN format('{{:,}}', value) WHEN mix % 13 = 0 THEN value || '.9' WHEN mix % 17 = 0 THEN 'n/a'
                 WHEN mix % 79 = 0 THEN value || '00000000000000' WHEN mix % 83 <> 0 THEN CAST(value AS VARCHAR) END AS total,
            concat_ws(', ', {', '.join(f"CASE WHEN {fault} THEN '{name}' END" for name, fault in refusals.items())}) AS reasons
            FROM named WHERE {refused}""",
            "named",
        ),
        "stg_line_counts": statement(
            f"""SELECT source_file, count(*) AS read, count(*) FILTER (WHERE NOT ({refused})) AS kept,
            count(*) FILTER (WHERE {refused}) AS refused,
            {', '.join(f"count(*) FILTER (WHERE {fault}) AS {name.replace(' ', '_').replace('-', '_')}" for name, fault in refusals.items())}
            FROM named GROUP BY source_file""",
            "named",
        ),
        "derive_financial_year": statement(
            f"SELECT source_file, count(*) AS line_count, min(financial_year) AS financial_year {files}", "named"
        ),
        "derive_trust_type": statement(
            f"SELECT source_file, count(*) AS line_count, min(trust_type) AS trust_type {files}", "named"
        ),
        "stg_provider_clean": statement("SELECT * FROM prov", "prov"),
        "stg_tac_clean": statement("SELECT * FROM clean", "clean"),
        "dim_trust_build": statement("SELECT * FROM built", "built"),
        "dim_worksheet_extend": statement(
            f"""SELECT * FROM ({values_sql(WORKSHEETS, WORKSHEET_COLUMNS)}) UNION ALL
            SELECT DISTINCT worksheet_name, worksheet_name, 'OTHER', NULL FROM clean
            WHERE worksheet_name NOT IN ({shown})""",
            "clean",
        ),
        "fact_promote": statement("SELECT * FROM promoted", "promoted"),
        "preload_audit": statement(
            f"""{faults} UNION ALL
            SELECT source_file, 'duplicate (org, main_code, sub_code) rows', 'WARNING', CAST(n AS BIGINT), n = 0
            FROM (SELECT source_file, count(*) - count(DISTINCT (organisation_name, main_code, sub_code)) AS n
                  FROM clean GROUP BY source_file)
            UNION ALL
            SELECT source_file, 'organisation names not in provider list', 'WARNING', n, n = 0
            FROM (SELECT c.source_file, count(DISTINCT lower(c.organisation_name))
                         FILTER (WHERE p.organisation_name IS NULL) AS n
                  FROM clean c LEFT JOIN prov p ON lower(c.organisation_name) = lower(p.organisation_name)
                   AND c.financial_year = p.financial_year AND c.trust_type = p.trust_type GROUP BY c.source_file)""",
            "named",
            "clean",
            "prov",
        ),
        "final_counts": statement(
            """SELECT 'dim_trust' AS table_name, count(*) AS row_count FROM built
            UNION ALL SELECT 'fct_tac', count(*) FROM promoted""",
            "built",
            "promoted",
        ),
        "fiscal_period": f"""SELECT CAST(d AS VARCHAR) AS order_date, n AS order_count,
            {LABEL.format(f"({START.format('d')})")} AS financial_year,
            CAST(month(d - INTERVAL 3 MONTH) AS INTEGER) AS fiscal_month,
            'M' || lpad(CAST(month(d - INTERVAL 3 MONTH) AS VARCHAR), 2, '0') AS period_label,
            'Q' || CAST(quarter(d - INTERVAL 3 MONTH) AS VARCHAR) AS quarter_label
            FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)""",
    }


def view_sql() -> dict[str, str]:
    v2 = ", ".join(["pay_000s", "non_pay_000s", "depreciation_amort_000s", *_v2_lines.values()])
    v3 = ", ".join(_v3_lines.values())
    surplus_rag = rag("net_surplus_000s * 100", "0 * total_income_000s", "-2 * total_income_000s")
    aliases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SECTOR_ALIASES.items())
    return {
        "income_expenditure": statement(f"SELECT {HEAD}, {MONEY_V1} FROM v1", "v1"),
        "expenditure_breakdown": statement(f"SELECT {HEAD}, {v2} FROM v2", "v2"),
        "workforce": statement(f"SELECT {HEAD}, {v3} FROM v3", "v3"),
        "kpis": statement(
            f"""SELECT {HEAD}, total_income_000s, total_expenditure_000s, operating_surplus_000s, net_surplus_000s,
            pay_000s, non_pay_000s, depreciation_amort_000s, staff_cost_000s, drugs_cost_000s,
            clinical_negligence_000s, total_wte, medical_wte, nursing_wte, avg_days_lost_per_wte, ebitda_000s,
            {KPI_NUMBERS}, is_deficit, {rag('ebitda_t', 50, 20)} AS ebitda_rag, {surplus_rag} AS surplus_rag FROM v4""",
            "v4",
        ),
        "scorecard": statement(
            f"SELECT * EXCLUDE (ebitda_t, pay_t, cost_t, net_t), {KPI_NUMBERS} FROM v5",
            "v5",
        ),
        "scorecard_from_files": statement(
            f"SELECT * EXCLUDE (ebitda_t, pay_t, cost_t, net_t), {KPI_NUMBERS} FROM v5_files",
            "v5_files",
        ),
        "workforce_fractional": statement(
            f"SELECT {HEAD}, {', '.join(f'CAST({c} AS DOUBLE) / 100 AS {c}' for c in _v3_lines.values())} FROM v3_hundredths", "v3_hundredths"
        ),
        "kpis_fractional": statement(
            f"""SELECT {HEAD}, {', '.join(f'CAST({c} AS DOUBLE) / 100 AS {c}' for c in (
                'total_income_000s', 'total_expenditure_000s', 'operating_surplus_000s', 'net_surplus_000s', 'pay_000s', 'non_pay_000s',
                'depreciation_amort_000s', 'staff_cost_000s', 'drugs_cost_000s', 'clinical_negligence_000s', 'total_wte', 'medical_wte',
                'nursing_wte', 'avg_days_lost_per_wte', 'ebitda_000s'))}, {KPI_NUMBERS}, is_deficit,
            {rag('ebitda_t', 50, 20)} AS ebitda_rag, {surplus_rag} AS surplus_rag FROM v4_hundredths""",
            "v4_hundredths",
        ),
        "normalise_sectors": statement(
            f"""SELECT org_code, given AS given_sector, CASE given {aliases} ELSE given END AS sector FROM (
            SELECT org_code, CASE (s // 5) % 4 WHEN 0 THEN sector WHEN 1 THEN upper(replace(sector, ' ', '_'))
            WHEN 2 THEN sector || ' Trust' ELSE 'Other' END AS given FROM trust)""",
            "trust",
        ),
        "trust_flags": statement(f"SELECT org_code, financial_year, {FLAGS}, ebitda_rag FROM v5", "v5"),
        "income_mix": statement(f"SELECT org_code, financial_year, total_income_000s, {MIX} FROM v5", "v5"),
        "yoy_ebitda": statement(
            f"""SELECT org_code, financial_year, {tenths('ebitda_t')} AS ebitda_margin_pct,
            {tenths(PRIOR_T)} AS ebitda_margin_pct_prior_yr,
            {tenths(f'(ebitda_t - {PRIOR_T})')} AS ebitda_margin_yoy_pp FROM v5""",
            "v5",
        ),
        "sector_benchmarks_median": statement(f"SELECT * EXCLUDE (avg_t) FROM ({BENCHMARKS})", "v5"),
    }


BENCHMARKS = f"""SELECT financial_year, sector, count(DISTINCT org_code) AS providers,
    {total('total_income_000s')} AS total_income_000s, {total('total_expenditure_000s')} AS total_expenditure_000s,
    CAST(coalesce(sum(operating_surplus_000s), 0) AS BIGINT) AS total_surplus_000s,
    CAST(coalesce(sum(pay_000s), 0) AS BIGINT) AS total_pay_000s,
    CAST(coalesce(sum(total_wte), 0) AS BIGINT) AS total_wte,
    {avg_even('ebitda_t')} AS avg_ebitda_margin_pct, round_even(median(ebitda_t), 0) / 10 AS median_ebitda_pct,
    {avg_even('pay_t')} AS avg_pay_pct_income, {avg_even('cost_t')} AS avg_cost_per_wte_000s,
    {total('is_deficit')} AS deficit_trusts,
    CAST({units_even('(100 * coalesce(sum(pay_000s), 0))', 'sum(total_income_000s)', 1)} AS DOUBLE) / 10 AS sector_pay_pct,
    {units_even('sum(ebitda_t)', '(10 * count(ebitda_t))', 1)} AS avg_t
    FROM v5 WHERE sector IS NOT NULL GROUP BY financial_year, sector"""


def extract_sql() -> dict[str, str]:
    leaf = (
        "t.org_code, t.organisation_name, t.sector, t.trust_type, f.financial_year, f.sub_code, "
        "c.description AS line_item, c.analytics_category, f.total AS amount_000s"
    )
    full = "f.sub_code, c.description AS sub_code_description, c.is_subtotal, f.total AS value_000s"
    current = "f.main_code NOT LIKE '%PY%' AND c.is_subtotal = 0"
    income_sheets = "'TAC06 Op Inc 1', 'TAC07 Op Inc 2'"
    return {
        "income_detail_full": _detail(
            f"{ORG}, f.worksheet_name, {full}",
            f"f.worksheet_name IN ({income_sheets}, 'TAC02 SoCI') "
            "AND c.analytics_category IN ('PATIENT_INCOME', 'OTHER_INCOME', 'TOTAL_INCOME')",
        ),
        "expenditure_detail_full": _detail(
            f"{ORG}, {full}, c.analytics_category", "f.worksheet_name = 'TAC08 Op Exp'"
        ),
        "income_detail": _detail(leaf, f"f.worksheet_name IN ({income_sheets}) AND {current}", "fact_all"),
        "expenditure_detail": _detail(leaf, f"f.worksheet_name = 'TAC08 Op Exp' AND {current}", "fact_all"),
        "extract_kpis": statement(
            f"""SELECT {HEAD}, total_income_000s, ebitda_000s, {KPI_NUMBERS}, pay_000s, total_wte, net_surplus_000s,
            is_deficit, {FLAGS}, ebitda_rag, {tenths(f'(ebitda_t - {PRIOR_T})')} AS ebitda_margin_yoy_pp FROM v5""",
            "v5",
        ),
        "extract_ie_summary": statement(f"SELECT org_code, financial_year, {MONEY_V1}, {MIX} FROM v5", "v5"),
        "extract_expenditure_breakdown": statement(
            """SELECT org_code, financial_year, pay_000s, non_pay_000s, depreciation_amort_000s, drugs_cost_000s,
            clinical_negligence_000s, clinical_supplies_000s, general_supplies_000s FROM v5""",
            "v5",
        ),
        "extract_workforce": statement(
            """SELECT org_code, financial_year, total_wte, total_staff_cost_000s, gross_staff_cost_000s, medical_wte,
            nursing_wte FROM v5""",
            "v5",
        ),
        "dim_financial_year_extract": f"""SELECT {LABEL.format('y')} AS financial_year,
            CAST(y AS VARCHAR) || '-04-01' AS start_date, CAST(y + 1 AS VARCHAR) || '-03-31' AS end_date,
            substr({LABEL.format('y')}, 3, 5) AS year_label_short, CAST(n = 12 AS INT) AS is_complete
            FROM (SELECT {START.format('o_orderdate')} AS y, count(DISTINCT month(o_orderdate)) AS n FROM orders GROUP BY 1)""",
        "extract_with_dimensions": statement(
            f"""SELECT v5.org_code, financial_year, pay_000s, non_pay_000s, depreciation_amort_000s, drugs_cost_000s,
            clinical_negligence_000s, clinical_supplies_000s, general_supplies_000s, t.organisation_name, t.trust_type,
            t.sector, t.region, t.is_foundation, start_date, end_date, year_label_short
            FROM v5 LEFT JOIN trust t ON t.org_code = v5.org_code LEFT JOIN (
              SELECT DISTINCT {LABEL.format('y')} AS financial_year, CAST(y AS VARCHAR) || '-04-01' AS start_date,
              CAST(y + 1 AS VARCHAR) || '-03-31' AS end_date, substr({LABEL.format('y')}, 3, 5) AS year_label_short
              FROM (SELECT {START.format('o_orderdate')} AS y FROM orders)) USING (financial_year)""",
            "v5",
            "trust",
        ),
        "dim_trust_extract": statement(
            """SELECT trust.* EXCLUDE (s), first_year_seen, last_year_seen FROM trust LEFT JOIN (SELECT s,
            min(financial_year) AS first_year_seen, max(financial_year) AS last_year_seen FROM years GROUP BY s) USING (s)""",
            "trust",
            "years",
        ),
        "ie_summary_extract": statement(f"SELECT {HEAD}, {MONEY_V1} FROM v1", "v1"),
        "expenditure_extract": statement(
            f"""SELECT {HEAD}, pay_000s, non_pay_000s, depreciation_amort_000s, drugs_cost_000s, staff_cost_000s,
            total_expenditure_000s FROM v2""",
            "v2",
        ),
        "workforce_extract": statement(
            f"""SELECT {HEAD}, total_staff_cost_000s, gross_staff_cost_000s, total_wte, medical_wte, nursing_wte,
            admin_estates_wte, scientific_tech_wte, avg_days_lost_per_wte FROM v3
            WHERE total_staff_cost_000s IS NOT NULL""",
            "v3",
        ),
        "kpi_extract": statement(
            f"""SELECT {HEAD}, total_income_000s, total_expenditure_000s, operating_surplus_000s, net_surplus_000s,
            pay_000s, drugs_cost_000s, depreciation_amort_000s, ebitda_000s, {KPI_NUMBERS}, total_wte FROM v4""",
            "v4",
        ),
        "sector_benchmarks": statement(
            f"""SELECT financial_year, sector, trust_type, count(DISTINCT org_code) AS provider_count,
            {m('total_income_000s')} AS total_income_m, {m('total_expenditure_000s')} AS total_expenditure_m,
            {m('operating_surplus_000s')} AS total_op_surplus_m, {avg('ebitda_t')} AS avg_ebitda_margin_pct,
            {avg('pay_t')} AS avg_pay_pct_income, {avg('net_t')} AS avg_net_surplus_margin_pct,
            count(*) FILTER (WHERE operating_surplus_000s < 0) AS deficit_count,
            count(*) FILTER (WHERE operating_surplus_000s >= 0) AS surplus_count
            FROM v4 WHERE sector IS NOT NULL GROUP BY ALL""",
            "v4",
        ),
    }


def linked_sql(extracts: dict[str, str], trust: str) -> dict[str, str]:
    """Every dataset of the report model with its organisation and year."""
    year = f"""SELECT DISTINCT {LABEL.format('y')} AS financial_year, CAST(y AS VARCHAR) || '-04-01' AS start_date,
        CAST(y + 1 AS VARCHAR) || '-03-31' AS end_date, substr({LABEL.format('y')}, 3, 5) AS year_label_short
        FROM (SELECT {START.format('o_orderdate')} AS y FROM orders)"""
    attributes = ["organisation_name", "trust_type", "sector", "region", "is_foundation"]
    found = {}
    for name in ("kpis", "ie_summary", "expenditure_breakdown", "workforce", "income_detail", "expenditure_detail"):
        base = extracts.get(f"extract_{name}") or extracts[name]
        given = {"kpis": attributes[:4], "income_detail": attributes[:3], "expenditure_detail": attributes[:3]}.get(name, [])
        added = ", ".join(f"t.{a}" for a in attributes if a not in given)
        found[f"extract_{name}_linked"] = f"""SELECT e.*, {added}, start_date, end_date, year_label_short FROM ({base}) e
            LEFT JOIN ({trust}) t ON t.org_code = e.org_code LEFT JOIN ({year}) y ON y.financial_year = e.financial_year"""
    return found


def history_sql() -> dict[str, str]:
    moved = SECTOR.format(f"(s + CASE WHEN s % 11 = 5 AND financial_year = '{PRIOR}' THEN 1 ELSE 0 END)")
    shown = f"CASE WHEN s % 13 = 12 AND financial_year >= '{YEAR}' THEN NULL ELSE {moved} END AS sector"
    lists = CTES["prov"].replace(f"CASE WHEN s % 13 = 12 AND financial_year >= '{YEAR}' THEN NULL ELSE sector END AS sector", shown)
    history = statement(
        f"""SELECT org_code, organisation_name, trust_type, sector, region, CAST(entry AS BIGINT) AS entry, min(financial_year) AS valid_from,
        lead(min(financial_year)) OVER (PARTITION BY org_code ORDER BY entry) AS valid_before, max(financial_year) AS last_listed, count(*) AS lists
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY org_code ORDER BY financial_year) AS entry FROM (
          SELECT *, CASE WHEN lag(financial_year) OVER o IS NOT NULL AND lag(organisation_name) OVER o = organisation_name
            AND lag(sector) OVER o IS NOT DISTINCT FROM sector THEN 0 ELSE 1 END AS fresh
          FROM (SELECT org_code, organisation_name, trust_type, region, financial_year,
                last_value(sector IGNORE NULLS) OVER (PARTITION BY org_code ORDER BY financial_year) AS sector FROM ({lists}))
          WINDOW o AS (PARTITION BY org_code ORDER BY financial_year)))
        GROUP BY org_code, organisation_name, trust_type, sector, region, entry""",
        "trust",
        "years",
    )
    card = view_sql()["scorecard"]
    return {
        "dim_trust_history": history,
        "scorecard_as_of": f"""SELECT s.* EXCLUDE (organisation_name, sector, region, trust_type), h.organisation_name, h.sector, h.region, h.trust_type
            FROM ({card}) s JOIN ({history}) h ON h.org_code = s.org_code AND (h.entry = 1 OR s.financial_year >= h.valid_from)
            AND (h.valid_before IS NULL OR s.financial_year < h.valid_before)""",
    }


def _leaves(whole: str) -> list[tuple[str, int]]:
    """The lines without parts below a subtotal, with their signs."""
    out = []
    for part in SUBTOTALS[whole].split():
        code, sign = part.removeprefix("-"), -1 if part[0] == "-" else 1
        out += [(leaf, sign * s) for leaf, s in _leaves(code)] if code in SUBTOTALS else [(code, sign)]
    return out


def subtotal_sql() -> dict[str, str]:
    def added(parts: list[tuple[str, int]], aggregate: str) -> str:
        cases = " ".join(f"WHEN '{code}' THEN {sign} * value" for code, sign in parts)
        return f"{aggregate}(CASE sub_code {cases} END)"

    def body(fact: str, tolerance: int, where: str) -> str:
        branches = []
        for whole, listed in SUBTOTALS.items():
            direct = [(p.removeprefix("-"), -1 if p[0] == "-" else 1) for p in listed.split()]
            leaves = _leaves(whole)
            branches.append(
                f"""SELECT org_code, financial_year, '{whole}' AS sub_code, CAST(max(value) FILTER (WHERE sub_code = '{whole}') AS BIGINT) AS reported_000s,
                CAST({added(direct, 'sum')} AS BIGINT) AS parts_000s, CAST({added(leaves, 'sum')} AS BIGINT) AS leaves_000s,
                {added(direct, 'count')} AS part_count, {added(leaves, 'count')} AS leaf_count FROM value GROUP BY org_code, financial_year"""
            )
        return statement(
            f"""SELECT * FROM (SELECT *, reported_000s - parts_000s AS parts_difference_000s, reported_000s - leaves_000s AS leaves_difference_000s,
            CASE WHEN parts_000s IS NULL THEN 'no parts' WHEN abs(reported_000s - parts_000s) <= {tolerance}
              AND abs(reported_000s - coalesce(leaves_000s, reported_000s)) <= {tolerance} THEN 'balanced' ELSE 'different' END AS status
            FROM (WITH value AS (SELECT org_code, financial_year, sub_code, max(total) AS value FROM {fact} GROUP BY ALL)
                  {' UNION ALL '.join(branches)}) WHERE reported_000s IS NOT NULL) WHERE {where}""",
            fact,
        )

    return {
        "subtotal_reconciliation": body("fact", 0, "true"),
        "subtotal_differences_dirty": body("fact_dirty", 1000, "status = 'different'"),
    }


def cube_sql(measures: dict[str, str]) -> dict[str, str]:
    axes = ", ".join(AXES)
    sums = ", ".join(f"CAST(sum({column}) AS BIGINT) AS {name}" for name, column in SUMS.items())
    level = f"GROUPING_ID({axes}) AS level"
    chosen = f"""FROM (SELECT * FROM v5 WHERE {IN_YEAR} AND trust_type = 'FOUNDATION_TRUST' AND sector IN ('{SECTORS[0]}', '{SECTORS[1]}'))
        GROUP BY region"""
    body = measures["m_kpi"][measures["m_kpi"].rindex("SELECT financial_year, sector") :]
    return {
        "m_cube": statement(
            f"""SELECT {axes}, {level}, {sums}, count(*) FILTER (WHERE operating_surplus_000s < 0) AS deficit_trusts,
            count(*) FILTER (WHERE operating_surplus_000s >= 0) AS surplus_trusts, count(DISTINCT org_code) AS total_trusts
            FROM v5 GROUP BY CUBE ({axes})""",
            "v5",
        ),
        "trusts_by_slice": statement(f"SELECT {axes}, {level}, count(DISTINCT org_code) AS trust_count FROM v5 GROUP BY CUBE ({axes})", "v5"),
        "m_core_from_cube": measures["m_core"],
        "m_kpi_from_cube": measures["m_kpi"],
        "m_kpi_of_slice": statement(
            body.replace("SELECT financial_year, sector", "SELECT region").replace("FROM v5 GROUP BY financial_year, sector", chosen), "v5"
        ),
    }


def trend_sql() -> dict[str, str]:
    def income(year: str) -> str:
        return f"sum(total_income_000s) FILTER (WHERE financial_year = '{year}')"

    ratio = units("(100 * drugs_cost_000s)", "total_income_000s", 10)
    bodies = {
        "national_trend": f"""SELECT financial_year, {bn('total_income_000s')} AS total_income_bn,
            {bn('total_expenditure_000s')} AS total_expenditure_bn, {m('operating_surplus_000s')} AS op_surplus_m,
            {m('net_surplus_000s')} AS net_surplus_m, {avg('ebitda_t')} AS avg_ebitda_pct,
            {DEFICITS} AS deficit_trusts, count(*) AS total_trusts FROM v5 GROUP BY financial_year""",
        "sector_kpis": f"""SELECT sector, trust_type, count(*) AS providers, {m('total_income_000s')} AS total_income_m,
            {avg('ebitda_t')} AS avg_ebitda_pct, {avg('pay_t')} AS avg_pay_pct, {avg('net_t')} AS avg_net_surplus_pct,
            {DEFICITS} AS deficit_count, {m('least(operating_surplus_000s, 0)')} AS total_deficit_m
            FROM v5 WHERE {IN_YEAR} GROUP BY sector, trust_type""",
        "regional_growth": f"""SELECT region, CAST({income(BASE)} AS BIGINT) AS income_base_000s,
            CAST({income(PRIOR)} AS BIGINT) AS income_prior_000s, CAST({income(YEAR)} AS BIGINT) AS income_current_000s,
            {number(f'(100 * ({income(YEAR)} - {income(BASE)}))', income(BASE))} AS growth_2yr_pct
            FROM v5 WHERE region IS NOT NULL GROUP BY region""",
        "ebitda_distribution": f"""SELECT sector, {tenths('min(ebitda_t)')} AS min_ebitda_pct,
            {avg('ebitda_t')} AS avg_ebitda_pct, {tenths('max(ebitda_t)')} AS max_ebitda_pct,
            count(*) FILTER (WHERE ebitda_t < 0) AS negative_ebitda,
            count(*) FILTER (WHERE ebitda_t BETWEEN 0 AND 20) AS low_0_2,
            count(*) FILTER (WHERE ebitda_t BETWEEN 20 AND 50) AS mid_2_5,
            count(*) FILTER (WHERE ebitda_t > 50) AS high_gt5 FROM v5 WHERE {IN_YEAR} GROUP BY sector""",
        "top_income": _top(
            f"""rank() OVER (ORDER BY total_income_000s DESC) AS rank, org_code, organisation_name, sector, region,
            {number('total_income_000s', '1000', 0)} AS income_m,
            {number('operating_surplus_000s', '1000', 0)} AS op_surplus_m, {tenths('ebitda_t')} AS ebitda_margin,
            {tenths('pay_t')} AS pay_pct, {STATUS} AS status""",
            "v5",
            IN_YEAR,
            "total_income_000s DESC, org_code",
            20,
        ),
        "worst_net_margin": _top(
            f"""rank() OVER (ORDER BY net_t NULLS FIRST) AS deficit_rank, org_code, organisation_name, sector, region,
            trust_type, {number('total_income_000s', '1000', 0)} AS income_m,
            {number('net_surplus_000s', '1000', 0)} AS net_surplus_m, {tenths('net_t')} AS net_margin,
            {tenths('ebitda_t')} AS ebitda_margin""",
            "v5",
            IN_YEAR,
            "net_t NULLS FIRST, org_code",
            20,
        ),
        "pay_trend": f"""SELECT financial_year, sector, {avg('pay_t')} AS avg_pay_pct, {bn('pay_000s')} AS total_pay_bn,
            {bn('total_income_000s')} AS total_income_bn, {wpct('pay_000s', 'total_income_000s')} AS sector_pay_pct
            FROM v5 GROUP BY financial_year, sector""",
        "drugs_cost": f"""SELECT financial_year, sector, {m('drugs_cost_000s')} AS total_drugs_m,
            {wpct('drugs_cost_000s', 'total_income_000s')} AS drugs_pct_income, {mean_of(ratio, 1)} AS avg_drugs_pct
            FROM v5 WHERE sector IN ('Acute', 'Specialist') AND drugs_cost_000s IS NOT NULL GROUP BY ALL""",
        "negligence_national": f"""SELECT financial_year, {m('clinical_negligence_000s')} AS total_neg_m,
            {wpct('clinical_negligence_000s', 'total_income_000s')} AS neg_pct_income,
            count(DISTINCT org_code) AS trusts_reporting
            FROM v5 WHERE clinical_negligence_000s IS NOT NULL GROUP BY financial_year""",
        "finance_position": f"""SELECT financial_year, {m('finance_income_000s')} AS finance_income_m,
            {m('finance_expense_000s')} AS finance_expense_m, {m('pdc_dividend_000s')} AS pdc_dividend_m,
            {m('finance_income_000s - finance_expense_000s - pdc_dividend_000s')} AS net_finance_m
            FROM v5 WHERE finance_income_000s IS NOT NULL GROUP BY financial_year""",
    }
    return {key: statement(body, "v5") for key, body in bodies.items()}


def benchmark_sql() -> dict[str, str]:
    bands = " ".join(f"WHEN {n} THEN '{name}'" for n, name in SIZE_BANDS.items())
    limits = " ".join(f"WHEN '{s}' THEN {int(t * 10)}" for s, t in PAY_AMBER_THRESHOLD.items())
    limit = f"(CASE sector {limits} ELSE 650 END)"
    both = "(coalesce(rd_income_000s, 0) + coalesce(education_training_income_000s, 0))"
    org = "org_code, organisation_name, sector, region"
    ratio = units("(100 * clinical_negligence_000s)", "total_income_000s", 10)
    bodies = {
        "size_bands": f"""SELECT q AS income_quartile, CASE q {bands} END AS size_band, count(*) AS trust_count,
            {number('min(total_income_000s)', '1000', 0)} AS min_income_m,
            {number('max(total_income_000s)', '1000', 0)} AS max_income_m, {avg('ebitda_t')} AS avg_ebitda_pct,
            {avg('pay_t')} AS avg_pay_pct, {avg('cost_t')} AS avg_cost_per_wte_000s, {DEFICITS} AS deficit_trusts
            FROM (SELECT *, ntile(4) OVER (PARTITION BY financial_year ORDER BY total_income_000s, org_code) AS q
                  FROM v5 WHERE {IN_YEAR}) GROUP BY q""",
        "trust_type_compare": f"""SELECT financial_year, trust_type, count(*) AS providers,
            {avg('ebitda_t')} AS avg_ebitda_pct, {avg('pay_t')} AS avg_pay_pct, {avg('net_t')} AS avg_net_surplus_pct,
            {DEFICITS} AS deficit_count, {m('operating_surplus_000s')} AS total_surplus_m,
            {bn('total_income_000s')} AS total_income_bn FROM v5 GROUP BY financial_year, trust_type""",
        "pay_pressure": _top(
            f"""{org}, trust_type, financial_year, {tenths('pay_t')} AS pay_pct,
            {tenths(limit)} AS sector_amber_threshold_pct, {tenths(f'(pay_t - {limit})')} AS excess_pp,
            {tenths('ebitda_t')} AS ebitda_margin""",
            "v5",
            f"{IN_YEAR} AND pay_t > {limit}",
            f"pay_t - {limit} DESC, org_code",
            30,
        ),
        "regional_health": f"""SELECT region, count(DISTINCT org_code) AS trusts, {m('total_income_000s')} AS total_income_m,
            {m('operating_surplus_000s')} AS total_surplus_m,
            {wpct('operating_surplus_000s', 'total_income_000s')} AS sector_op_margin_pct,
            {avg('ebitda_t')} AS avg_ebitda_pct, {avg('pay_t')} AS avg_pay_pct, {DEFICITS} AS deficit_trusts,
            {number('(100 * sum(is_deficit))', 'count(*)', 0)} AS deficit_pct
            FROM v5 WHERE {IN_YEAR} AND region IS NOT NULL GROUP BY region""",
        "cost_per_wte": f"""SELECT financial_year, sector, count(*) AS trusts, {avg('cost_t')} AS avg_cost_per_wte_000s,
            {tenths('min(cost_t)')} AS min_cost_per_wte_000s, {tenths('max(cost_t)')} AS max_cost_per_wte_000s,
            {m('total_staff_cost_000s')} AS total_pay_bill_m, {total('total_wte')} AS total_wte
            FROM v5 WHERE sector IS NOT NULL AND total_wte > 0 AND cost_t IS NOT NULL GROUP BY ALL""",
        "private_income": _top(
            f"""{org}, financial_year, {number('private_patient_income_000s', '1000', 1)} AS private_income_m,
            {number('total_income_000s', '1000', 0)} AS total_income_m,
            {number('(100 * private_patient_income_000s)', 'total_income_000s', 2)} AS private_pct""",
            "v5",
            f"{IN_YEAR} AND private_patient_income_000s > 0",
            "private_patient_income_000s DESC, org_code",
            25,
        ),
        "negligence_sector": f"""SELECT financial_year, sector, count(DISTINCT org_code) AS trusts_reporting,
            {m('clinical_negligence_000s')} AS total_neg_m,
            {wpct('clinical_negligence_000s', 'total_income_000s', 2)} AS neg_pct_income,
            {mean_of(ratio, 2)} AS avg_neg_pct_per_trust
            FROM v5 WHERE clinical_negligence_000s IS NOT NULL AND sector IS NOT NULL GROUP BY ALL""",
        "ebitda_movers": f"""SELECT a.org_code, a.organisation_name, a.sector, a.region,
            {number('a.total_income_000s', '1000', 0)} AS income_m, {tenths('b.ebitda_t')} AS ebitda_prior_pct,
            {tenths('a.ebitda_t')} AS ebitda_current_pct, {tenths('(a.ebitda_t - b.ebitda_t)')} AS yoy_change_pp,
            CASE WHEN a.ebitda_t > b.ebitda_t THEN '+' ELSE '' END
              || format('{{:.1f}}', {tenths('(a.ebitda_t - b.ebitda_t)')}) || 'pp' AS yoy_change,
            CASE WHEN a.is_deficit = 1 THEN 'DEFICIT' ELSE 'SURPLUS' END AS status_current
            FROM v5 a JOIN v5 b ON a.org_code = b.org_code AND a.financial_year = '{YEAR}' AND b.financial_year = '{PRIOR}'
            ORDER BY a.ebitda_t - b.ebitda_t NULLS FIRST, a.org_code LIMIT 30""",
        "sickness_cost": f"""SELECT financial_year, sector, count(*) AS trusts,
            {number('sum(avg_days_lost_per_wte)', 'count(avg_days_lost_per_wte)')} AS avg_days_lost_per_wte,
            {total('total_wte')} AS total_wte,
            {number('sum(avg_days_lost_per_wte * total_wte * cost_t)', '2250000', 0)} AS est_sickness_cost_m
            FROM v5 WHERE avg_days_lost_per_wte IS NOT NULL AND total_wte > 0 AND cost_t IS NOT NULL GROUP BY ALL""",
        "rd_education_income": _top(
            f"""{org}, financial_year, {number('rd_income_000s', '1000')} AS rd_income_m,
            {number('education_training_income_000s', '1000')} AS education_income_m,
            {number(both, '1000')} AS rd_edu_total_m, {number(f'(100 * {both})', 'total_income_000s')} AS rd_edu_pct_income,
            {tenths('ebitda_t')} AS ebitda_margin""",
            "v5",
            f"{IN_YEAR} AND (rd_income_000s > 0 OR education_training_income_000s > 0)",
            f"{both} DESC, org_code",
            25,
        ),
    }
    # GROUP BY ALL with quotients of sums groups by the plain columns only.
    return {key: statement(body, "v5") for key, body in bodies.items()}


def validation_sql() -> dict[str, str]:
    surplus = "operating_surplus_000s"
    best = "org_code, organisation_name, sector, trust_type"
    money = (
        f"{number('total_income_000s', '1000')} AS total_income_m, "
        f"{number('operating_surplus_000s', '1000')} AS op_surplus_m"
    )
    return {
        "val_q1": statement(
            """SELECT financial_year, trust_type, count(DISTINCT org_code) AS providers, count(*) AS total_rows
            FROM fact GROUP BY ALL""",
            "fact",
        ),
        "val_q2": statement(
            f"""SELECT financial_year, {bn('total')} AS patient_income_bn, count(DISTINCT org_code) AS providers
            FROM fact WHERE sub_code = 'SCI0100A' GROUP BY financial_year""",
            "fact",
        ),
        "val_q3": statement(
            f"""SELECT financial_year, {bn('patient_care_income_000s')} AS patient_income_bn,
            {bn('other_income_000s')} AS other_income_bn, {bn('total_income_000s')} AS total_income_bn,
            {bn('total_expenditure_000s')} AS total_exp_bn, {bn(surplus)} AS op_surplus_bn,
            count(DISTINCT org_code) AS providers FROM v1 GROUP BY financial_year""",
            "v1",
        ),
        "val_q4": statement(
            f"""SELECT sector, trust_type, count(DISTINCT org_code) AS providers, {avg('ebitda_t')} AS avg_ebitda_margin_pct,
            {avg('pay_t')} AS avg_pay_pct_income, {avg('net_t')} AS avg_net_surplus_pct
            FROM v4 WHERE {IN_YEAR} GROUP BY sector, trust_type""",
            "v4",
        ),
        "val_q5": statement(
            f"""SELECT count(*) FILTER (WHERE {surplus} < 0) AS deficit_trusts,
            count(*) FILTER (WHERE {surplus} >= 0) AS surplus_trusts, count(*) AS total_trusts,
            {m(f'least({surplus}, 0)', 1)} AS total_deficit_m, {m(f'greatest({surplus}, 0)', 1)} AS total_surplus_m
            FROM v1 WHERE {IN_YEAR}""",
            "v1",
        ),
        "val_q6": statement(
            _top(
                f"{best}, {money}, {tenths('net_t')} AS net_margin", "v4", IN_YEAR, "total_income_000s DESC, org_code", 10
            ),
            "v4",
        ),
        "val_q7": statement(
            _top(
                f"{best}, {money}, {tenths('ebitda_t')} AS ebitda_margin",
                "v4",
                f"{IN_YEAR} AND {surplus} IS NOT NULL",
                f"{surplus}, org_code",
                10,
            ),
            "v4",
        ),
        "val_q8": statement(
            f"""SELECT financial_year, {bn('pay_000s')} AS total_pay_bn, {bn('drugs_cost_000s')} AS total_drugs_bn,
            {bn('non_pay_000s')} AS total_non_pay_bn, {bn('total_expenditure_000s')} AS total_exp_bn,
            {wpct('pay_000s', 'total_expenditure_000s')} AS pay_pct_exp FROM v2 GROUP BY financial_year""",
            "v2",
        ),
        "val_q9": statement(
            f"""SELECT financial_year, {total('total_wte')} AS total_wte, {bn('total_staff_cost_000s')} AS staff_cost_bn,
            {number('sum(total_staff_cost_000s)', 'sum(total_wte)')} AS avg_cost_per_wte_k
            FROM v3 WHERE total_wte IS NOT NULL GROUP BY financial_year""",
            "v3",
        ),
        "val_q10": statement(
            """SELECT count(*) AS total_rows,
            count(DISTINCT org_code || '|' || financial_year || '|' || main_code || '|' || sub_code) AS unique_keys
            FROM fact""",
            "fact",
        ),
        "audit_report": _audit_sql(),
        "audit_report_dirty": _audit_sql("_dirty"),
    }


def _audit_sql(kind: str = "") -> str:
    """The audit of the facts, or of the dirtied ones (kind ``_dirty``)."""
    e = EXPECTED
    year, sector = e["year"], e["pay_sector"]
    (i_lo, i_hi), (d_lo, d_hi) = e["income_bn"], e["deficit_trusts"]
    (m_lo, m_hi), (p_lo, p_hi) = e["avg_ebitda_pct"], e["avg_pay_pct"]

    def check(name: str, severity: str, passed: str, detail: str, source: str) -> str:
        title = name.replace("'", "''")
        return f"SELECT '{title}' AS check_name, '{severity}' AS severity, {passed} AS passed, {detail} AS detail FROM ({source})"

    def count(suffix: str) -> str:
        return f"CAST(n AS VARCHAR) || '{suffix}'"

    def one_digit(value_t: str) -> str:
        return f"format('{{:.1f}}', {tenths(value_t)})"

    dupes = "SELECT 1 FROM fact GROUP BY org_code, financial_year, main_code, sub_code HAVING count(*) > 1"
    pay = units("sum(pay_t)", "(10 * count(pay_t))", 1)
    margin = units("sum(ebitda_t)", "(10 * count(ebitda_t))", 1)
    parts = [
        check(
            "fct_tac row count",
            "CRITICAL",
            f"n >= {e['fact_row_min']}",
            f"format('{{:,}}', n) || ' rows (expected ≥ {e['fact_row_min']:,})'",
            "SELECT count(*) AS n FROM fact",
        ),
        check(
            "dim_trust row count",
            "CRITICAL",
            f"n >= {e['trust_count_min']}",
            count(f" trusts (expected ≥ {e['trust_count_min']})"),
            "SELECT count(*) AS n FROM trust",
        ),
        *[
            check(
                f"year coverage: {y}",
                "CRITICAL",
                "n > 0",
                "CASE WHEN n > 0 THEN 'found' ELSE 'MISSING' END || ' in fct_tac'",
                f"SELECT count(*) AS n FROM fact WHERE financial_year = '{y}'",
            )
            for y in e["years"]
        ],
        check(
            "no null org_codes in fct_tac",
            "CRITICAL",
            "n = 0",
            count(" rows with null/empty org_code"),
            "SELECT count(*) AS n FROM fact WHERE org_code IS NULL OR trim(org_code) = ''",
        ),
        check(
            "no duplicate fact keys",
            "CRITICAL",
            "n = 0",
            count(" duplicate (org_code, year, main_code, sub_code) combinations"),
            f"SELECT count(*) AS n FROM ({dupes})",
        ),
        check(
            "no orphan org_codes in fct_tac",
            "CRITICAL",
            "n = 0",
            count(" org_codes in fct_tac not in dim_trust"),
            "SELECT count(DISTINCT org_code) AS n FROM fact WHERE org_code NOT IN (SELECT org_code FROM trust)",
        ),
        check(
            f"total income {year} in expected range",
            "WARNING",
            f"n BETWEEN {i_lo * 1000000} AND {i_hi * 1000000}",
            f"'£' || {one_digit(units('n', '1000000', 1))} || 'bn (expected £{i_lo}–{i_hi}bn)'",
            f"SELECT coalesce(sum(total_income_000s), 0) AS n FROM v1 WHERE financial_year = '{year}'",
        ),
        check(
            f"deficit trust count {year}",
            "WARNING",
            f"n BETWEEN {d_lo} AND {d_hi}",
            count(f" deficit trusts (expected {d_lo}–{d_hi})"),
            f"SELECT CAST(coalesce(sum(is_deficit), 0) AS BIGINT) AS n FROM v5 WHERE financial_year = '{year}'",
        ),
        check(
            f"avg EBITDA margin {year}",
            "WARNING",
            f"n BETWEEN {m_lo * 10} AND {m_hi * 10}",
            f"{one_digit('n')} || '% (expected {m_lo}–{m_hi}%)'",
            f"SELECT coalesce({margin}, 0) AS n FROM v4 WHERE financial_year = '{year}'",
        ),
        check(
            f"avg pay % {sector.lower()} trusts {year}",
            "WARNING",
            f"n BETWEEN {p_lo * 10} AND {p_hi * 10}",
            f"{one_digit('n')} || '% (NHS benchmark {p_lo}–{p_hi}%)'",
            f"SELECT coalesce({pay}, 0) AS n FROM v4 WHERE financial_year = '{year}' AND sector = '{sector}'",
        ),
        check(
            "income - expenditure = operating surplus",
            "WARNING",
            "n = 0",
            count(" trust-years where I&E doesn''t balance (tolerance £1m)"),
            "SELECT count(*) AS n FROM v1 WHERE abs(total_income_000s - total_expenditure_000s - operating_surplus_000s) > 1000",
        ),
        check(
            "WTE values plausible (0 < WTE ≤ 50,000)",
            "WARNING",
            "n = 0",
            count(" trust-years with implausible WTE"),
            "SELECT count(*) AS n FROM v3 WHERE total_wte <= 0 OR total_wte > 50000",
        ),
    ]
    return statement(re.sub(r"\bFROM (fact|v[1-5])\b", rf"FROM \1{kind}", " UNION ALL ".join(parts)), f"v5{kind}")


def measure_sql() -> dict[str, str]:
    def amount(column: str) -> str:
        return f"coalesce(CAST(sum({column}) AS DOUBLE) / 1000, 0)"

    def pct(num: str, den: str) -> str:
        return share(f"sum({num})", f"sum({den})")

    core = {
        "total_income_m": "total_income_000s",
        "patient_care_income_m": "patient_care_income_000s",
        "other_income_m": "other_income_000s",
        "total_expenditure_m": "total_expenditure_000s",
        "operating_surplus_m": "operating_surplus_000s",
        "net_surplus_m": "net_surplus_000s",
        "total_pay_m": "pay_000s",
        "total_non_pay_m": "non_pay_000s",
        "depreciation_amort_m": "depreciation_amort_000s",
        "drugs_cost_m": "drugs_cost_000s",
        "clinical_negligence_m": "clinical_negligence_000s",
    }
    deficit = "count(*) FILTER (WHERE operating_surplus_000s < 0)"
    group = "FROM v5 GROUP BY financial_year, sector"
    margin = pct("ebitda_000s", "total_income_000s")
    net = pct("net_surplus_000s", "total_income_000s")
    pay = pct("pay_000s", "total_income_000s")
    colours = " ".join(f"WHEN '{s}' THEN '{c}'" for s, c in RAG_COLOURS.items())
    previous = "CASE n.financial_year " + " ".join(f"WHEN '{y}' THEN '{p}'" for y, p in PRIOR_YEARS.items()) + " END"
    by_year = f"""SELECT trust_type, financial_year, CAST(sum(total_income_000s) AS DOUBLE) / 1000 AS income,
        {margin} AS margin, {pay} AS pay, {deficit} AS deficits FROM v5 GROUP BY trust_type, financial_year"""
    surplus = "coalesce(sum(operating_surplus_000s), 0)"
    return {
        "m_core": statement(
            "SELECT financial_year, sector, "
            + ", ".join(f"{amount(column)} AS {name}" for name, column in core.items())
            + f" {group}",
            "v5",
        ),
        "m_kpi": statement(
            f"""SELECT financial_year, sector, {amount('ebitda_000s')} AS ebitda_m, {margin} AS ebitda_margin_pct,
            {pay} AS pay_pct_income, {net} AS net_surplus_margin_pct, {deficit} AS deficit_trusts,
            count(*) FILTER (WHERE operating_surplus_000s >= 0) AS surplus_trusts,
            count(DISTINCT org_code) AS total_trusts, {share(deficit, 'count(DISTINCT org_code)')} AS deficit_pct {group}""",
            "v5",
        ),
        "m_workforce": statement(
            f"""SELECT financial_year, sector, {total('total_wte')} AS total_wte,
            {amount('total_staff_cost_000s')} AS total_staff_cost_m,
            CAST(sum(total_staff_cost_000s) AS DOUBLE) / nullif(CAST(sum(total_wte) AS DOUBLE), 0) AS avg_cost_per_wte_000s,
            {total('medical_wte')} AS medical_wte, {total('nursing_wte')} AS nursing_wte,
            {pct('medical_wte', 'total_wte')} AS medical_pct_wte, {pct('nursing_wte', 'total_wte')} AS nursing_pct_wte {group}""",
            "v5",
        ),
        "m_yoy": statement(
            f"""SELECT n.trust_type, n.financial_year, {previous} AS prior_year,
            CASE WHEN {previous} IS NOT NULL THEN coalesce(p.income, 0) END AS prior_year_income_m,
            (n.income - p.income) / nullif(p.income, 0) * 100 AS income_yoy_growth_pct,
            p.margin AS prior_year_ebitda_margin_pct, n.margin - p.margin AS ebitda_margin_yoy_pp,
            p.pay AS prior_year_pay_pct, n.pay - p.pay AS pay_yoy_pp,
            CASE WHEN {previous} IS NOT NULL THEN coalesce(p.deficits, 0) END AS prior_year_deficit_trusts,
            CASE WHEN {previous} IS NOT NULL THEN n.deficits - coalesce(p.deficits, 0) END AS deficit_trusts_yoy_change
            FROM ({by_year}) n LEFT JOIN ({by_year}) p ON n.trust_type = p.trust_type AND p.financial_year = {previous}""",
            "v5",
        ),
        "m_rag": statement(
            f"""SELECT *, CASE ebitda_rag {colours} ELSE '{RAG_COLOUR_OTHER}' END AS ebitda_rag_colour,
            CASE surplus_rag {colours} ELSE '{RAG_COLOUR_OTHER}' END AS surplus_rag_colour FROM (
            SELECT financial_year, sector, region, {rag(margin, 5, 2)} AS ebitda_rag, {rag(net, 0, -2)} AS surplus_rag,
            CASE WHEN {pay} IS NULL THEN 'Grey' WHEN {pay} < 65 THEN 'Green' WHEN {pay} < 70 THEN 'Amber'
                 ELSE 'Red' END AS pay_rag FROM v5 GROUP BY financial_year, sector, region)""",
            "v5",
        ),
        "m_benchmark": statement(
            f"""SELECT financial_year, level AS sector_benchmark_ebitda_pct, margin - level AS ebitda_vs_benchmark_pp
            FROM (SELECT financial_year, {margin} AS margin FROM v5 GROUP BY financial_year)
            JOIN (SELECT financial_year, CAST(sum(avg_t) AS DOUBLE) / count(avg_t) / 10 AS level FROM ({BENCHMARKS})
                  GROUP BY financial_year) USING (financial_year)""",
            "v5",
        ),
        "m_labels": statement(
            f"""SELECT region, '{YEAR}' AS selected_year,
            CASE WHEN count(DISTINCT sector) = 1 THEN min(sector) ELSE 'All Sectors' END AS selected_sector,
            region AS selected_region, 'Income & Expenditure — {YEAR} | '
              || CASE WHEN count(DISTINCT sector) = 1 THEN min(sector) ELSE 'All Sectors' END AS page_title,
            '£' || format('{{:.1f}}', {number(f'abs({surplus})', '1000')}) || 'm '
              || CASE WHEN {surplus} >= 0 THEN 'surplus' ELSE 'deficit' END AS surplus_label,
            coalesce(format('{{:.1f}}', {wpct('ebitda_000s', 'total_income_000s')}), '') || '% EBITDA margin' AS ebitda_label,
            {deficit} || ' of ' || count(DISTINCT org_code) || ' trusts in deficit' AS deficit_count_label
            FROM v5 WHERE {IN_YEAR} AND trust_type = 'FOUNDATION_TRUST' GROUP BY region""",
            "v5",
        ),
    }


def dashboard_sql() -> dict[str, str]:
    by_sector = "FROM v5 GROUP BY financial_year, sector"
    income_m = f"{number('total_income_000s', '1000')} AS total_income_m"
    return {
        "dash_income_by_sector": statement(
            f"""SELECT financial_year, sector, {m('patient_care_income_000s', 1)} AS patient_income_m,
            {m('other_income_000s', 1)} AS other_income_m, {m('total_income_000s', 1)} AS total_income_m {by_sector}""",
            "v5",
        ),
        "dash_deficit_split": statement(
            _unpivot(
                {
                    "Deficit": "count(*) FILTER (WHERE operating_surplus_000s < 0)",
                    "Surplus": "count(*) FILTER (WHERE operating_surplus_000s >= 0)",
                },
                "v5",
                "position",
                "trusts",
            ),
            "v5",
        ),
        "dash_income_bridge": statement(
            _unpivot(
                {
                    "Income": m("total_income_000s", 1),
                    "Expenditure": m("-total_expenditure_000s", 1),
                    "Surplus": m("operating_surplus_000s", 1),
                },
                "v5",
                "step",
                "value_m",
            ),
            "v5",
        ),
        "dash_trust_year_matrix": statement(
            """SELECT org_code, organisation_name, financial_year, total_income_000s, total_expenditure_000s,
            operating_surplus_000s FROM v1""",
            "v1",
        ),
        "dash_ebitda_income": statement(f"SELECT {HEAD}, {tenths('ebitda_t')} AS ebitda_margin_pct, {income_m} FROM v4", "v4"),
        "dash_pay_ebitda": statement(
            f"SELECT {HEAD}, {tenths('pay_t')} AS pay_pct_income, {tenths('ebitda_t')} AS ebitda_margin_pct FROM v4", "v4"
        ),
        "dash_spend_mix": statement(
            _unpivot(
                {
                    "Pay": m("pay_000s", 1),
                    "Non-pay": m("non_pay_000s", 1),
                    "D&A": m("depreciation_amort_000s", 1),
                },
                "v5",
                "category",
                "value_m",
            ),
            "v5",
        ),
        "dash_wte_by_sector": statement(
            f"SELECT financial_year, sector, {total('total_wte')} AS total_wte {by_sector}", "v5"
        ),
        "dash_staff_cost_trend": statement(
            f"""SELECT financial_year, {bn('total_staff_cost_000s', 2)} AS staff_cost_bn, {total('total_wte')} AS total_wte,
            {number('sum(total_staff_cost_000s)', 'sum(total_wte)')} AS cost_per_wte_000s
            FROM v5 GROUP BY financial_year""",
            "v5",
        ),
        "dash_best_ebitda": statement(
            _top(
                f"{HEAD}, {tenths('ebitda_t')} AS ebitda_margin_pct, {income_m}",
                "v5",
                IN_YEAR,
                "ebitda_t DESC NULLS LAST, org_code",
                20,
            ),
            "v5",
        ),
        "dash_cost_per_wte": statement(
            f"SELECT {HEAD}, total_wte, staff_cost_000s, {tenths('cost_t')} AS cost_per_wte_000s FROM v5 WHERE {IN_YEAR}",
            "v5",
        ),
    }


def monthly_sql() -> dict[str, str]:
    keys = "org_code, financial_year"
    sides = f"SELECT {keys}, {total('actual')} AS a, {total('budget')} AS b FROM monthly"
    share = units("(100 * a)", "b", 1)
    pay = """SELECT org_code, financial_year, CAST(coalesce(sum(actual) FILTER (WHERE NOT agency), 0) AS BIGINT) AS p,
        CAST(coalesce(sum(actual) FILTER (WHERE agency), 0) AS BIGINT) AS g FROM monthly
        WHERE account_type = 'PAY' OR agency GROUP BY org_code, financial_year"""
    agency = units("(100 * g)", "(p + g)", 1)
    ytd = "OVER (PARTITION BY org_code, financial_year, account_type ORDER BY period ROWS UNBOUNDED PRECEDING)"
    variance = units("(100 * (a - b))", "abs(b)", 1)
    good = "CASE WHEN account_type = 'INCOME' THEN 1 ELSE -1 END"
    return {
        "kpi_cip": statement(
            f"""SELECT {keys}, a AS delivered_000s, b AS target_000s, {tenths(share)} AS cip_achievement_pct,
            CASE WHEN a IS NULL OR coalesce(b, 0) = 0 THEN 'Grey' WHEN 100 * a >= 100 * b THEN 'Green'
                 WHEN 100 * a >= 80 * b THEN 'Amber' ELSE 'Red' END AS cip_rag FROM ({sides} WHERE account_type = 'CIP' GROUP BY {keys})""",
            "monthly",
        ),
        "kpi_agency": statement(
            f"""SELECT {keys}, p AS pay_000s, g AS agency_000s, {tenths(agency)} AS agency_pct,
            CAST(p + g > 0 AND 1000 * g >= 35 * (p + g) AS INT) AS over_ceiling FROM ({pay})""",
            "monthly",
        ),
        "kpi_capital": statement(
            f"""SELECT {keys}, a AS actual_000s, b AS plan_000s, {tenths(share)} AS capital_pct,
            CASE WHEN a IS NULL OR coalesce(b, 0) = 0 THEN 'Grey' WHEN 100 * a > 110 * b OR 100 * a < 75 * b THEN 'Red'
                 WHEN 100 * a < 90 * b THEN 'Amber' ELSE 'Green' END AS capital_rag
            FROM ({sides} WHERE account_type = 'CAPITAL' GROUP BY {keys})""",
            "monthly",
        ),
        "kpi_budget_variance": statement(
            f"""SELECT {keys}, account_type, period, a AS actual_000s, b AS budget_000s, a - b AS variance_000s,
            {tenths(variance)} AS variance_pct, CASE WHEN (a - b) * {good} >= 0 THEN 'FAV' ELSE 'ADV' END AS direction,
            CASE WHEN b = 0 THEN 'Grey' WHEN (a - b) * {good} >= 0 THEN 'Green'
                 WHEN 100 * (a - b) * {good} >= -2 * abs(b) THEN 'Amber' ELSE 'Red' END AS variance_rag, CAST(sum(a) {ytd} AS BIGINT) AS ytd_actual_000s,
            CAST(sum(b) {ytd} AS BIGINT) AS ytd_budget_000s, CAST(sum(a - b) {ytd} AS BIGINT) AS ytd_variance_000s
            FROM (SELECT {keys}, account_type, period, {total('actual')} AS a, {total('budget')} AS b FROM monthly
                  WHERE account_type IN ('INCOME', 'PAY', 'NON_PAY') GROUP BY ALL)""",
            "monthly",
        ),
    }


def oracle_sql() -> dict[str, str]:
    found = {
        **ingest_sql(),
        **view_sql(),
        **extract_sql(),
        **trend_sql(),
        **benchmark_sql(),
        **validation_sql(),
        **measure_sql(),
        **dashboard_sql(),
        **monthly_sql(),
    }
    found |= linked_sql(found, statement("SELECT * FROM trust", "trust"))
    found |= {**history_sql(), **subtotal_sql(), **cube_sql(found)}
    trend = trend_sql()["national_trend"]
    body = trend[trend.rindex("SELECT financial_year") :]
    found["scorecard_refresh"] = found["scorecard"]
    found |= {f"sql_{name}": found[name] for name in ("top_income", "worst_net_margin", "sector_kpis", "regional_health")}
    found["sql_sector_members"] = statement(
        f"SELECT org_code, organisation_name, region, total_income_000s, is_deficit FROM v5 WHERE financial_year = '{PRIOR}' AND sector = '{SECTORS[1]}'", "v5"
    )
    found["sql_ebitda_change"] = statement(
        f"""SELECT org_code, n.organisation_name, {tenths('p.ebitda_t')} AS ebitda_prior_pct, {tenths('n.ebitda_t')} AS ebitda_current_pct,
        {tenths('(n.ebitda_t - p.ebitda_t)')} AS yoy_change_pp FROM v5 n JOIN v5 p USING (org_code)
        WHERE n.financial_year = '{YEAR}' AND p.financial_year = '{PRIOR}'""",
        "v5",
    )
    unknown = CTES["trust"].replace(
        f"{SECTOR.format('s_suppkey')} AS sector, r_name AS region",
        f"CASE WHEN s_suppkey % 9 <> 4 THEN {SECTOR.format('s_suppkey')} END AS sector, CASE WHEN s_suppkey % 14 <> 5 THEN r_name END AS region",
    )
    for name in ("trust_flags", "sector_benchmarks_median", "sector_benchmarks", "pay_trend", "pay_pressure", "regional_health", "m_kpi"):
        found[f"{name}_unknown"] = found[name].replace(CTES["trust"], unknown)
    found["pay_trend_unknown"] = found["pay_trend_unknown"].replace("FROM v5 GROUP BY", "FROM v5 WHERE sector IS NOT NULL GROUP BY")
    found["csv_round_trip"], found["report_round_trip"] = found["ie_summary_extract"], found["audit_report"]
    found["discover_files"] = statement("SELECT DISTINCT source_file || '_p' || row_num % 4 || '.csv' AS file_name FROM named", "named")
    found["stg_replace"] = statement(f"SELECT * REPLACE (total + CASE WHEN financial_year = '{YEAR}' THEN 0 ELSE 1 END AS total) FROM clean", "clean")
    found["dim_trust_upsert"] = statement(
        f"SELECT *, CASE WHEN last_year_seen >= '{YEAR}' THEN '2002-01-02' ELSE '2002-01-01' END AS updated_ts FROM built", "built"
    )
    found["stg_from_source"] = statement("SELECT * EXCLUDE (source_file), source_file || '_p' || row_num % 4 || '.csv' AS source_file FROM clean", "clean")
    found["national_trend_from_files"] = statement(body.replace("FROM v5", "FROM v5_files"), "v5_files")
    return found
