"""Provider accounts derived from the order tables, so that every query grows with them.

A supplier is an organisation, a shipped line is a ledger posting, and the financial year is that of
the ship date. ``facts`` reads ``lineitem`` once and shuffles once: postings are summed per
organisation and year on integer keys (partial sums before the shuffle, so one busy supplier costs one
row per task and key), and the account lines are then unfolded from that one row in the same stage.

Organisation codes have nine digits, or as many as the supplier's number needs: no number is ever cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provfin.functions import expr
from provfin.functions.session import hadoop_path, working_folder
from provfin.refdata import WS_EXPENDITURE, WS_OTHER_INCOME, WS_PATIENT_INCOME, WS_SOCI, WS_STAFF

CODE_WIDTH = 9
YEAR, PRIOR, BASE = "2000/01", "1999/00", "1998/99"
PRIOR_YEARS = {"2000/01": "1999/00", "1999/00": "1998/99", "1998/99": "1997/98"}

SECTORS = ["Acute", "Mental Health", "Community", "Ambulance", "Specialist"]

# Posting slot (first, last) of each account line.
SLOTS = [
    (0, 2, WS_PATIENT_INCOME, "INC0197"),
    (3, 5, WS_PATIENT_INCOME, "INC0198"),
    (6, 6, WS_PATIENT_INCOME, "INC0200"),
    (7, 7, WS_PATIENT_INCOME, "INC0330"),
    (8, 8, WS_PATIENT_INCOME, "INC0340"),
    (9, 9, WS_OTHER_INCOME, "INC1230A"),
    (10, 10, WS_OTHER_INCOME, "INC1240A"),
    (11, 11, WS_OTHER_INCOME, "INC1280A"),
    (12, 16, WS_EXPENDITURE, "EXP0130"),
    (17, 17, WS_EXPENDITURE, "EXP0300"),
    (18, 18, WS_EXPENDITURE, "EXP0150"),
    (19, 19, WS_EXPENDITURE, "EXP0160"),
    (20, 20, WS_EXPENDITURE, "EXP0170"),
    (21, 21, WS_EXPENDITURE, "EXP0290A"),
    (22, 22, WS_EXPENDITURE, "EXP0240"),
    (23, 23, WS_EXPENDITURE, "EXP0250"),
]


# Declared schemas: no job has to read a footer to plan a query.
SCHEMAS = {
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,
        l_extendedprice DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "nation": "n_nationkey INT, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def org_code(suppkey: str) -> str:
    return f"lpad(CAST({suppkey} AS STRING), greatest({CODE_WIDTH}, length(CAST({suppkey} AS STRING))), '0')"


def trust_type(suppkey: str) -> str:
    return f"CASE WHEN {suppkey} % 3 = 0 THEN 'NHS_TRUST' ELSE 'FOUNDATION_TRUST' END"


SLOT = "(l_partkey * 7 + l_linenumber * 3 + l_orderkey) % 24"
SHIP_DATE = "CAST(l_shipdate AS DATE)"
VALUE = "CAST(floor(l_extendedprice / 2) AS BIGINT)"
PRIOR_LINE = "(l_returnflag = 'R' AND l_linestatus = 'F')"


def _lines(spark: SparkSession, sf_dir: str, years: list[str] | None) -> DataFrame:
    """Shipped lines; ``years`` becomes a ship-date range the Parquet scan can skip row groups by."""
    lines = table(spark, sf_dir, "lineitem")
    if years is None:
        return lines
    first, last = int(min(years)[:4]), int(max(years)[:4]) + 1
    return lines.filter(
        f"l_shipdate >= TIMESTAMP_NTZ '{first}-04-01 00:00:00' AND l_shipdate < TIMESTAMP_NTZ '{last}-04-01 00:00:00'"
    )


# Account lines of an organisation-year: (worksheet, main-code suffix, sub-code, value over the yearly sums).
_ACTIVE = "coalesce(patient, other, spend) IS NOT NULL"
_SURPLUS = "coalesce(patient, 0) + coalesce(other, 0) - coalesce(spend, 0)"
_FINANCE = "l_suppkey % 7 * 100", "l_suppkey % 5 * 150", "l_suppkey % 4 * 5000"


def _active(value: str) -> str:
    return f"CASE WHEN {_ACTIVE} THEN {value} END"


def _staffed(value: str) -> str:
    return f"CASE WHEN (l_suppkey + start_year) % 11 <> 0 THEN {value} END"


ACCOUNT_LINES = [
    *[(ws, "", code, code) for _, _, ws, code in SLOTS],
    (WS_SOCI, "", "SCI0100A", "patient"),
    (WS_SOCI, "", "SCI0110A", "other"),
    (WS_SOCI, "", "SCI0125A", "-spend"),
    (WS_SOCI, "", "SCI0140A", _active(_SURPLUS)),
    (WS_SOCI, "", "SCI0150", _active(_FINANCE[0])),
    (WS_SOCI, "", "SCI0160", _active(_FINANCE[1])),
    (WS_SOCI, "", "SCI0170", _active(_FINANCE[2])),
    (WS_SOCI, "", "SCI0240", _active(f"{_SURPLUS} + {_FINANCE[0]} - {_FINANCE[1]} - {_FINANCE[2]}")),
    (WS_PATIENT_INCOME, "", "INC0350", "patient"),
    (WS_OTHER_INCOME, "", "INC1360", "other"),
    (WS_EXPENDITURE, "", "EXP0390", "spend"),
    (WS_EXPENDITURE, "", "EXP0200", "spend DIV 50"),
    (WS_EXPENDITURE, "", "EXP0210", "spend DIV 80"),
    (WS_EXPENDITURE, "", "EXP0220", "spend DIV 120"),
    (WS_STAFF, "", "STA0220", "pay + 1000"),
    (WS_STAFF, "", "STA0250", "pay"),
    (WS_STAFF, "", "STA0410", _staffed("wte * 10")),
    (WS_STAFF, "P", "STA0410", _staffed("wte * 8")),
    (WS_STAFF, "", "STA0310", _staffed("medical * 10")),
    (WS_STAFF, "", "STA0350", _staffed("nursing * 10")),
    (WS_STAFF, "", "STA0550", _staffed("wte % 15 + 5")),
    (WS_STAFF, "", "STA0330", _staffed("wte * 2")),
    (WS_STAFF, "", "STA0340", _staffed("wte * 3")),
    (WS_STAFF, "", "STA0370", _staffed("wte")),
    (WS_STAFF, "", "STA0530", _staffed("wte * (wte % 15 + 5)")),
]


def facts(
    spark: SparkSession, sf_dir: str, include_prior: bool = False, years: list[str] | None = None
) -> DataFrame:
    """The fact table; without ``include_prior`` only current-year lines, as a load leaves it.

    ``years`` limits the scan to the span of the financial years a report asks for.
    """
    lines = _lines(spark, sf_dir, years)
    keys = ["l_suppkey", "start_year"]
    year_type = "'CY'"
    if include_prior:
        keys.append("year_type")
        year_type = "year_type"
    else:
        lines = lines.filter("l_returnflag <> 'R' OR l_linestatus <> 'F'")
    posted = lines.selectExpr(
        "l_suppkey",
        f"{expr.fiscal_year_start(SHIP_DATE)} AS start_year",
        f"CASE WHEN {PRIOR_LINE} THEN 'PY' ELSE 'CY' END AS year_type",
        f"{SLOT} AS slot",
        f"{VALUE} AS v",
        "CAST(floor(l_quantity) AS BIGINT) AS q",
    )

    def total(first: int, last: int, value: str = "v") -> str:
        return f"sum(CASE WHEN slot BETWEEN {first} AND {last} THEN {value} END)"

    sums = {code: total(first, last) for first, last, _, code in SLOTS}
    sums |= {"medical": total(0, 2, "q"), "nursing": total(3, 10, "q"), "wte": "sum(q)"}

    def together(*sheets: str, codes: tuple[str, ...] = ()) -> str:
        """Sum of account lines; NULL only if all are."""
        parts = [code for _, _, ws, code in SLOTS if ws in sheets or code in codes]
        added = " + ".join(f"coalesce({p}, 0)" for p in parts)
        return f"CASE WHEN coalesce({', '.join(parts)}) IS NOT NULL THEN {added} END"

    year = expr.select(
        expr.aggregate(posted, keys, sums),
        "*",
        f"{together(WS_PATIENT_INCOME)} AS patient",
        f"{together(WS_OTHER_INCOME)} AS other",
        f"{together(WS_EXPENDITURE)} AS spend",
        f"{together(codes=('EXP0130', 'EXP0300'))} AS pay",
    )
    unfolded = ", ".join(
        f"struct('{ws}' AS worksheet_name, '{suffix}' AS suffix, '{code}' AS sub_code, {value} AS total)"
        for ws, suffix, code, value in ACCOUNT_LINES
    )
    return (
        year.selectExpr(
            f"{org_code('l_suppkey')} AS org_code",
            f"{expr.year_label('start_year')} AS financial_year",
            f"{trust_type('l_suppkey')} AS trust_type",
            f"{year_type} AS year_type",
            f"inline(array({unfolded}))",
        )
        .filter("total IS NOT NULL")
        .selectExpr(
            "org_code",
            "financial_year",
            "worksheet_name",
            "CAST(1 AS SMALLINT) AS table_id",
            "concat('A', substr(worksheet_name, 4, 2), year_type, '01', suffix) AS main_code",
            "sub_code",
            "CAST(total AS DECIMAL(14,0)) AS total_000s",
            "trust_type",
            "'fixture' AS source_file",
        )
    )


def dirty_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts with every fault an audit looks for: repeated keys, unknown, blank and missing codes, imbalances, absurd staff."""
    number = "CAST(org_code AS BIGINT)"
    clean = facts(spark, sf_dir)
    twice = clean.filter(f"sub_code = 'INC0350' AND {number} % 10 = 0")
    changed = {
        "org_code": f"""CASE WHEN {number} % 50 = 7 THEN concat('X', org_code) WHEN {number} % 60 = 9 THEN ' '
            WHEN {number} % 70 = 11 THEN NULL ELSE org_code END""",
        "total_000s": f"""CAST(CASE WHEN sub_code = 'SCI0140A' AND {number} % 8 = 1 THEN total_000s + 5000
            WHEN sub_code = 'STA0410' AND {number} % 9 = 2 THEN total_000s * 1000 ELSE total_000s END AS DECIMAL(14,0))""",
    }
    return clean.unionByName(twice).selectExpr(*[f"{changed.get(c, c)} AS {c}" for c in clean.columns])


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation, region = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )


def sector(suppkey: str) -> str:
    return expr.lookup(f"{suppkey} % 5", dict(enumerate(SECTORS)))


def dim_trust(spark: SparkSession, sf_dir: str, seen: bool = False, unknown: bool = False) -> DataFrame:
    """Organisations; with ``seen`` also the first and last year that has postings of them, with ``unknown`` some without sector or region."""
    trusts = _suppliers(spark, sf_dir)
    columns = []
    if seen:
        years = _posted_years(spark, sf_dir).groupBy("l_suppkey").agg(F.min("start_year").alias("low"), F.max("start_year").alias("high"))
        trusts = trusts.join(years, trusts.s_suppkey == years.l_suppkey, "left")
        columns = [f"{expr.year_label('low')} AS first_year_seen", f"{expr.year_label('high')} AS last_year_seen"]
    return trusts.selectExpr(
        f"{org_code('s_suppkey')} AS org_code",
        "s_name AS organisation_name",
        f"{trust_type('s_suppkey')} AS trust_type",
        f"{sector('s_suppkey')} AS sector" if not unknown else f"CASE WHEN s_suppkey % 9 <> 4 THEN {sector('s_suppkey')} END AS sector",
        "r_name AS region" if not unknown else "CASE WHEN s_suppkey % 14 <> 5 THEN r_name END AS region",
        f"{expr.flag('s_suppkey % 3 <> 0')} AS is_foundation",
        *columns,
    )


def _posted_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The years in which each supplier has postings."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.selectExpr("l_suppkey", f"{expr.fiscal_year_start(SHIP_DATE)} AS start_year").distinct()


# --- raw extracts, as published: drifting names, spaces, text totals -------------------------------


def _by_slot(values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), CAST(slot AS INT) + 1)"


def _unfolded(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Texts of a published row, unfolded from a one-element array: filters and cleaning read them and do not write them out again.

    Written out for each use, they make a generated method of more than 8,000 bytes, which the JVM never compiles.
    """
    row = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return rows.selectExpr(f"inline(array(struct({row})))")


def raw_lines(spark: SparkSession, sf_dir: str, years: str = "true") -> DataFrame:
    """One published account line per shipped line, under the published headers, all text.

    ``years`` (SQL text over ``start_year``) chooses lines before their texts are written out. Names differ in case and spacing, and some names, codes and totals are missing, unreadable or too large.
    """
    by_slot = [(ws, code) for first, last, ws, code in SLOTS for _ in range(first, last + 1)]
    codes = [code for _, code in by_slot]
    sheets = [ws for ws, _ in by_slot[:-1]] + ["TAC08 Extra"]
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey",
        f"{VALUE} AS value",
        f"{SLOT} AS slot",
        f"CASE WHEN {PRIOR_LINE} THEN 'PY01' ELSE 'CY01' END AS main_suffix",
        f"{expr.fiscal_year_start(SHIP_DATE)} AS start_year",
        "l_orderkey * 8 + l_linenumber AS row_number",
        "l_orderkey + l_linenumber AS mix",
    ).filter(years)
    columns = {
        "OrganisationName": f"""CASE WHEN mix % 3 <> 2 OR mix % 97 <> 0 THEN concat(
            CASE mix % 3 WHEN 0 THEN ' Supplier#' WHEN 1 THEN 'SUPPLIER#' ELSE 'Supplier#' END,
            {org_code("l_suppkey")}, '  ') END""",
        "WorkSheetName": _by_slot(sheets),
        "TableID": "'1'",
        "MainCode": f"concat({_by_slot(['A' + ws[3:5] for ws in sheets])}, main_suffix)",
        "RowNumber": "CAST(row_number AS STRING)",
        "SubCode": f"CASE WHEN mix % 89 <> 0 THEN {_by_slot([' ' + c for c in codes])} END",
        "Total": """CASE WHEN mix % 11 = 0 THEN format_number(value, 0) WHEN mix % 13 = 0 THEN concat(value, '.9')
            WHEN mix % 17 = 0 THEN 'n/a' WHEN mix % 79 = 0 THEN concat(value, '00000000000000') WHEN mix % 83 <> 0 THEN CAST(value AS STRING) END""",
        "source_file": """concat(CASE WHEN l_suppkey % 3 = 0 THEN 'TAC_NHS_trusts_' ELSE 'TAC_NHS_foundation_trusts_' END,
            start_year, '-', lpad((start_year + 1) % 100, 2, '0'))""",
    }
    return _unfolded(lines, columns)


def publish(lines: DataFrame, folder: str, parts: int = 4) -> None:
    """Raw lines as CSV files named after their ``source_file``, each in ``parts`` files of its own (``..._p0.csv``), by row number."""
    spark = lines.sparkSession
    files, home = hadoop_path(spark, folder)
    files.mkdirs(home)
    draft = f"{working_folder(spark)}/draft"
    part = f"concat(source_file, '_p', CAST(RowNumber AS BIGINT) % {parts}, '.csv')"
    plain = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    named = lines.withColumn("source_file", F.expr(part)).repartition("source_file")
    named.write.options(**plain).partitionBy("source_file").csv(draft)
    for found in files.globStatus(hadoop_path(spark, f"{draft}/source_file=*/part-*")[1]):
        name = found.getPath().getParent().getName().removeprefix("source_file=")
        files.rename(found.getPath(), hadoop_path(spark, f"{folder}/{name}")[1])


def raw_accounts(spark: SparkSession, sf_dir: str, fractions: bool = False) -> DataFrame:
    """The yearly account lines as files hold them, of all worksheets: published headers, all text, prior years too.

    With ``fractions`` the staff lines have three more digits behind the point.
    """
    # Counting the lines ends the generated method that sums and unfolds; with the texts in it too, the JVM would not compile it.
    lines = facts(spark, sf_dir, include_prior=True).observe("account_lines", F.count(F.lit(1)).alias("lines"))
    behind = "lpad(CAST((CAST(org_code AS BIGINT) * 7 + CAST(substr(sub_code, 4) AS INT)) % 100 AS STRING), 2, '0')"
    shown = "format_number(total_000s, 0)"
    columns = {
        "OrganisationName": "concat(' SUPPLIER#', org_code, ' ')",
        "WorkSheetName": "worksheet_name",
        "TableID": "CAST(table_id AS STRING)",
        "MainCode": "main_code",
        "RowNumber": "'1'",
        "SubCode": "concat(sub_code, ' ')",
        "Total": f"CASE WHEN sub_code LIKE 'STA%' THEN concat({shown}, '.', {behind}, '9') ELSE {shown} END" if fractions else shown,
        "source_file": """concat(CASE trust_type WHEN 'NHS_TRUST' THEN 'TAC_NHS_trusts_' ELSE 'TAC_NHS_foundation_trusts_' END,
            replace(financial_year, '/', '-'))""",
    }
    return _unfolded(lines, columns)


def raw_providers(spark: SparkSession, sf_dir: str, moving: bool = False) -> DataFrame:
    """The provider lists of all yearly files, under the published headers: an organisation is listed in years with postings.

    Every 17th supplier is never listed; from 2000/01 on every 13th has no sector and every 19th a new name; some
    have a code of the wrong length or none. With ``moving`` every eleventh supplier is in another sector in 1999/00 alone.
    """
    years = _posted_years(spark, sf_dir).filter("l_suppkey % 17 <> 16")
    suppliers = _suppliers(spark, sf_dir)
    listed = years.join(suppliers, years.l_suppkey == suppliers.s_suppkey)
    late = f"start_year >= {YEAR[:4]}"
    shown = sector(f"(s_suppkey + CASE WHEN s_suppkey % 11 = 5 AND start_year = {PRIOR[:4]} THEN 1 ELSE 0 END)") if moving else sector("s_suppkey")
    columns = {
        "`Full name of Provider`": f"CASE WHEN s_suppkey % 19 = 18 AND {late} THEN concat(s_name, ' Group') ELSE concat(' ', s_name) END",
        "`NHS code`": f"""CASE WHEN s_suppkey % 46 = 22 THEN '7Q'
            WHEN s_suppkey % 46 <> 45 THEN concat({org_code("s_suppkey")}, ' ') END""",
        "Region": "r_name",
        "Sector": f"CASE WHEN NOT (s_suppkey % 13 = 12 AND {late}) THEN {shown} END",
        "`Comments `": "CAST(NULL AS STRING)",
        "source_file": f"""concat(CASE WHEN s_suppkey % 3 = 0 THEN 'TAC_NHS_trusts_' ELSE 'TAC_NHS_foundation_trusts_' END,
            replace({expr.year_label('start_year')}, '/', '-'))""",
    }
    # Conditions on the year of a list would otherwise run on the name of its file for every shipped line, in a scan for each.
    return _unfolded(listed, columns)


# --- monthly returns -------------------------------------------------------------------------------


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An actual and a budget per order; fifty customers make an organisation."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        f"{org_code('o_custkey DIV 50')} AS org_code",
        "CAST(o_orderdate AS DATE) AS day",
        "o_orderkey",
        "CAST(floor(o_totalprice / 100) AS BIGINT) AS amount",
    )
    kinds = ["INCOME", "INCOME", "INCOME", "PAY", "NON_PAY", "CAPITAL", "CIP"]
    listed = ", ".join(f"'{k}'" for k in kinds)
    posted = orders.selectExpr(
        "org_code",
        f"{expr.financial_year('day')} AS financial_year",
        f"{expr.period_label('day')} AS period",
        f"element_at(array({listed}), CAST(o_orderkey % 7 AS INT) + 1) AS account_type",
        "CASE WHEN o_orderkey % 7 = 4 AND o_orderkey % 3 = 0 THEN 'AGENCY' ELSE 'GENERAL' END AS subjective_code",
        """inline(array(struct('ACTUAL' AS data_type, amount AS amount_000s),
            struct('BUDGET' AS data_type, amount * (85 + o_orderkey % 31) DIV 100 AS amount_000s)))""",
    )
    return posted
