"""Expressions shared by every plan: exact ratios, averages, status colours, labels, periods.

Arguments are SQL text (a column name or an expression) and each helper is one parsed expression; wide
plans have hundreds of columns, and building those operator by operator from Python costs more than
running small queries. Money and head counts are BIGINT. Percentages are kept as DECIMAL with one digit,
so an average of percentages is exact and does not depend on the order in which partitions are added
up. Reports turn the final rounded value into DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

PCT = "decimal(20,1)"


def named(columns: dict[str, str]) -> list[Column]:
    """SQL expressions under their output names."""
    return [F.expr(f"{sql} AS `{name}`") for name, sql in columns.items()]


def select(df: DataFrame, *columns: str) -> DataFrame:
    """A long select list, handed to Spark as one statement."""
    return df.sparkSession.sql(f"SELECT {', '.join(columns)} FROM {{rows}}", rows=df)


def aggregate(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """A long aggregation, handed to Spark as one statement."""
    by = ", ".join(keys)
    outputs = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return df.sparkSession.sql(f"SELECT {by}, {outputs} FROM {{rows}} GROUP BY {by}", rows=df)


def quotient(num: str, den: str, times: int = 1) -> str:
    """Exact num * times / den; NULL for a zero or missing denominator."""
    return f"(CAST({num} AS DECIMAL(24,0)) * {times} / nullif(CAST({den} AS DECIMAL(24,0)), 0))"


def ratio(num: str, den: str, digits: int = 1, times: int = 1) -> str:
    """num * times / den rounded half away from zero, as DOUBLE."""
    return f"CAST(round({quotient(num, den, times)}, {digits}) AS DOUBLE)"


def pct(num: str, den: str, digits: int = 1) -> str:
    """num as a percentage of den, as DOUBLE."""
    return ratio(num, den, digits, 100)


def kpi(num: str, den: str, times: int = 1) -> str:
    """A ratio with one digit as DECIMAL, for columns that are averaged later."""
    return f"CAST(round({quotient(num, den, times)}, 1) AS {PCT})"


def kpi_even(num: str, den: str, times: int = 1) -> str:
    """As ``kpi``, rounded half to even."""
    return f"CAST(bround({quotient(num, den, times)}, 1) AS {PCT})"


def scaled(total: str, unit: int, digits: int) -> str:
    """A £000 total in millions (unit 1,000) or billions (unit 1,000,000), as DOUBLE."""
    return ratio(total, str(unit), digits)


def mean(column: str, digits: int = 1) -> str:
    """Average of a DECIMAL column rounded half away from zero, as DOUBLE."""
    return f"CAST(round(avg({column}), {digits}) AS DOUBLE)"


def mean_even(column: str, digits: int = 1) -> str:
    """Average of a DECIMAL column rounded half to even, as DOUBLE."""
    return f"CAST(bround(avg({column}), {digits}) AS DOUBLE)"


def weighted_pct(num: str, den: str, digits: int = 1) -> str:
    """Percentage of sums (not a mean of percentages), as DOUBLE."""
    return pct(f"sum({num})", f"sum({den})", digits)


def divide(num: str, den: str, times: int = 1) -> str:
    """Unrounded DOUBLE quotient; NULL for a zero or missing denominator."""
    top = f"(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0D))"
    return f"({top} * {times}D)" if times != 1 else top


def double(column: str) -> str:
    return f"CAST({column} AS DOUBLE)"


def flag(condition: str) -> str:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def rag(value: str, green_from, amber_from) -> str:
    """Status of a higher-is-better value; a missing value is Grey."""
    return (
        f"CASE WHEN {value} IS NULL THEN 'Grey' WHEN {value} >= {green_from} THEN 'Green' "
        f"WHEN {value} >= {amber_from} THEN 'Amber' ELSE 'Red' END"
    )


def rag_below(value: str, green_below, amber_below) -> str:
    """Status of a lower-is-better value; a missing value is Grey."""
    return (
        f"CASE WHEN {value} IS NULL THEN 'Grey' WHEN {value} < {green_below} THEN 'Green' "
        f"WHEN {value} < {amber_below} THEN 'Amber' ELSE 'Red' END"
    )


def scale_of(df: DataFrame, column: str) -> int:
    """Fractional digits that a column keeps; 0 for a missing column, which the plan that reads it reports."""
    kind = next((f.dataType for f in df.schema.fields if f.name == column), None)
    return kind.scale if isinstance(kind, DecimalType) else 0


def amount(df: DataFrame, column: str = "total_000s") -> str:
    """A total as the number that plans add up: BIGINT if the table keeps whole units, DECIMAL if it keeps fractions."""
    return column if scale_of(df, column) else f"CAST({column} AS BIGINT)"


def literal(value) -> str:
    """A value as SQL text; a quote is joined in by its code, which holds under either way of escaping."""
    if not isinstance(value, str):
        return str(value)
    parts = [f"'{part}'" if "\\" not in part else "concat(" + ", chr(92), ".join(f"'{p}'" for p in part.split("\\")) + ")" for part in value.split("'")]
    return parts[0] if len(parts) == 1 else "concat(" + ", chr(39), ".join(parts) + ")"


def lookup(key: str, table: dict, default: str = "NULL") -> str:
    """A small fixed table as a CASE; keys outside it give ``default`` (SQL text)."""
    cases = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in table.items())
    return f"CASE {key} {cases} ELSE {default} END"


def signed_label(value: str, unit: str) -> str:
    """``+1.5pp`` / ``-0.3pp`` / ``0.0pp``; NULL stays NULL."""
    return f"concat(CASE WHEN {value} > 0 THEN '+' ELSE '' END, CAST({value} AS STRING), '{unit}')"


def thousands(value: str, digits: int = 0) -> str:
    """Display text with thousands separators, rounded half away from zero first."""
    return f"format_number(round({value}, {digits}), {digits})"


def fiscal_year_start(date: str) -> str:
    """Calendar year in which the April-to-March year of a date begins."""
    return f"(year({date}) - CASE WHEN month({date}) < 4 THEN 1 ELSE 0 END)"


def year_label(start_year: str) -> str:
    """2023 -> ``2023/24``."""
    return f"concat(CAST({start_year} AS STRING), '/', lpad(CAST(({start_year} + 1) % 100 AS STRING), 2, '0'))"


def financial_year(date: str) -> str:
    return year_label(fiscal_year_start(date))


def fiscal_month(date: str) -> str:
    """1 for April to 12 for March."""
    return f"((month({date}) + 8) % 12 + 1)"


def period_label(date: str) -> str:
    return f"concat('M', lpad(CAST({fiscal_month(date)} AS STRING), 2, '0'))"


def quarter_label(date: str) -> str:
    return f"concat('Q', CAST(ceil({fiscal_month(date)} / 3) AS STRING))"
