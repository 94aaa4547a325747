"""Account lines to columns.

The views read the fact through one operator: a fixed list of conditional MAX / SUM columns, grouped by
organisation and year in a single aggregation. Spark combines partial results before the shuffle, so
what travels is one row per organisation-year and task, however many lines a hot organisation has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from provfin.functions import expr

KEYS = ["org_code", "financial_year"]


@dataclass(frozen=True)
class Line:
    """Largest value of a sub-code; ``worksheet`` None means on any worksheet, ``seeded`` that the dimension must know the code."""

    name: str
    sub_code: str
    worksheet: str | None
    seeded: bool = False

    def sql(self) -> str:
        on_sheet = f" AND worksheet_name = {expr.literal(self.worksheet)}" if self.worksheet else ""
        on_sheet += " AND seeded = 1" if self.seeded else ""
        return f"max(CASE WHEN sub_code = {expr.literal(self.sub_code)}{on_sheet} THEN total END)"


@dataclass(frozen=True)
class Category:
    """Sum over a category of seeded sub-codes on one worksheet; NULL without any seeded line there."""

    name: str
    category: str
    worksheet: str

    def sql(self) -> str:
        in_category = f"CASE WHEN analytics_category = {expr.literal(self.category)} THEN total ELSE 0 END"
        return f"sum(CASE WHEN worksheet_name = {expr.literal(self.worksheet)} AND seeded = 1 THEN {in_category} END)"


@dataclass(frozen=True)
class Present:
    """1 if there is any line on a worksheet (with ``seeded``, any whose code the dimension knows), else NULL."""

    name: str
    worksheet: str
    seeded: bool = False

    def sql(self) -> str:
        return f"max(CASE WHEN worksheet_name = {expr.literal(self.worksheet)}{' AND seeded = 1' if self.seeded else ''} THEN 1 END)"


def _quoted(values) -> str:
    return ", ".join(map(expr.literal, values))


def _wanted(columns: list[Line | Category | Present]) -> str:
    """Rows any of the columns can read; a plain predicate on the fact, so it reaches the scan."""
    whole_sheets = sorted({c.worksheet for c in columns if isinstance(c, Category | Present)})
    loose = [c.sub_code for c in columns if isinstance(c, Line) and c.worksheet is None]
    by_sheet: dict[str, list[str]] = {}
    for c in columns:
        if isinstance(c, Line) and c.worksheet is not None and c.worksheet not in whole_sheets:
            by_sheet.setdefault(c.worksheet, []).append(c.sub_code)
    parts = [
        f"(worksheet_name = {expr.literal(sheet)} AND sub_code IN ({_quoted(codes)}))" for sheet, codes in by_sheet.items()
    ]
    if whole_sheets:
        parts.append(f"worksheet_name IN ({_quoted(whole_sheets)})")
    if loose:
        parts.append(f"sub_code IN ({_quoted(loose)})")
    return " OR ".join(parts)


def pivot_lines(
    fact: DataFrame,
    columns: list[Line | Category | Present],
    dim_subcode: DataFrame | None = None,
    rows: str | None = None,
    unseeded: bool = True,
) -> DataFrame:
    """One row per organisation-year with the given columns, from one pass over ``fact``.

    ``rows`` overrides which fact rows make an organisation-year appear; by default those any column reads.
    ``dim_subcode`` is needed for ``Category`` columns; lines it does not know have no category and, without
    ``unseeded``, do not count at all. Columns are BIGINT, or DECIMAL if the fact keeps fractions.
    """
    lines = fact.filter(rows or _wanted(columns))
    seeds = ()
    if dim_subcode is not None:
        known = dim_subcode.selectExpr("sub_code", "analytics_category", "1 AS seeded")
        lines = lines.join(known, "sub_code", "left" if unseeded else "inner")
        seeds = ("analytics_category", "seeded")
    lines = lines.selectExpr(*KEYS, "worksheet_name", "sub_code", *seeds, f"{expr.amount(fact)} AS total")
    return expr.aggregate(lines, KEYS, {c.name: c.sql() for c in columns})
