"""Repeatable upserts, written as union and aggregate.

Each merge is one shuffle on the target's key with partial results combined before it, so a key or an
organisation with very many incoming rows does not land in one task as rows. Winners are decided by
a total order, never by arrival.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.functions.expr import named, scale_of

FACT_KEY = ["org_code", "financial_year", "main_code", "sub_code"]
FACT_COLUMNS = [
    "org_code", "financial_year", "worksheet_name", "table_id", "main_code", "sub_code", "total_000s",
    "trust_type", "source_file",
]


def build_dim_trust(providers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Organisation dimension: first name and type, latest known sector and region, years seen."""
    attributes = ["org_code", "organisation_name", "trust_type", "sector", "region"]
    rows = providers.selectExpr(
        *attributes,
        "financial_year AS first_year_seen",
        "financial_year AS last_year_seen",
        "struct(1 AS batch, financial_year, source_file, organisation_name) AS seen",
    )
    if existing is not None:
        known = existing.selectExpr(
            *attributes,
            "first_year_seen",
            "last_year_seen",
            "struct(0 AS batch, last_year_seen AS financial_year, '' AS source_file, organisation_name) AS seen",
        )
        rows = rows.unionByName(known)
    columns = {
        "origin": "min_by(struct(organisation_name, trust_type), seen)",
        "sector": "max_by(sector, CASE WHEN sector IS NOT NULL THEN seen END)",
        "region": "max_by(region, CASE WHEN region IS NOT NULL THEN seen END)",
        "first_year_seen": "min(first_year_seen)",
        "last_year_seen": "max(last_year_seen)",
    }
    return (
        rows.groupBy("org_code")
        .agg(*named(columns))
        .selectExpr(
            "org_code",
            "origin.organisation_name",
            "origin.trust_type",
            "sector",
            "region",
            "CASE WHEN origin.trust_type = 'FOUNDATION_TRUST' THEN 1 ELSE 0 END AS is_foundation",
            "first_year_seen",
            "last_year_seen",
        )
    )


def build_trust_history(providers: DataFrame) -> DataFrame:
    """What the yearly lists said of each organisation over time: one row per stretch of years in which name, type, sector and region stay.

    A list that leaves the sector or region open does not change it. ``valid_from`` is the first year of a stretch, ``valid_before``
    the first year of the next (NULL for the current one); a year without a list belongs to the stretch before it. The windows hold
    the years of one organisation, after its lists have been reduced to a row a year.
    """
    told = "struct(source_file, organisation_name)"
    columns = {
        "seen": f"min_by(struct(organisation_name, trust_type), {told})",
        "sector": f"max_by(sector, CASE WHEN sector IS NOT NULL THEN {told} END)",
        "region": f"max_by(region, CASE WHEN region IS NOT NULL THEN {told} END)",
    }
    years = providers.groupBy("org_code", "financial_year").agg(*named(columns))
    so_far, in_order = "PARTITION BY org_code ORDER BY financial_year", "financial_year"
    filled = years.selectExpr(
        "org_code", in_order, "seen.organisation_name", "seen.trust_type",
        f"last_value(sector) IGNORE NULLS OVER ({so_far}) AS sector", f"last_value(region) IGNORE NULLS OVER ({so_far}) AS region",
    )
    attributes = "struct(organisation_name, trust_type, sector, region)"
    marked = filled.selectExpr("*", f"CASE WHEN {attributes} <=> lag({attributes}) OVER ({so_far}) THEN 0 ELSE 1 END AS is_new")
    stretches = marked.selectExpr("*", f"sum(is_new) OVER ({so_far}) AS entry")
    joined = stretches.groupBy("org_code", "entry", "organisation_name", "trust_type", "sector", "region")
    return joined.agg(
        F.min("financial_year").alias("valid_from"), F.max("financial_year").alias("last_listed"), F.count(F.lit(1)).alias("lists")
    ).selectExpr(
        "org_code", "organisation_name", "trust_type", "sector", "region", "entry", "valid_from",
        "lead(valid_from) OVER (PARTITION BY org_code ORDER BY entry) AS valid_before", "last_listed", "lists",
    )


def extend_worksheets(dim_worksheet: DataFrame, lines: DataFrame) -> DataFrame:
    """Adds worksheets seen in the lines but not in the dimension, under category OTHER."""
    seen = lines.select("worksheet_name").filter("worksheet_name IS NOT NULL").distinct()
    new = seen.join(dim_worksheet, "worksheet_name", "left_anti").selectExpr(
        "worksheet_name",
        "worksheet_name AS schedule_title",
        "'OTHER' AS category",
        "CAST(NULL AS STRING) AS sub_code_prefix",
    )
    return dim_worksheet.unionByName(new)


def _place(scale: int) -> str:
    """A row number and a total in one number that orders as the pair does; rows without a number come first."""
    units = f"CAST(total * {10**scale} AS DECIMAL(19,0))" if scale else "total"
    return f"CAST(coalesce(row_num, -9223372036854775807) AS DECIMAL(19,0)) * {10 ** (15 + scale)} + ({units} + {10 ** (14 + scale)})"


def _total_of(place: str, scale: int) -> str:
    """The total in a number that ``_place`` made."""
    units = f"pmod({place}, CAST({10 ** (15 + scale)} AS DECIMAL(38,0))) - {10 ** (14 + scale)}"
    return f"CAST({f'CAST({units} AS DECIMAL(18,0)) / {10**scale}' if scale else units} AS DECIMAL({14 + scale},{scale}))"


def promote_lines(lines: DataFrame, providers: DataFrame, batch: str = "0") -> DataFrame:
    """Clean lines to fact rows, one per fact key; the last line of a key wins.

    Raw lines are first reduced by key, file and worksheet with numbers alone, which Spark adds up in hash tables before the
    shuffle; names and codes are compared only among what is left. Names match without regard to case, and the rows meet the
    provider list after the reduction, so the join sees no hot names. ``batch`` (SQL text over the lines) numbers loads that
    follow one another: with it one scan promotes them all, and the result is what merging them in turn would leave. Totals keep
    the fractional digits of the lines.
    """
    scale = scale_of(lines, "total")
    match = ["financial_year", "trust_type", "name_key"]
    reduced = (
        lines.selectExpr(
            f"{batch} AS batch", "financial_year", "trust_type", "lower(organisation_name) AS name_key", "main_code", "sub_code",
            "source_file", "worksheet_name", "table_id", f"CAST({_place(scale)} AS DECIMAL(38,0)) AS place",
        )
        .groupBy("batch", *match, "main_code", "sub_code", "source_file", "worksheet_name", "table_id")
        .agg(F.max("place").alias("last"), F.min("place").alias("first"))
    )
    codes = providers.selectExpr(
        "financial_year", "trust_type", "lower(organisation_name) AS name_key", "org_code"
    ).distinct()
    columns = {
        "last": "max(struct(batch, source_file, last))",
        "first": "min(struct(batch, source_file, first, worksheet_name, table_id, trust_type))",
    }
    coded = reduced.join(codes, match).groupBy(*FACT_KEY).agg(*named(columns))
    return coded.selectExpr(
        "org_code",
        "financial_year",
        "first.worksheet_name",
        "first.table_id",
        "main_code",
        "sub_code",
        f"{_total_of('last.last', scale)} AS total_000s",
        "first.trust_type",
        "last.source_file",
    )


def merge_facts(existing: DataFrame, *batches: DataFrame) -> DataFrame:
    """Upsert of batches in order: a known key gets the new total and file and keeps the rest.

    Merging a batch twice changes nothing. Where all sides have ``load_ts``, a key keeps the time it was first loaded.
    """
    stamp = ["load_ts"] if all("load_ts" in side.columns for side in (existing, *batches)) else []
    rows = existing.selectExpr(*FACT_COLUMNS, *stamp, "0 AS batch")
    for number, batch in enumerate(batches, start=1):
        rows = rows.unionByName(batch.selectExpr(*FACT_COLUMNS, *stamp, f"{number} AS batch"))
    columns = {
        "kept": f"min_by(struct({', '.join(['worksheet_name', 'table_id', 'trust_type', *stamp])}), batch)",
        "new": "max_by(struct(total_000s, source_file), batch)",
    }
    return (
        rows.groupBy(*FACT_KEY)
        .agg(*named(columns))
        .selectExpr(
            "org_code",
            "financial_year",
            "kept.worksheet_name",
            "kept.table_id",
            "main_code",
            "sub_code",
            "new.total_000s",
            "kept.trust_type",
            "new.source_file",
            *[f"kept.{c}" for c in stamp],
        )
    )
