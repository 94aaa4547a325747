"""Published extracts to clean staging rows.

Every step is a column expression over all files at once: the financial year and the trust type come
from each row's ``source_file``, so one job cleans any number of files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.refdata import FILE_YEAR_PATTERN, LINE_HEADERS, PROVIDER_HEADERS


# A total as a number, NULL if it cannot be read; and the first number that no longer fits the fact table.
READ_TOTAL = "try_cast(replace(total, ',', '') AS DOUBLE)"
TOTAL_BELOW = "1e14D"
# Fractional digits of a total: most that a load can keep, and most that are read of a text before the rest is cut.
MOST_SCALE, READ_SCALE = 4, 12
# The column of a reader that holds rows it could not cut into columns.
CORRUPT = "_corrupt_record"


def derive_financial_year(file_name: str) -> str:
    """``..._2023-24.csv`` -> ``2023/24``; a name without a year stops the job."""
    year = f"replace(regexp_extract({file_name}, r'{FILE_YEAR_PATTERN}', 0), '-', '/')"
    return f"coalesce(nullif({year}, ''), raise_error(concat('no year in the file name ', {file_name})))"


def derive_trust_type(file_name: str) -> str:
    return f"CASE WHEN contains(lower({file_name}), 'foundation') THEN 'FOUNDATION_TRUST' ELSE 'NHS_TRUST' END"


def resolve_headers(
    raw: DataFrame, headers: dict[str, list[str]], optional: tuple[str, ...] = (), kept: tuple[str, ...] = ()
) -> DataFrame:
    """Text columns under their own names, whichever of the known headers the files used; ``kept`` are further columns (SQL text)."""
    present = {name: [h for h in known if h in raw.columns] for name, known in headers.items()}
    missing = [headers[name][0] for name, found in present.items() if not found and name not in optional]
    if missing:
        raise ValueError(f"none of the known headers stands for {missing} among {raw.columns}")
    resolved = [
        f"coalesce({', '.join(f'CAST(`{h}` AS STRING)' for h in found)}) AS {name}"
        for name, found in present.items()
        if found
    ]
    return raw.selectExpr(*resolved, "source_file", *kept)


def _given(*names: str) -> str:
    """True if every text is there: not NULL, not blank, and not the text form of a missing value."""
    return " AND ".join(f"lower(trim({name})) NOT IN ('', 'nan')" for name in names)


def _total(scale: int) -> str:
    """A total with ``scale`` fractional digits, further ones cut; text that is no number is 0."""
    if scale == 0:
        return f"coalesce(try_cast({READ_TOTAL} AS BIGINT), 0)"
    exact, near = (f"try_cast({text} AS DECIMAL({18 + READ_SCALE},{READ_SCALE}))" for text in ("replace(total, ',', '')", READ_TOTAL))
    units = f"CAST(coalesce({exact}, {near}, 0) * {10**scale} AS BIGINT)"
    return f"CAST(CAST({units} AS DECIMAL(18,0)) / {10**scale} AS DECIMAL({14 + scale},{scale}))"


def clean_lines(raw: DataFrame, scale: int = 0) -> DataFrame:
    """Current-year account lines. Totals may hold separators; unreadable ones are 0, fractions are cut.

    ``scale`` is how many fractional digits a total keeps (4 at most): with 0, the default, totals are whole numbers (BIGINT), else
    DECIMAL, and the fact and the views keep the same digits. Head counts and days lost are published with fractions.

    Lines whose total has more than fourteen digits are set aside (``rejected_lines`` has them), so one of them does not
    stop a load; rows that a reader could not cut into columns are too. Year and type come from the file's name, or from
    columns of their own if the reader has told them already.
    """
    if not 0 <= scale <= MOST_SCALE:
        raise ValueError(f"totals keep 0 to {MOST_SCALE} fractional digits, not {scale}")
    told = tuple(c for c in ("trust_type", "financial_year") if c in raw.columns)
    trust_type = "trust_type" if "trust_type" in told else f"{derive_trust_type('source_file')} AS trust_type"
    financial_year = "financial_year" if "financial_year" in told else f"{derive_financial_year('source_file')} AS financial_year"
    return (
        resolve_headers(raw.filter(f"{CORRUPT} IS NULL") if CORRUPT in raw.columns else raw, LINE_HEADERS, kept=told)
        .filter("main_code IS NULL OR NOT contains(main_code, 'PY')")
        .filter(_given("organisation_name", "sub_code", "total"))
        .filter(f"coalesce(abs({READ_TOTAL}), 0D) < {TOTAL_BELOW}")
        .selectExpr(
            "trim(organisation_name) AS organisation_name",
            "trim(worksheet_name) AS worksheet_name",
            "try_cast(table_id AS SMALLINT) AS table_id",
            "trim(main_code) AS main_code",
            "try_cast(row_num AS BIGINT) AS row_num",
            "trim(sub_code) AS sub_code",
            f"{_total(scale)} AS total",
            "source_file",
            "'CY' AS year_type",
            trust_type,
            financial_year,
        )
    )


# Reasons for which a line is not kept, and the condition over text columns under their own names.
REFUSALS = {
    "malformed row": f"{CORRUPT} IS NOT NULL",
    "prior year": "contains(main_code, 'PY')",
    "no organisation": f"NOT coalesce({_given('organisation_name')}, false)",
    "no sub-code": f"NOT coalesce({_given('sub_code')}, false)",
    "no total": f"NOT coalesce({_given('total')}, false)",
    "total does not fit": f"abs({READ_TOTAL}) >= {TOTAL_BELOW}",
}


def flagged_lines(raw: DataFrame) -> DataFrame:
    """Every published line as it was read, with ``reasons``: why ``clean_lines`` drops it, empty for the lines that it keeps."""
    corrupt = CORRUPT if CORRUPT in raw.columns else f"CAST(NULL AS STRING) AS {CORRUPT}"
    listed = ", ".join(f"CASE WHEN {condition} THEN '{reason}' END" for reason, condition in REFUSALS.items())
    return resolve_headers(raw, LINE_HEADERS, kept=(corrupt,)).selectExpr("*", f"array_compact(array({listed})) AS reasons")


def rejected_lines(raw: DataFrame) -> DataFrame:
    """The lines that ``clean_lines`` drops, as published but for the blanks around names and codes, with the reasons in one text."""
    return (
        flagged_lines(raw)
        .filter("size(reasons) > 0")
        .selectExpr(
            "source_file", "trim(organisation_name) AS organisation_name", "trim(main_code) AS main_code", "trim(row_num) AS row_num",
            "trim(sub_code) AS sub_code", "total", f"{CORRUPT} AS malformed_row", "array_join(reasons, ', ') AS reasons",
        )
    )


def line_counts(raw: DataFrame) -> DataFrame:
    """Per file the lines read, kept and refused, and refused for each reason; a line may have several."""
    reasons = [f"count_if(array_contains(reasons, '{r}')) AS {r.replace(' ', '_').replace('-', '_')}" for r in REFUSALS]
    counts = ["count(*) AS read", "count_if(size(reasons) = 0) AS kept", "count_if(size(reasons) > 0) AS refused", *reasons]
    return flagged_lines(raw).groupBy("source_file").agg(*map(F.expr, counts))


def inspected_lines(raw: DataFrame) -> DataFrame:
    """Current-year lines before anything is dropped: what is missing is NULL, and what cleaning would do to the total is flagged."""
    present = lambda name: f"CASE WHEN {_given(name)} THEN trim({name}) END AS {name}"
    year = f"nullif(regexp_extract(source_file, r'{FILE_YEAR_PATTERN}', 0), '')"
    return (
        resolve_headers(raw, LINE_HEADERS)
        .filter("main_code IS NULL OR NOT contains(main_code, 'PY')")
        .selectExpr(
            present("organisation_name"),
            "trim(main_code) AS main_code",
            present("sub_code"),
            f"NOT coalesce({_given('total')}, false) AS no_total",
            f"{_given('total')} AND {READ_TOTAL} IS NULL AS unreadable",
            f"coalesce(abs({READ_TOTAL}), 0D) >= {TOTAL_BELOW} AS too_large",
            "source_file",
            f"{derive_trust_type('source_file')} AS trust_type",
            f"replace({year}, '-', '/') AS financial_year",
        )
    )


def clean_providers(raw: DataFrame, code_length: int = 3, or_longer: bool = False) -> DataFrame:
    """Provider list rows with a code of the given length, or also with longer ones."""
    rows = resolve_headers(raw, PROVIDER_HEADERS, optional=("region", "sector", "comments"))
    return (
        rows.filter(_given("organisation_name", "org_code"))
        .filter(f"length(trim(org_code)) {'>=' if or_longer else '='} {code_length}")
        .selectExpr(
            "trim(organisation_name) AS organisation_name",
            "trim(org_code) AS org_code",
            *[c for c in rows.columns if c not in ("organisation_name", "org_code")],
            f"{derive_trust_type('source_file')} AS trust_type",
            f"{derive_financial_year('source_file')} AS financial_year",
        )
    )
