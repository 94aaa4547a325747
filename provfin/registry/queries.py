"""Named queries over the order tables: each entry takes (spark, sf_dir) and returns a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provfin import refdata
from provfin.functions import expr
from provfin.functions.session import materialise, working_folder
from provfin.operators import ingest, merge
from provfin.plans import audit, benchmark, dashboard, enrich, extracts, measures, monthly, named, periods, refresh, subtotals, totals, trend, views
from provfin.sources import fixture as fx
from provfin.sources import files, readers, sinks
from provfin.streaming import intake

Query = Callable[[SparkSession, str], DataFrame]
YEAR, PRIOR, BASE = fx.YEAR, fx.PRIOR, fx.BASE

# Ranges the audit expects of the derived accounts: some hold and some do not.
EXPECTED = {
    "years": ["1998/99", "1999/00", "2000/01", "2023/24"],
    "year": YEAR,
    "fact_row_min": 20_000,
    "trust_count_min": 200,
    "income_bn": (90, 100),
    "deficit_trusts": (100, 140),
    "avg_ebitda_pct": (10, 20),
    "avg_pay_pct": (60, 75),
    "pay_sector": "Acute",
}


def _fact(s, d, years=None, prior=False):
    return fx.facts(s, d, include_prior=prior, years=years)


def _dims(s, d):
    return fx.dim_trust(s, d), refdata.dim_subcode(s)


def _v1(s, d, years=None):
    return views.income_expenditure(_fact(s, d, years), fx.dim_trust(s, d))


def _v2(s, d, years=None):
    return views.expenditure_breakdown(_fact(s, d, years), *_dims(s, d))


def _v3(s, d, years=None):
    return views.workforce(_fact(s, d, years), fx.dim_trust(s, d))


def _v4(s, d, years=None):
    return views.kpis(_fact(s, d, years), *_dims(s, d))


def _card(s, d, years=None):
    return views.scorecard(_fact(s, d, years), *_dims(s, d))


def _lines(s, d, years="true"):
    return ingest.clean_lines(fx.raw_lines(s, d, years))


def _providers(s, d):
    return ingest.clean_providers(fx.raw_providers(s, d), code_length=fx.CODE_WIDTH, or_longer=True)


def _promoted(s, d):
    """Two batches of published lines, one after the other."""
    # Row numbers end in the line number: the first batch holds a shipment's first three lines.
    return merge.promote_lines(_lines(s, d), _providers(s, d), batch="CASE WHEN row_num % 8 <= 3 THEN 0 ELSE 1 END")


def _card_from_files(s, d):
    """Account files and provider lists to the scorecard: clean, promote, build the organisations, derive."""
    providers = _providers(s, d)
    fact = merge.promote_lines(ingest.clean_lines(fx.raw_accounts(s, d)), providers)
    return views.scorecard(fact, merge.build_dim_trust(providers), refdata.dim_subcode(s))


def _fractional(view):
    """A view over account files whose head counts and days lost have fractions, kept to two digits: (spark, sf_dir) to frame."""

    def query(s, d):
        providers = _providers(s, d)
        fact = merge.promote_lines(ingest.clean_lines(fx.raw_accounts(s, d, fractions=True), scale=2), providers)
        return extracts.with_plain_numbers(view(fact, merge.build_dim_trust(providers), refdata.dim_subcode(s)))

    return query


def _from_stream(s, d):
    """Published files promoted as a stream: those of the earlier years, then the rest, which a second run finds."""
    folder = working_folder(s)
    providers = materialise(_providers(s, d))
    latest = f"coalesce(start_year >= {YEAR[:4]}, false)"
    for chosen in (f"NOT {latest}", latest):
        fx.publish(fx.raw_lines(s, d, chosen), f"{folder}/raw")
        intake.promote_new(s, f"{folder}/raw", providers, f"{folder}/fact", f"{folder}/seen")
    return s.read.parquet(f"{folder}/fact").select(*merge.FACT_COLUMNS)


def _refreshed(s, d):
    """A stored scorecard of a first load, refreshed after an upsert of the last two years: corrected totals, late organisations."""
    folder = working_folder(s)
    fact, card, number = f"{folder}/fact", f"{folder}/card", "CAST(org_code AS BIGINT)"
    early = f"CAST(total_000s + CASE WHEN financial_year >= '{PRIOR}' AND {number} % 5 = 0 THEN 7 ELSE 0 END AS DECIMAL(14,0))"
    whole = _fact(s, d)
    sinks.promote_into(fact, whole.filter(f"financial_year < '{PRIOR}' OR {number} % 7 <> 3").withColumn("total_000s", F.expr(early)))
    before = fx.dim_trust(s, d).withColumn("region", F.expr(f"CASE WHEN {number} % 40 = 1 THEN 'UNKNOWN' ELSE region END"))
    trusts, codes = _dims(s, d)
    refresh.refresh_into(card, s.read.parquet(fact), [], before, codes)
    late = materialise(whole.filter(f"financial_year >= '{PRIOR}'"))
    changed = materialise(refresh.touched(late, s.read.parquet(fact).filter(f"financial_year >= '{PRIOR}'")))
    sinks.promote_into(fact, late, refresh.years_of(late))
    facts = s.read.parquet(fact)
    refresh.refresh_into(card, facts, [changed, refresh.touched_by_trusts(facts, before, trusts)], trusts, codes)
    return extracts.with_plain_numbers(s.read.parquet(card).select(*views.SCORECARD_COLUMNS))


def _files(s, d):
    return fx.raw_lines(s, d).groupBy("source_file").agg(F.count(F.lit(1)).alias("line_count"))


def _derive_year(s, d):
    return _files(s, d).selectExpr("*", f"{ingest.derive_financial_year('source_file')} AS financial_year")


def _derive_type(s, d):
    return _files(s, d).selectExpr("*", f"{ingest.derive_trust_type('source_file')} AS trust_type")


def _dim_trust_build(s, d):
    """A first load of the earlier years, then an update with the later ones."""
    providers = _providers(s, d)
    latest, earlier = f"financial_year >= '{YEAR}'", f"financial_year < '{YEAR}'"
    return merge.build_dim_trust(providers.filter(latest), merge.build_dim_trust(providers.filter(earlier)))


def _normalised(s, d):
    spelling = "floor(CAST(org_code AS BIGINT) / 5) % 4"
    messy = fx.dim_trust(s, d).selectExpr(
        "org_code",
        f"""CASE {spelling} WHEN 0 THEN sector WHEN 1 THEN upper(replace(sector, ' ', '_'))
            WHEN 2 THEN concat(sector, ' Trust') ELSE 'Other' END AS sector""",
    )
    return enrich.normalise_sectors(messy.selectExpr("*", "sector AS given_sector"))


def _flags(s, d):
    return enrich.trust_flags(_card(s, d)).select(
        "org_code", "financial_year", "is_large", "pay_pressure_flag", "ebitda_rag"
    )


def _mix(s, d):
    rows = enrich.income_mix(_card(s, d)).select(
        "org_code", "financial_year", "total_income_000s", "patient_income_pct", "other_income_pct"
    )
    return extracts.with_plain_numbers(rows)


def _yoy(s, d):
    rows = enrich.yoy_ebitda(_card(s, d)).select(
        "org_code", "financial_year", "ebitda_margin_pct", "ebitda_margin_pct_prior_yr", "ebitda_margin_yoy_pp"
    )
    return extracts.with_plain_numbers(rows)


def _extract(name: str) -> Query:
    return lambda s, d: extracts.card_extract(enrich.enrich(_card(s, d)), name)


def _fiscal(s, d):
    orders = fx.table(s, d, "orders").select(F.col("o_orderdate").cast("date").alias("order_date"))
    days = orders.groupBy("order_date").agg(F.count(F.lit(1)).alias("order_count"))
    return periods.fiscal_period(days, "order_date").withColumn("order_date", F.col("order_date").cast("string"))


def _dates_as_text(rows):
    return expr.select(rows, *[f"CAST({c} AS STRING) AS {c}" if c.endswith("_date") else c for c in rows.columns])


def _dim_year(s, d):
    return periods.years_of(fx.table(s, d, "orders").selectExpr("CAST(o_orderdate AS DATE) AS day"), "day")


def _years(s, d):
    return _dates_as_text(extracts.dim_financial_year_extract(_dim_year(s, d)))


def _linked(s, d):
    costs = extracts.card_extract(_card(s, d), "expenditure_breakdown")
    return _dates_as_text(extracts.with_dimensions(costs, fx.dim_trust(s, d), _dim_year(s, d)))


def _linked_in_buckets(name: str) -> Query:
    """A dataset and the organisations laid out in buckets, then linked."""

    def run(s, d):
        folder = working_folder(s)
        frame = extracts.linkable(name, _fact(s, d, prior=name.endswith("_detail")), *_dims(s, d))
        model = extracts.write_model(folder, f"model_{folder.rsplit('/', 1)[1]}", {name: frame}, fx.dim_trust(s, d))
        return _dates_as_text(extracts.with_dimensions(model[name], model["dim_trust"], _dim_year(s, d)))

    return run


def _from_source(s, d):
    """Published files through the data source of account files."""
    folder = working_folder(s)
    fx.publish(fx.raw_lines(s, d), folder)
    files.register(s)
    return ingest.clean_lines(s.read.format(files.NAME).load(folder))


def _discovered(s, d):
    """The names of the published files that a load would read."""
    folder = working_folder(s)
    lines = fx.raw_lines(s, d)
    fx.publish(lines, folder)
    draft = lines.filter("RowNumber % 50 = 0").withColumn("source_file", F.lit("TAC_NHS_trusts_Illustrative_1998-99"))
    fx.publish(draft, folder)
    paths = readers.discover(s, folder)
    return s.createDataFrame([(p.rsplit("/", 1)[1],) for p in paths], "file_name string")


def _replaced(s, d):
    """Staging: a first load with other totals, then the last year's files replaced, twice."""
    folder = working_folder(s)
    lines = _lines(s, d)
    sinks.replace_partitions(lines.withColumn("total", F.expr("total + 1")), folder)
    for _ in range(2):
        sinks.replace_partitions(_lines(s, d, f"start_year = {YEAR[:4]}").filter(F.col("financial_year") == YEAR), folder)
    return s.read.schema(lines.schema).parquet(folder).select(lines.columns)


def _csv_round_trip(s, d):
    """A dataset written as CSV files and read back."""
    folder = working_folder(s)
    frame = extracts.income_summary_extract(_v1(s, d))
    sinks.write_extract(frame, folder, extracts.DEFAULT_ORDER)
    return s.read.schema(frame.schema).option("header", True).csv(folder)


def _report_round_trip(s, d):
    """The audit, run and written with its time, read back without it."""
    folder = working_folder(s)
    sinks.write_report(audit.run_report(_fact(s, d), *_dims(s, d), EXPECTED), folder)
    written = s.read.schema(f"{audit.REPORT_SCHEMA}, run_ts timestamp").option("header", True).csv(folder)
    return written.filter("run_ts IS NOT NULL").drop("run_ts")


def _trusts_stamped(s, d):
    """The organisation dimension after three loads: the earlier years, the later ones, and the later ones again."""
    folder = working_folder(s)
    providers = _providers(s, d)
    for day, years in enumerate(("<", ">=", ">="), 1):
        sinks.upsert_trusts(f"{folder}/trusts", providers.filter(f"financial_year {years} '{YEAR}'"), f"TIMESTAMP '2002-01-0{day} 00:00:00'")
    return s.read.parquet(f"{folder}/trusts").withColumn("updated_ts", F.expr("date_format(updated_ts, 'yyyy-MM-dd')"))


def _unknown_card(s, d, years=None):
    """The scorecard with organisations whose sector or region is not known."""
    return views.scorecard(_fact(s, d, years), fx.dim_trust(s, d, unknown=True), refdata.dim_subcode(s))


def _named(function: str, **values) -> Query:
    """A report by its name in SQL, with bound values."""

    def run(s, d):
        named.register(s, {"scorecard": _card(s, d)})
        return named.call(s, function, **values)

    return run


def _cube(s, d):
    return totals.cube(totals.cells(_card(s, d), totals.numbered(fx.dim_trust(s, d))))


def _history(s, d):
    raw = fx.raw_providers(s, d, moving=True)
    return merge.build_trust_history(ingest.clean_providers(raw, code_length=fx.CODE_WIDTH, or_longer=True))


def _as_of(s, d):
    return extracts.with_plain_numbers(views.scorecard_as_of(_fact(s, d), _history(s, d), refdata.dim_subcode(s)))


def _worksheets(s, d):
    return merge.extend_worksheets(refdata.dim_worksheet(s), _lines(s, d))


BY_YEAR = ["financial_year"]
BY_YEAR_SECTOR = ["financial_year", "sector"]
SLICE = {"financial_year": [YEAR], "trust_type": ["FOUNDATION_TRUST"]}


def queries() -> dict[str, Query]:
    year, recent, span = [YEAR], [PRIOR, YEAR], [BASE, YEAR]
    return {
        # ingest
        "derive_financial_year": _derive_year,
        "derive_trust_type": _derive_type,
        "stg_provider_clean": lambda s, d: _providers(s, d),
        "stg_tac_clean": lambda s, d: _lines(s, d),
        "stg_from_source": _from_source,
        "discover_files": _discovered,
        "stg_replace": _replaced,
        "dim_trust_upsert": _trusts_stamped,
        "csv_round_trip": _csv_round_trip,
        "report_round_trip": _report_round_trip,
        "dim_trust_build": _dim_trust_build,
        "dim_worksheet_extend": _worksheets,
        "fact_promote": _promoted,
        "fact_from_stream": _from_stream,
        "stg_rejects": lambda s, d: ingest.rejected_lines(fx.raw_lines(s, d)).drop("malformed_row"),
        "stg_line_counts": lambda s, d: ingest.line_counts(fx.raw_lines(s, d)).drop("malformed_row"),
        "preload_audit": lambda s, d: audit.preload_audit(fx.raw_lines(s, d), _providers(s, d)),
        "final_counts": lambda s, d: audit.final_counts(_promoted(s, d), _dim_trust_build(s, d)),
        "fiscal_period": _fiscal,
        # views
        "income_expenditure": lambda s, d: _v1(s, d),
        "expenditure_breakdown": lambda s, d: _v2(s, d),
        "workforce": lambda s, d: _v3(s, d),
        "kpis": lambda s, d: extracts.with_plain_numbers(_v4(s, d)),
        "scorecard": lambda s, d: extracts.with_plain_numbers(_card(s, d)),
        "scorecard_refresh": _refreshed,
        "dim_trust_history": _history,
        "scorecard_as_of": _as_of,
        "scorecard_from_files": lambda s, d: extracts.with_plain_numbers(_card_from_files(s, d)),
        "workforce_fractional": _fractional(lambda fact, trusts, _: views.workforce(fact, trusts)),
        "kpis_fractional": _fractional(views.kpis),
        "national_trend_from_files": lambda s, d: trend.national_trend(_card_from_files(s, d)),
        # enrichment
        "normalise_sectors": _normalised,
        "trust_flags": _flags,
        "income_mix": _mix,
        "yoy_ebitda": _yoy,
        "sector_benchmarks_median": lambda s, d: enrich.sector_benchmarks(_card(s, d)),
        # extracts
        "income_detail_full": lambda s, d: extracts.income_detail_full(_fact(s, d), *_dims(s, d)),
        "expenditure_detail_full": lambda s, d: extracts.expenditure_detail_full(_fact(s, d), *_dims(s, d)),
        "extract_kpis": _extract("kpis"),
        "extract_ie_summary": _extract("ie_summary"),
        "extract_expenditure_breakdown": _extract("expenditure_breakdown"),
        "extract_workforce": _extract("workforce"),
        "dim_financial_year_extract": _years,
        "extract_with_dimensions": _linked,
        **{f"extract_{name}_linked": _linked_in_buckets(name) for name in extracts.LINKED},
        "dim_trust_extract": lambda s, d: extracts.dim_trust_extract(fx.dim_trust(s, d, seen=True)),
        "ie_summary_extract": lambda s, d: extracts.income_summary_extract(_v1(s, d)),
        "expenditure_extract": lambda s, d: extracts.expenditure_extract(_v2(s, d)),
        "workforce_extract": lambda s, d: extracts.workforce_extract(_v3(s, d)),
        "kpi_extract": lambda s, d: extracts.kpi_extract(_v4(s, d)),
        "income_detail": lambda s, d: extracts.income_detail(_fact(s, d, prior=True), *_dims(s, d)),
        "expenditure_detail": lambda s, d: extracts.expenditure_detail(_fact(s, d, prior=True), *_dims(s, d)),
        "sector_benchmarks": lambda s, d: extracts.sector_benchmarks(_v4(s, d)),
        # sector trend
        "national_trend": lambda s, d: trend.national_trend(_card(s, d)),
        "sector_kpis": lambda s, d: trend.sector_kpis(_card(s, d, year), YEAR),
        "regional_growth": lambda s, d: trend.regional_growth(_card(s, d, span), BASE, PRIOR, YEAR),
        "ebitda_distribution": lambda s, d: trend.ebitda_distribution(_card(s, d, year), YEAR),
        "top_income": lambda s, d: trend.top_income(_card(s, d, year), YEAR),
        "worst_net_margin": lambda s, d: trend.worst_net_margin(_card(s, d, year), YEAR),
        "pay_trend": lambda s, d: trend.pay_trend(_card(s, d)),
        "drugs_cost": lambda s, d: trend.drugs_cost(_card(s, d)),
        "negligence_national": lambda s, d: trend.negligence_national(_card(s, d)),
        "finance_position": lambda s, d: trend.finance_position(_card(s, d)),
        # organisations without sector or region
        "trust_flags_unknown": lambda s, d: enrich.trust_flags(_unknown_card(s, d)).select(
            "org_code", "financial_year", "is_large", "pay_pressure_flag", "ebitda_rag"
        ),
        "sector_benchmarks_median_unknown": lambda s, d: enrich.sector_benchmarks(_unknown_card(s, d)),
        "sector_benchmarks_unknown": lambda s, d: extracts.sector_benchmarks(
            views.kpis(_fact(s, d), fx.dim_trust(s, d, unknown=True), refdata.dim_subcode(s))
        ),
        "pay_trend_unknown": lambda s, d: trend.pay_trend(_unknown_card(s, d)),
        "pay_pressure_unknown": lambda s, d: benchmark.pay_pressure(_unknown_card(s, d, year), YEAR),
        "regional_health_unknown": lambda s, d: benchmark.regional_health(_unknown_card(s, d, year), YEAR),
        "m_kpi_unknown": lambda s, d: measures.kpi(_unknown_card(s, d), BY_YEAR_SECTOR),
        # reports by their names in SQL
        "sql_top_income": _named("top_income", year=YEAR),
        "sql_worst_net_margin": _named("worst_net_margin", year=YEAR),
        "sql_sector_kpis": _named("sector_kpis", year=YEAR),
        "sql_regional_health": _named("regional_health", year=YEAR),
        "sql_sector_members": _named("sector_members", chosen="Mental Health", year=PRIOR),
        "sql_ebitda_change": _named("ebitda_change", year=YEAR, prior=PRIOR),
        # benchmarks
        "size_bands": lambda s, d: benchmark.size_bands(_card(s, d, year), YEAR),
        "trust_type_compare": lambda s, d: benchmark.trust_type_compare(_card(s, d)),
        "pay_pressure": lambda s, d: benchmark.pay_pressure(_card(s, d, year), YEAR),
        "regional_health": lambda s, d: benchmark.regional_health(_card(s, d, year), YEAR),
        "cost_per_wte": lambda s, d: benchmark.cost_per_wte(_card(s, d)),
        "private_income": lambda s, d: benchmark.private_income(_card(s, d, year), YEAR),
        "negligence_sector": lambda s, d: benchmark.negligence_sector(_card(s, d)),
        "ebitda_movers": lambda s, d: benchmark.ebitda_movers(_card(s, d, recent), YEAR, PRIOR),
        "sickness_cost": lambda s, d: benchmark.sickness_cost(_card(s, d)),
        "rd_education_income": lambda s, d: benchmark.rd_education_income(_card(s, d, year), YEAR),
        # validation
        "val_q1": lambda s, d: audit.rows_by_year_type(_fact(s, d)),
        "val_q2": lambda s, d: audit.patient_income_by_year(_fact(s, d)),
        "val_q3": lambda s, d: audit.income_expenditure_by_year(_v1(s, d)),
        "val_q4": lambda s, d: audit.kpis_by_sector(_v4(s, d, year), YEAR),
        "val_q5": lambda s, d: audit.deficit_split(_v1(s, d, year), YEAR),
        "val_q6": lambda s, d: audit.largest_income(_v4(s, d, year), YEAR),
        "val_q7": lambda s, d: audit.largest_deficit(_v4(s, d, year), YEAR),
        "val_q8": lambda s, d: audit.pay_and_drugs_by_year(_v2(s, d)),
        "val_q9": lambda s, d: audit.workforce_by_year(_v3(s, d)),
        "val_q10": lambda s, d: audit.key_uniqueness(_fact(s, d)),
        "audit_report_dirty": lambda s, d: audit.audit_report(fx.dirty_facts(s, d), *_dims(s, d), EXPECTED),
        "audit_report": lambda s, d: audit.audit_report(_fact(s, d), *_dims(s, d), EXPECTED),
        "subtotal_reconciliation": lambda s, d: subtotals.reconcile(_fact(s, d), refdata.dim_subtotal(s)),
        "subtotal_differences_dirty": lambda s, d: subtotals.reconcile(fx.dirty_facts(s, d), refdata.dim_subtotal(s), 1000).filter("status = 'different'"),
        # measures
        "m_cube": lambda s, d: totals.every_slice(_cube(s, d)),
        "trusts_by_slice": lambda s, d: totals.trusts_by_slice(_cube(s, d)),
        "m_core_from_cube": lambda s, d: measures.core(_cube(s, d), BY_YEAR_SECTOR),
        "m_kpi_from_cube": lambda s, d: measures.kpi(_cube(s, d), BY_YEAR_SECTOR),
        "m_kpi_of_slice": lambda s, d: measures.kpi(_cube(s, d), ["region"], {"sector": fx.SECTORS[:2], **SLICE}),
        "m_core": lambda s, d: measures.core(_card(s, d), BY_YEAR_SECTOR),
        "m_kpi": lambda s, d: measures.kpi(_card(s, d), BY_YEAR_SECTOR),
        "m_workforce": lambda s, d: measures.workforce(_card(s, d), BY_YEAR_SECTOR),
        "m_yoy": lambda s, d: measures.yoy(_card(s, d), ["trust_type"], prior_year=fx.PRIOR_YEARS),
        "m_rag": lambda s, d: measures.rag(_card(s, d), [*BY_YEAR_SECTOR, "region"]),
        "m_benchmark": lambda s, d: measures.benchmark(_card(s, d), BY_YEAR),
        "m_labels": lambda s, d: measures.labels(_card(s, d, year), ["region"], SLICE),
        # monthly returns
        "kpi_cip": lambda s, d: monthly.cip_achievement(fx.monthly(s, d)),
        "kpi_agency": lambda s, d: monthly.agency_share(fx.monthly(s, d)),
        "kpi_capital": lambda s, d: monthly.capital_share(fx.monthly(s, d)),
        "kpi_budget_variance": lambda s, d: monthly.budget_variance(fx.monthly(s, d)),
        # report pages
        "dash_income_by_sector": lambda s, d: dashboard.income_by_sector(_card(s, d)),
        "dash_deficit_split": lambda s, d: dashboard.deficit_surplus_split(_card(s, d)),
        "dash_income_bridge": lambda s, d: dashboard.income_bridge(_card(s, d)),
        "dash_trust_year_matrix": lambda s, d: dashboard.trust_year_matrix(_v1(s, d)),
        "dash_ebitda_income": lambda s, d: dashboard.ebitda_income_scatter(_v4(s, d)),
        "dash_pay_ebitda": lambda s, d: dashboard.pay_ebitda_scatter(_v4(s, d)),
        "dash_spend_mix": lambda s, d: dashboard.spend_mix(_card(s, d)),
        "dash_wte_by_sector": lambda s, d: dashboard.wte_by_sector(_card(s, d)),
        "dash_staff_cost_trend": lambda s, d: dashboard.staff_cost_trend(_card(s, d)),
        "dash_best_ebitda": lambda s, d: dashboard.best_ebitda(_card(s, d, year), YEAR),
        "dash_cost_per_wte": lambda s, d: dashboard.cost_per_wte_by_trust(_card(s, d, year), YEAR),
    }
