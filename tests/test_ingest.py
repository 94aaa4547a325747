"""Published extracts: headers, dirty values, upserts, files and periods."""

import os
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from provfin import refdata
from provfin.functions import expr
from provfin.operators import ingest, merge
from provfin.operators.ranking import ntile
from provfin.plans import audit, extracts, views
from provfin.sources import fixture as fx
from provfin.sources import readers, sinks

LINE = ["OrganisationName", "WorkSheetName", "TableID", "MainCode", "RowNumber", "SubCode", "Total", "source_file"]
FILE = "TAC_NHS_trusts_2023-24.csv"


def lines(spark, rows, columns=LINE):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))


def line(name="Org A", main="A08CY01", row="1", code="EXP0130", total="5", sheet="TAC08 Op Exp", file=FILE):
    return (name, sheet, "1", main, row, code, total, file)


def providers(spark, rows):
    schema = "`Full name of Provider` string, `NHS code` string, Region string, Sector string, `Comments ` string, source_file string"
    return spark.createDataFrame([(n, c, "North", s, None, f) for n, c, s, f in rows], schema)


def test_headers_of_both_generations_give_the_same_rows(spark):
    old = ["Organisation Name", "WorkSheetName", "TableID", "MainCode", "RowNumber", "SubCode", "Value number", "source_file"]
    row = line()
    assert ingest.clean_lines(lines(spark, [row])).collect() == ingest.clean_lines(lines(spark, [row], old)).collect()


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="SubCode"):
        ingest.clean_lines(lines(spark, [line()]).drop("SubCode"))


def test_dirty_totals_and_dropped_rows(spark):
    rows = [
        line(total="1,234", code="a"), line(total="x", code="b"), line(total="12.9", code="c"), line(total=None, code="d"),
        line(total="-7.9", code="e"), line(total=" ", code="f"), line(name=None, code="g"), line(name=" nan ", code="h"),
        line(code=None), line(main="A09PY01", code="i"), line(main=None, code="j"), line(code=" k "),
    ]
    clean = {r.sub_code: r.total for r in ingest.clean_lines(lines(spark, rows)).collect()}
    assert clean == {"a": 1234, "b": 0, "c": 12, "e": -7, "j": 5, "k": 5}


def test_totals_keep_the_fractions_asked_for(spark):
    rows = [
        line(total="1,234.567", code="a"), line(total="-7.999", code="b"), line(total="x", code="c"), line(total="0.29", code="d"),
        line(total="99999999999999.99", code="e"), line(total="1.5e2", code="f"), line(total="-99,999,999,999,999.99", code="g"),
        line(total="100000000000000", code="h"),
    ]
    exact = {"a": "1234.56", "b": "-7.99", "c": "0.00", "d": "0.29", "e": "99999999999999.99", "f": "150.00", "g": "-99999999999999.99"}
    clean = ingest.clean_lines(lines(spark, rows), scale=2)
    assert {r.sub_code: str(r.total) for r in clean.collect()} == exact
    fact = merge.promote_lines(clean, ingest.clean_providers(providers(spark, [("Org A", "RAA", None, FILE)])))
    assert {r.sub_code: str(r.total_000s) for r in fact.collect()} == exact
    four = ingest.clean_lines(lines(spark, [line(total="-0.00019", row="9223372036854775807"), line(total="2", row="-9")]), scale=4)
    fact = merge.promote_lines(four, ingest.clean_providers(providers(spark, [("Org A", "RAA", None, FILE)])))
    assert [str(r.total_000s) for r in fact.collect()] == ["-0.0001"]
    with pytest.raises(ValueError, match="fractional digits"):
        ingest.clean_lines(lines(spark, [line()]), scale=5)


def test_fractions_reach_the_views_and_a_table_keeps_one_scale(spark, tmp_path):
    staff = [line(sheet="TAC09 Staff", main="A09CY01", code="STA0410", total="10.25"), line(sheet="TAC09 Staff", main="A09CY01", code="STA0550", total="4.5"),
             line(code="EXP0130", total="100"), line(sheet="TAC02 SoCI", main="A02CY01", code="SCI0100A", total="400")]
    listed = ingest.clean_providers(providers(spark, [("Org A", "RAA", None, FILE)]))
    load = lambda scale: merge.promote_lines(ingest.clean_lines(lines(spark, staff), scale), listed)
    trusts, codes = merge.build_dim_trust(listed), refdata.dim_subcode(spark)
    row = views.workforce(load(2), trusts).first()
    assert (row.total_wte, row.avg_days_lost_per_wte) == (Decimal("10.25"), Decimal("4.50"))
    assert views.kpis(load(2), trusts, codes).first().cost_per_wte_000s == Decimal("9.8")
    assert views.kpis(load(0), trusts, codes).first().cost_per_wte_000s == Decimal("10.0")
    sinks.promote_into(str(tmp_path / "fact"), load(2))
    sinks.promote_into(str(tmp_path / "fact"), load(2))
    assert views.workforce(spark.read.parquet(str(tmp_path / "fact")), trusts).first().total_wte == Decimal("10.25")
    with pytest.raises(ValueError, match="fractional digits"):
        sinks.promote_into(str(tmp_path / "fact"), load(0))


def test_one_pass_gives_the_four_views(spark, sf_dir):
    fact, trust, codes = fx.facts(spark, sf_dir), fx.dim_trust(spark, sf_dir), refdata.dim_subcode(spark).filter("sub_code <> 'EXP0170'")
    lost = fact.filter("NOT (worksheet_name = 'TAC08 Op Exp' AND CAST(org_code AS BIGINT) % 3 = 0 AND sub_code <> 'EXP0170')")
    narrow = views.narrow_views(views.wide_rows(lost, codes), trust)
    direct = {
        "income_expenditure": views.income_expenditure(lost, trust), "expenditure_breakdown": views.expenditure_breakdown(lost, trust, codes),
        "workforce": views.workforce(lost, trust), "kpis": views.kpis(lost, trust, codes),
    }
    for name, df in direct.items():
        assert narrow[name].columns == df.columns
        rows = [sorted(map(str, frame.collect())) for frame in (narrow[name], df)]
        assert rows[0] == rows[1] and rows[0]


def test_file_names(spark):
    names = spark.createDataFrame([("TAC_NHS_Foundation_trusts_2021-22.csv",), (FILE,)], "f string")
    rows = names.selectExpr(ingest.derive_financial_year("f") + " AS y", ingest.derive_trust_type("f") + " AS t").collect()
    assert [tuple(r) for r in rows] == [("2021/22", "FOUNDATION_TRUST"), ("2023/24", "NHS_TRUST")]
    with pytest.raises(PySparkException, match="no year in the file name"):
        spark.createDataFrame([("nothing.csv",)], "f string").selectExpr(ingest.derive_financial_year("f")).collect()


def test_provider_codes(spark):
    rows = [("Org A ", " RAA ", "Acute", FILE), ("Org B", "RB", None, FILE), ("Org C", None, None, FILE), ("D", "nan", None, FILE)]
    assert [r.org_code for r in ingest.clean_providers(providers(spark, rows)).collect()] == ["RAA"]


def promoted(spark, line_rows, provider_rows):
    return merge.promote_lines(
        ingest.clean_lines(lines(spark, line_rows)), ingest.clean_providers(providers(spark, provider_rows))
    )


def test_names_match_without_case_and_last_row_wins(spark):
    rows = [line(name="ORG A ", row="1", total="5"), line(name="Org A", row="2", total="6"), line(name="Nobody", total="9")]
    out = promoted(spark, rows, [(" org a", "RAA", "Acute", FILE)]).collect()
    assert [(r.org_code, int(r.total_000s), r.financial_year) for r in out] == [("RAA", 6, "2023/24")]


def test_two_names_of_one_code_meet(spark):
    rows = [line(name="Org A", row="1", total="5"), line(name="Org Old", row="2", total="6")]
    out = promoted(spark, rows, [("Org A", "RAA", None, FILE), ("Org Old", "RAA", None, FILE)]).collect()
    assert [int(r.total_000s) for r in out] == [6]


def test_merge_is_idempotent_and_order_free(spark):
    rows = [line(row=str(i), total=str(i), code=f"c{i % 4}") for i in range(40)]
    names = [("Org A", "RAA", None, FILE)]
    batch = promoted(spark, rows, names)
    base = promoted(spark, [line(code="c1", total="999"), line(code="c9", total="1")], names)
    once = merge.merge_facts(base, batch)
    twice = merge.merge_facts(once, batch)
    shuffled = merge.merge_facts(base, promoted(spark, rows[::-1], names).repartition(3))

    def key(df):
        return sorted(map(str, df.collect()))

    assert key(once) == key(twice) == key(shuffled)
    assert {r.sub_code: int(r.total_000s) for r in once.collect()} == {"c0": 36, "c1": 37, "c2": 38, "c3": 39, "c9": 1}


def test_dim_trust_keeps_known_sector_and_year_range(spark):
    new, old = "TAC_NHS_trusts_2023-24.csv", "TAC_NHS_trusts_2021-22.csv"
    first = merge.build_dim_trust(ingest.clean_providers(providers(spark, [("Org A", "RAA", "Acute", old)])))
    second = ingest.clean_providers(providers(spark, [("Org A Group", "RAA", None, new), ("Org B", "RBB", None, new)]))
    rows = {r.org_code: r for r in merge.build_dim_trust(second, first).collect()}
    assert rows["RAA"].sector == "Acute" and rows["RAA"].organisation_name == "Org A"
    assert (rows["RAA"].first_year_seen, rows["RAA"].last_year_seen) == ("2021/22", "2023/24")
    assert rows["RBB"].sector is None and rows["RBB"].is_foundation == 0


def test_unseen_worksheet(spark):
    clean = ingest.clean_lines(lines(spark, [line(sheet="TAC99 New"), line()]))
    rows = merge.extend_worksheets(refdata.dim_worksheet(spark), clean).filter("category = 'OTHER'").collect()
    assert [r.schedule_title for r in rows if r.worksheet_name == "TAC99 New"] == ["TAC99 New"]


def test_preload_gate_counts_what_cleaning_drops(spark):
    rows = [line(row="1"), line(row="2"), line(name="Nobody"), line(name=" "), line(name=None), line(code="nan"), line(total=None),
            line(total="n/a"), line(total="1e20"), line(total="-100,000,000,000,000")]
    listed = ingest.clean_providers(providers(spark, [("org a", "RAA", None, FILE)]))
    raw = lines(spark, rows)
    failures = {r.check_name: (r.failures, r.passed) for r in audit.preload_audit(raw, listed).collect()}
    assert failures == {
        "nulls in organisation_name": (2, False), "nulls in sub_code": (1, False), "nulls in total": (1, False),
        "nulls in financial_year": (0, True), "totals that do not fit": (2, False), "unreadable totals": (1, False),
        "duplicate (org, main_code, sub_code) rows": (2, False), "organisation names not in provider list": (1, False),
    }
    assert sorted(r.total for r in ingest.clean_lines(raw).collect()) == sorted([0, *[int(x.total) for x in ingest.clean_lines(lines(spark, rows[:3])).collect()]])


def test_long_codes_are_kept_whole(spark):
    codes = spark.sql(f"SELECT {fx.org_code('id')} AS c FROM VALUES (7), (999999999), (1000000000), (1000000001) AS t(id)")
    assert [r.c for r in codes.collect()] == ["000000007", "999999999", "1000000000", "1000000001"]
    rows = [("A", "1000000001", None, FILE), ("B", "00000001", None, FILE), ("C", "000000001", None, FILE)]
    kept = ingest.clean_providers(providers(spark, rows), code_length=9, or_longer=True)
    assert sorted(r.org_code for r in kept.collect()) == ["000000001", "1000000001"]


def test_raw_lines_are_hashed_not_sorted_before_the_first_shuffle(spark, sf_dir):
    plan = merge.promote_lines(ingest.clean_lines(fx.raw_lines(spark, sf_dir)), ingest.clean_providers(fx.raw_providers(spark, sf_dir), 9, True))
    text = plan._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(i for i, x in enumerate(text) if "partial_max(place" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    below = [x for x in text[at:] if depth(x) >= depth(text[at])]
    assert "HashAggregate" in text[at] and not any("Sort" in x for x in below[:4])


def test_batches_in_one_scan_equal_merging_in_turn(spark):
    rows = [line(row=str(i), total=str(i * 7 % 40), code=f"c{i % 5}", sheet=f"TAC{i % 3}") for i in range(60)]
    clean, listed = ingest.clean_lines(lines(spark, rows)), ingest.clean_providers(providers(spark, [("Org A", "RAA", None, FILE)]))
    first = "row_num % 4 < 2"
    turn = merge.merge_facts(merge.promote_lines(clean.filter(first), listed), merge.promote_lines(clean.filter(f"NOT {first}"), listed))
    once = merge.promote_lines(clean, listed, batch=f"CASE WHEN {first} THEN 0 ELSE 1 END")
    assert sorted(map(str, turn.collect())) == sorted(map(str, once.select(*turn.columns).collect()))


def test_files_to_fact_table(spark, tmp_path):
    raw, table = tmp_path / "raw", str(tmp_path / "fact")
    raw.mkdir()
    (raw / "TAC_NHS_trusts_2022-23.csv").write_text(
        "Organisation Name,WorkSheetName,TableID,MainCode,RowNumber,SubCode,Value number\n"
        'Org A,TAC08 Op Exp,1,A08CY01,1,EXP0130,"1,200"\n'
    )
    (raw / FILE).write_text(
        "OrganisationName,WorkSheetName,TableID,MainCode,RowNumber,SubCode,Total\n"
        "org a,TAC08 Op Exp,1,A08CY01,1,EXP0130,7\norg a,TAC08 Op Exp,1,A08PY01,1,EXP0130,8\n"
    )
    (raw / "TAC_NHS_trusts_2022-23_Illustrative.csv").write_text("x\n1\n")
    paths = readers.discover(spark, str(raw))
    assert [os.path.basename(p) for p in paths] == ["TAC_NHS_trusts_2022-23.csv", FILE]
    clean = ingest.clean_lines(readers.read_lines(spark, paths))
    names = [("Org A", "RAA", None, FILE), ("Org A", "RAA", None, "TAC_NHS_trusts_2022-23.csv")]
    listed = ingest.clean_providers(providers(spark, names))
    batch = merge.promote_lines(clean, listed)
    for _ in range(2):
        sinks.promote_into(table, batch)
    stored = spark.read.parquet(table)
    assert {(r.financial_year, int(r.total_000s)) for r in stored.collect()} == {("2022/23", 1200), ("2023/24", 7)}
    assert stored.count() == 2
    times = {r.load_ts for r in stored.collect()}
    assert len(times) == 1 and None not in times
    one_year = batch.filter("financial_year = '2023/24'").withColumn("total_000s", (batch.total_000s + 1).cast("decimal(14,0)"))
    sinks.promote_into(table, one_year)
    assert {int(r.total_000s) for r in spark.read.parquet(table).collect()} == {1200, 8}
    assert {r.load_ts for r in spark.read.parquet(table).collect()} == times


def test_many_files_are_one_read_for_each_header(spark, tmp_path):
    heads = ["Organisation Name,WorkSheetName,TableID,MainCode,RowNumber,SubCode,Value number",
             "OrganisationName,WorkSheetName,TableID,MainCode,RowNumber,SubCode,Total"]
    for i in range(200):
        name = f"TAC_NHS_trusts_{2000 + i % 20}-{(i + 1) % 20:02d}_{i}.csv"
        (tmp_path / name).write_text(f'{heads[i % 2]}\nOrg {i},TAC08 Op Exp,1,A08CY01,1,EXP0130,"{i},000"\n')
    paths = readers.discover(spark, str(tmp_path))
    read = readers.read_lines(spark, paths)
    assert read._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2
    assert {r.organisation_name: r.total for r in ingest.clean_lines(read).collect()} == {f"Org {i}": i * 1000 for i in range(200)}


def test_parquet_copies_read_alike(spark, tmp_path):
    lines(spark, [line(total="7")]).drop("source_file").coalesce(1).write.parquet(str(tmp_path / "x"))
    part = next(p for p in os.listdir(tmp_path / "x") if p.endswith(".parquet"))
    os.rename(tmp_path / "x" / part, tmp_path / "TAC_NHS_trusts_2023-24.parquet")
    clean = ingest.clean_lines(readers.read_lines(spark, [str(tmp_path / "TAC_NHS_trusts_2023-24.parquet")])).first()
    assert (clean.total, clean.financial_year) == (7, "2023/24")


@pytest.mark.parametrize("build", [extracts.report_set, extracts.enriched_set])
def test_extract_sets(spark, sf_dir, tmp_path, build):
    fact, trust = fx.facts(spark, sf_dir), fx.dim_trust(spark, sf_dir, seen=True)
    frames = build(fact, trust, refdata.dim_subcode(spark), refdata.dim_financial_year(spark))
    assert len(frames) == 9
    sinks.write_extracts(frames, str(tmp_path), extracts.ROW_ORDER, extracts.DEFAULT_ORDER)
    for name, df in frames.items():
        stored = spark.read.option("header", True).csv(str(tmp_path / name))
        assert stored.columns == df.columns and stored.count() == df.count() > 0


def test_extract_and_report_files(spark, tmp_path):
    rows = spark.sql("SELECT 'b' AS k, 1 AS v UNION ALL SELECT 'a', 2")
    sinks.write_extract(rows, str(tmp_path / "x"), order=["k"], single_file=True)
    assert [r.k for r in spark.read.option("header", True).csv(str(tmp_path / "x")).collect()] == ["a", "b"]
    sinks.write_report(rows, str(tmp_path / "r"))
    assert "run_ts" in spark.read.option("header", True).csv(str(tmp_path / "r")).columns


@pytest.mark.parametrize(
    "date, year, period, quarter",
    [("2024-03-31", "2023/24", "M12", "Q4"), ("2024-04-01", "2024/25", "M01", "Q1"), ("1999-12-31", "1999/00", "M09", "Q3")],
)
def test_fiscal_period(spark, date, year, period, quarter):
    d = f"DATE '{date}'"
    row = spark.sql(f"SELECT {expr.financial_year(d)} y, {expr.period_label(d)} p, {expr.quarter_label(d)} q").first()
    assert tuple(row) == (year, period, quarter)


def test_rounding(spark):
    row = spark.sql(
        f"SELECT {expr.pct('247', '2000')} a, {expr.pct('-247', '2000')} b, {expr.kpi_even('247', '2000', 100)} c, "
        f"{expr.pct('1', '0')} d, {expr.thousands('1234.5BD')} e, {expr.signed_label('0.5BD', 'pp')} f"
    ).first()
    assert (row.a, row.b, str(row.c), row.d, row.e, row.f) == (12.4, -12.4, "12.4", None, "1,235", "+0.5pp")


def test_ntile_spreads_one_repeated_value(spark):
    rows = spark.range(1000).selectExpr("'g' AS grp", "CASE WHEN id < 700 THEN 5 ELSE id END AS v", "id")
    exact = rows.selectExpr("id", "ntile(7) OVER (PARTITION BY grp ORDER BY v, id) AS expected")
    mine = ntile(rows, 7, ["grp"], ["v", "id"], "bucket")
    assert mine.join(exact, "id").filter("bucket <> expected").count() == 0
    assert mine.count() == 1000
