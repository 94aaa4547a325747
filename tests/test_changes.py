"""Refresh by change, intake as a stream, refused lines, subtotals, cube, linked extracts, history, named reports, file source."""

import os

import pytest
from compare import spark_rows
from pyspark.sql import functions as F
from test_ingest import FILE, line, lines, providers
from test_scale import settings

from provfin import refdata
from provfin.operators import ingest, merge
from provfin.plans import audit, extracts, measures, named, refresh, subtotals, totals, views
from provfin.registry import queries as registry
from provfin.sources import files, readers, sinks
from provfin.sources import fixture as fx
from provfin.streaming import intake

HEADER = "OrganisationName,WorkSheetName,TableID,MainCode,RowNumber,SubCode,Total"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


# --- refresh by change ---------------------------------------------------------------------------------


@pytest.fixture
def stored_facts(spark, sf_dir, tmp_path):
    path = str(tmp_path / "fact")
    sinks.promote_into(path, fx.facts(spark, sf_dir))
    return path


def test_refresh_reads_touched_years_alone(spark, sf_dir, stored_facts):
    fact = spark.read.parquet(stored_facts)
    some = fact.filter("financial_year = '2000/01' AND CAST(org_code AS BIGINT) % 4 = 1").select("org_code", "financial_year").distinct()
    years = refresh.years_of(some)
    assert years == ["2000/01"]
    card = refresh.scorecard_of(fact, some, years, fx.dim_trust(spark, sf_dir), refdata.dim_subcode(spark))
    scan = next(ln for ln in plan_of(card).splitlines() if "FileScan parquet" in ln and "total_000s" in ln)
    assert "2000/01" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    whole = views.scorecard(fact, fx.dim_trust(spark, sf_dir), refdata.dim_subcode(spark)).join(some, ["org_code", "financial_year"], "left_semi")
    assert spark_rows(card) == spark_rows(whole.select(*card.columns))


def test_refresh_twice_changes_nothing_and_empty_partitions_go(spark, sf_dir, stored_facts, tmp_path):
    dims = fx.dim_trust(spark, sf_dir), refdata.dim_subcode(spark)
    card, fact = str(tmp_path / "card"), spark.read.parquet(stored_facts)
    refresh.refresh_into(card, fact, [], *dims)
    keys = fact.filter("financial_year >= '1999/00'").select("org_code", "financial_year").distinct()
    before = spark_rows(spark.read.parquet(card).select(*views.SCORECARD_COLUMNS))
    assert refresh.refresh_into(card, fact, [keys], *dims) == sorted({r[1] for r in keys.collect()})
    assert spark_rows(spark.read.parquet(card).select(*views.SCORECARD_COLUMNS)) == before
    assert refresh.refresh_into(card, fact, [keys.limit(0)], *dims) == []
    broke = fact.filter("financial_year <> '2000/01' OR trust_type = 'NHS_TRUST' OR sub_code NOT IN ('SCI0100A', 'SCI0110A')")
    refresh.refresh_into(card, broke, [keys], *dims)
    left = spark.read.parquet(card)
    assert left.filter("financial_year = '2000/01' AND trust_type = 'FOUNDATION_TRUST'").isEmpty()
    assert not left.filter("financial_year = '2000/01' AND trust_type = 'NHS_TRUST'").isEmpty()


def test_touched_keys(spark, sf_dir):
    fact = fx.facts(spark, sf_dir).filter("financial_year >= '1999/00'")
    assert refresh.touched(fact, fact).isEmpty()
    changed = fact.selectExpr("*").withColumn("total_000s", (fact.total_000s + 1).cast("decimal(14,0)")).filter("org_code LIKE '%3' AND sub_code = 'EXP0130'")
    assert rows(refresh.touched(changed, fact), "org_code", "financial_year") == rows(changed.distinct(), "org_code", "financial_year")
    trusts = fx.dim_trust(spark, sf_dir)
    moved = trusts.selectExpr("*").filter("org_code <> '000000002'").withColumn("sector", trusts.sector).na.replace("Community", "Other", "sector")
    found = {r.org_code for r in refresh.touched_by_trusts(fact, trusts, moved).collect()}
    assert found == {r.org_code for r in trusts.filter("sector = 'Community' OR org_code = '000000002'").join(fact, "org_code", "left_semi").collect()}


# --- stream --------------------------------------------------------------------------------------------


def published(folder, name, *body):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as out:
        out.write("\n".join([HEADER, *body]) + "\n")


def test_stream_reads_new_files_alone_and_repeats_no_line(spark, tmp_path):
    raw, fact, seen = (str(tmp_path / n) for n in ("raw", "fact", "seen"))
    listed = ingest.clean_providers(providers(spark, [("Org A", "RAA", "Acute", f) for f in (FILE, "TAC_NHS_trusts_2022-23.csv")]))
    published(raw, FILE, "Org A,TAC08 Op Exp,1,A08CY01,1,EXP0130,5")
    published(raw, "TAC_NHS_illustrative_2023-24.csv", "Org A,TAC08 Op Exp,1,A08CY01,1,EXP0140,9")
    assert intake.promote_new(spark, raw, listed, fact, seen) == 1
    assert intake.promote_new(spark, raw, listed, fact, seen) == 0  # nothing new: no file is opened
    published(raw, "TAC_NHS_trusts_2022-23.csv", "Org A,TAC08 Op Exp,1,A08CY01,1,EXP0130,6")
    os.remove(os.path.join(raw, FILE))  # a file that has been seen is not needed any more
    assert intake.promote_new(spark, raw, listed, fact, seen) == 1
    want = [("RAA", "2022/23", 6), ("RAA", "2023/24", 5)]
    assert rows(spark.read.parquet(fact).selectExpr("org_code", "financial_year", "CAST(total_000s AS INT) AS t"), "org_code", "financial_year", "t") == want


def test_a_killed_batch_is_repeated_without_doubling(spark, tmp_path):
    raw, fact, seen = (str(tmp_path / n) for n in ("raw", "fact", "seen"))
    listed = ingest.clean_providers(providers(spark, [("Org A", "RAA", "Acute", FILE)]))
    published(raw, FILE, "Org A,TAC08 Op Exp,1,A08CY01,1,EXP0130,5", "Org A,TAC08 Op Exp,1,A08CY01,2,EXP0140,7")
    done = []

    def load(paths, number):
        sinks.promote_into(fact, merge.promote_lines(ingest.clean_lines(readers.read_lines(spark, paths)), listed))
        done.append(number)
        if len(done) == 1:
            raise RuntimeError("killed after the write")

    with pytest.raises(Exception, match="killed after the write"):
        intake.each_batch(intake.new_files(spark, raw), seen, load)
    assert intake.each_batch(intake.new_files(spark, raw), seen, load) == 1
    assert done == [0, 0] and rows(spark.read.parquet(fact), "sub_code") == [("EXP0130",), ("EXP0140",)]


# --- refused lines -------------------------------------------------------------------------------------


def test_staging_counts_what_it_keeps_and_refuses(spark, tmp_path):
    made = lines(spark, [line(), line(total=None), line(name=None, code="nan"), line(main="A08PY01"), line(total="9" * 15), line(total="x")])
    counts = sinks.stage_lines(made, str(tmp_path / "stage"))
    assert counts["read"] == 6 and counts["refused"] == 4
    assert [counts[r] for r in ingest.REFUSALS] == [0, 1, 1, 1, 1, 1]
    stage = spark.read.parquet(str(tmp_path / "stage"))
    assert stage.filter("NOT refused").count() == ingest.clean_lines(made).count() == 2
    assert rows(ingest.rejected_lines(made), "reasons") == [("no organisation, no sub-code",), ("no total",), ("prior year",), ("total does not fit",)]
    told = ingest.line_counts(made).collect()[0]
    assert told.read == told.kept + told.refused == 6


def test_rows_that_do_not_fit_the_header_are_told(spark, tmp_path):
    folder = str(tmp_path)
    good, short, long = "Org A,TAC08 Op Exp,1,A08CY01,1,EXP0130,5", "Org A,TAC08 Op Exp,1,A08CY01", "Org B,TAC08 Op Exp,1,A08CY01,1,EXP0140,5,6,7"
    published(folder, FILE, good, short, long)
    raw = readers.read_lines(spark, readers.discover(spark, folder))
    assert rows(ingest.rejected_lines(raw).filter("reasons LIKE 'malformed row%'"), "malformed_row") == [(short,), (long,)]
    assert rows(ingest.clean_lines(raw), "sub_code") == [("EXP0130",)]
    files.register(spark)
    source = spark.read.format(files.NAME).load(folder)
    assert rows(ingest.rejected_lines(source), "malformed_row") == [(short,), (long,)]
    assert rows(ingest.clean_lines(source), "sub_code", "financial_year", "trust_type") == [("EXP0130", "2023/24", "NHS_TRUST")]


# --- checks that fail while they run -------------------------------------------------------------------


def test_a_check_that_fails_while_it_runs_loses_only_itself(spark, sf_dir):
    fact, dims = fx.facts(spark, sf_dir), (fx.dim_trust(spark, sf_dir), refdata.dim_subcode(spark))
    whole = {r.check_name: r for r in audit.run_report(fact, *dims, registry.EXPECTED).collect()}
    assert [tuple(r) for r in whole.values()] == [tuple(r) for r in audit.audit_report(fact, *dims, registry.EXPECTED).collect()]
    broken = fact.withColumn("sub_code", F.expr("CASE WHEN sub_code = 'STA0410' THEN CAST(raise_error('unreadable block') AS STRING) ELSE sub_code END"))
    report = {r.check_name: r for r in audit.run_report(broken, *dims, registry.EXPECTED).collect()}
    assert set(report) == set(whole)
    failed = {n for n, r in report.items() if r.detail.startswith("Exception")}
    assert "fct_tac row count" not in failed and "dim_trust row count" not in failed and "no duplicate fact keys" in failed
    assert all(report[n].severity == "CRITICAL" and not report[n].passed for n in failed)
    assert all(report[n] == whole[n] for n in set(whole) - failed)


# --- subtotals -----------------------------------------------------------------------------------------


def test_differences_are_found_on_the_level_where_they_arise(spark):
    tree = spark.createDataFrame([("TOP", "MID", 1), ("TOP", "X", -1), ("MID", "A", 1), ("MID", "B", 1)], "whole string, part string, sign int")
    assert {(r.whole, r.part, r.sign, r.level, r.leaf) for r in subtotals.below(tree).collect()} == {
        ("TOP", "MID", 1, 1, False), ("TOP", "X", -1, 1, True), ("MID", "A", 1, 1, True), ("MID", "B", 1, 1, True),
        ("TOP", "A", 1, 2, True), ("TOP", "B", 1, 2, True),
    }
    values = {"1": {"TOP": 8, "MID": 10, "A": 4, "B": 6, "X": 2}, "2": {"TOP": 8, "MID": 10, "A": 4, "B": 5, "X": 2}, "3": {"TOP": 8}, "4": {"MID": 1, "A": 1, "B": None}}
    fact = spark.createDataFrame([(o, "2023/24", c, v) for o, v in values.items() for c, v in v.items()] + [("1", "2023/24", "A", 3)], "org_code string, financial_year string, sub_code string, total_000s int")
    found = {(r.org_code, r.sub_code): (r.parts_difference_000s, r.leaves_difference_000s, r.status) for r in subtotals.reconcile(fact, tree).collect()}
    assert found == {
        ("1", "TOP"): (0, 0, "balanced"), ("1", "MID"): (0, 0, "balanced"), ("2", "TOP"): (0, 1, "different"), ("2", "MID"): (1, 1, "different"),
        ("3", "TOP"): (None, None, "no parts"), ("4", "MID"): (0, 0, "balanced"),
    }
    assert {r.status for r in subtotals.reconcile(fact, tree, 1).collect()} == {"balanced", "no parts"}


# --- cube ----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def card_and_cube(spark, sf_dir, tmp_path_factory):
    card = registry._card(spark, sf_dir)
    path = str(tmp_path_factory.mktemp("cube") / "cube")
    registry._cube(spark, sf_dir).write.parquet(path)
    return card, spark.read.parquet(path), path


@pytest.mark.parametrize("measure", [measures.core, measures.kpi, measures.workforce, measures.rag])
@pytest.mark.parametrize(("by", "filters"), [([], None), (["sector"], None), (["region", "trust_type"], {"financial_year": ["1999/00", "2000/01"]}), ([], {"sector": ["nowhere"]})])
def test_measures_from_the_cube_equal_those_from_the_scorecard(card_and_cube, measure, by, filters):
    card, cube, path = card_and_cube
    answer = measure(cube, by, filters)
    assert spark_rows(answer) == spark_rows(measure(card, by, filters))
    assert {f.split("/cube/")[0] + "/cube" for f in answer.inputFiles()} <= {f"file://{path}"}


def test_prior_years_from_the_cube(card_and_cube):
    card, cube, _ = card_and_cube
    assert spark_rows(measures.yoy(cube, ["sector"], prior_year=fx.PRIOR_YEARS)) == spark_rows(measures.yoy(card, ["sector"], prior_year=fx.PRIOR_YEARS))
    with pytest.raises(ValueError, match="organisation_name"):
        measures.core(cube, ["organisation_name"])


def test_organisations_are_counted_without_a_shuffle_on_them(card_and_cube):
    _, cube, _ = card_and_cube
    plan = plan_of(totals.trusts_by_slice(cube))
    assert "hashpartitioning(" in plan and "org_code" not in plan and "org_number" not in plan


# --- linked extracts -----------------------------------------------------------------------------------


def test_linked_extracts_meet_bucket_by_bucket(spark, sf_dir, tmp_path):
    years = refdata.dim_financial_year(spark)
    frames = {"ie_summary": extracts.income_summary_extract(registry._v1(spark, sf_dir)), "workforce": extracts.workforce_extract(registry._v3(spark, sf_dir))}
    trusts = fx.dim_trust(spark, sf_dir)
    model = extracts.write_model(str(tmp_path), "test_model", frames, trusts, buckets=4)
    for name, frame in frames.items():
        with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
            linked = model[name].join(model["dim_trust"].select("org_code", "is_foundation"), "org_code", "left")
            assert "Exchange" not in plan_of(linked) and "SortMergeJoin" in plan_of(linked)
        assert spark_rows(extracts.with_dimensions(model[name], model["dim_trust"], years)) == spark_rows(extracts.with_dimensions(frame, trusts, years))


# --- history -------------------------------------------------------------------------------------------


def test_organisations_over_time(spark, sf_dir):
    name = "TAC_NHS_trusts_20{}-{}.csv".format
    rows_ = [("A", "RAA", "Acute", name(20, 21)), ("A", "RAA", None, name(21, 22)), ("A", "RAA", "Community", name(22, 23)), ("A", "RAA", "Acute", name("24", 25)), ("B", "RBB", None, name(20, 21))]
    history = merge.build_trust_history(ingest.clean_providers(providers(spark, rows_)))
    assert rows(history, "org_code", "sector", "entry", "valid_from", "valid_before", "last_listed", "lists") == [
        ("RAA", "Acute", 1, "2020/21", "2022/23", "2021/22", 2), ("RAA", "Acute", 3, "2024/25", None, "2024/25", 1),
        ("RAA", "Community", 2, "2022/23", "2024/25", "2022/23", 1), ("RBB", None, 1, "2020/21", None, "2020/21", 1),
    ]
    years = ["2018/19", "2020/21", "2021/22", "2022/23", "2023/24", "2025/26"]
    fact = spark.createDataFrame(
        [(o, y, refdata.WS_SOCI, "A02CY01", "SCI0100A", 10) for o in ("RAA", "RBB", "RZZ") for y in years],
        "org_code string, financial_year string, worksheet_name string, main_code string, sub_code string, total_000s int",
    )
    card = views.scorecard_as_of(fact, history, refdata.dim_subcode(spark))
    assert [r[2] for r in rows(card.filter("org_code = 'RAA'"), "org_code", "financial_year", "sector")] == ["Acute", "Acute", "Acute", "Community", "Community", "Acute"]
    assert card.count() == 12


def test_history_has_organisations_that_change_sector(spark, sf_dir):
    assert registry._history(spark, sf_dir).groupBy("org_code").agg({"sector": "count"}).filter("`count(sector)` > 2").count() > 0


# --- reports by name -----------------------------------------------------------------------------------


def test_named_reports_prune_and_bind(spark, sf_dir, stored_facts):
    trusts = fx.dim_trust(spark, sf_dir).replace("Community", "King's \\ \"own\"; --", "sector")
    card = views.scorecard(spark.read.parquet(stored_facts), trusts, refdata.dim_subcode(spark))
    assert "top_income" in named.register(spark, {"scorecard": card})
    answer = spark.sql("SELECT * FROM top_income(:year)", args={"year": "2000/01"})
    scan = next(ln for ln in plan_of(answer).splitlines() if "FileScan parquet" in ln and "total_000s" in ln)
    assert "2000/01" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    found = named.call(spark, "sector_members", chosen="King's \\ \"own\"; --", year="2000/01")
    assert found.count() == card.filter("financial_year = '2000/01'").filter(card.sector == "King's \\ \"own\"; --").count() > 0
    assert named.call(spark, "sector_members", chosen="x' OR '1'='1", year="2000/01").isEmpty()
    with pytest.raises(ValueError, match="no report"):
        named.call(spark, "top_income(1); --")


# --- file source ---------------------------------------------------------------------------------------


def test_planning_opens_no_file(spark, tmp_path):
    folder = str(tmp_path)
    for i in range(2000):
        published(folder, f"TAC_NHS_trusts_2023-24_{i}.csv", f"Org {i},TAC08 Op Exp,1,A08CY01,1,EXP0130,{i}")
    published(folder, "TAC_NHS_illustrative_2023-24.csv", "x")
    published(folder, "notes.csv", "x")
    files.register(spark)
    source = spark.read.format(files.NAME).option("bundle_bytes", 20000).load(folder)
    assert 2 < source.rdd.getNumPartitions() < 100
    assert ingest.clean_lines(source).selectExpr("count(*)", "count(DISTINCT source_file)", "sum(total)").first()[:] == (2000, 2000, 1999000)
    reader = files.AccountReader(folder, 20000)
    os.chmod(os.path.join(folder, "TAC_NHS_trusts_2023-24_5.csv"), 0)
    with open(os.path.join(folder, "TAC_NHS_trusts_2023-24_6.csv"), "w") as out:
        out.write("Some,Other,Header\n1,2,3\n")
    assert sum(len(b.files) for b in reader.partitions()) == 2000
    with pytest.raises(Exception, match="none of the known headers"):
        spark.read.format(files.NAME).load(folder).collect()


def test_headers_of_all_generations_and_unknown_years(spark, tmp_path):
    folder = str(tmp_path)
    published(folder, "TAC_NHS_trusts_2022-23.csv", 'Org A,"TAC08, Op Exp",1,A08CY01,1,EXP0130,"1,234"')
    with open(os.path.join(folder, "TAC_NHS_foundation_2023-24.csv"), "wb") as out:
        out.write("﻿Organisation Name,WorkSheetName,TableID,MainCode,RowNumber,SubCode,Value number,Extra\r\nOrg B,TAC08 Op Exp,1,A08CY01,1,EXP0140,7,z\r\n".encode())
    files.register(spark)
    found = ingest.clean_lines(spark.read.format(files.NAME).load(folder))
    assert rows(found, "organisation_name", "worksheet_name", "total", "trust_type", "financial_year") == [
        ("Org A", "TAC08, Op Exp", 1234, "NHS_TRUST", "2022/23"), ("Org B", "TAC08 Op Exp", 7, "FOUNDATION_TRUST", "2023/24"),
    ]
    published(folder, "TAC_NHS_trusts.csv", "Org A,TAC08 Op Exp,1,A08CY01,1,EXP0130,1")
    with pytest.raises(Exception, match="no year in the file name"):
        spark.read.format(files.NAME).load(folder).collect()
    assert spark.read.format(files.NAME).load(str(tmp_path / "..")).isEmpty()
