"""Times the headline queries and prints one JSON line.

Settings: BENCH_SF_DIR (tables, default sf0.1), BENCH_CPUS (local cores, default 8), BENCH_RUNS (timed runs per
query after one warm-up, default 3; the median counts; once the whole has taken BENCH_SECONDS, default 300, one run each). The two report sets are written as CSV files.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from statistics import median

from provfin import refdata
from provfin.functions.session import local_session
from provfin.plans import extracts
from provfin.registry.queries import queries
from provfin.sources import fixture, sinks

HEADLINES = [
    "stg_tac_clean", "fact_promote", "dim_trust_build", "preload_audit",
    "income_expenditure", "expenditure_breakdown", "workforce", "kpis", "scorecard",
    "yoy_ebitda", "sector_benchmarks_median", "income_detail", "expenditure_detail", "sector_benchmarks",
    "national_trend", "sector_kpis", "regional_growth", "ebitda_distribution", "top_income", "worst_net_margin",
    "pay_trend", "drugs_cost", "negligence_national", "finance_position",
    "size_bands", "trust_type_compare", "pay_pressure", "regional_health", "cost_per_wte", "private_income",
    "negligence_sector", "ebitda_movers", "sickness_cost", "rd_education_income",
    "val_q1", "val_q10", "audit_report", "m_core", "m_yoy", "m_rag", "m_labels",
]


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def written(build, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    frames = build(fixture.facts(spark, sf_dir), fixture.dim_trust(spark, sf_dir, seen=True), refdata.dim_subcode(spark), refdata.dim_financial_year(spark))
    with tempfile.TemporaryDirectory() as folder:
        sinks.write_extracts(frames, folder, extracts.ROW_ORDER, extracts.DEFAULT_ORDER)
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, memory="12g", partitions=int(cores) if cores.isdigit() else 8)
    named = queries()
    seconds, limit, began = {}, float(os.environ.get("BENCH_SECONDS", "300")), time.perf_counter()

    def repeated(once) -> float:
        return round(median(once() for _ in range(runs if time.perf_counter() - began < limit else 1)), 3)

    for key in HEADLINES:
        timed(named[key], spark, sf_dir)
        seconds[key] = repeated(lambda q=named[key]: timed(q, spark, sf_dir))
    for key, build in (("report_set", extracts.report_set), ("enriched_set", extracts.enriched_set)):
        seconds[key] = repeated(lambda b=build: written(b, spark, sf_dir))
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    settings = {"master": f"local[{cores}]", "spark": spark.version, "shuffle_partitions": cores, "warm": True}
    print(
        json.dumps(
            {"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": float(sf), "settings": settings}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
