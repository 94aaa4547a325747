"""Refresh by change: after an upsert only the organisation-years it touched are derived again.

The touched keys are a small frame of organisation and year. Their years become a filter on the fact's partition column, so other
years are not read at all, and the keys themselves a semi-join below the scorecard's aggregation. What is derived replaces the same
organisation-years of the stored scorecard, year by year.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.functions.session import hadoop_path, materialise
from provfin.operators.merge import FACT_KEY
from provfin.operators.pivot import KEYS
from provfin.plans import views
from provfin.plans.views import TRUST
from provfin.sources.sinks import PARTITIONS, read_table, replace_partitions


def touched(incoming: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The organisation-years an upsert changes; with the facts it meets, lines that leave their total as it is do not count."""
    lines = incoming.select(*FACT_KEY, "total_000s")
    if existing is not None:
        lines = lines.join(existing.select(*FACT_KEY, "total_000s"), [*FACT_KEY, "total_000s"], "left_anti")
    return lines.select(*KEYS).distinct()


def touched_by_trusts(fact: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """The organisation-years whose organisation has appeared, gone, or got other attributes."""
    sides = [side.select(*TRUST, F.lit(i).alias("side")) for i, side in enumerate((before, after))]
    changed = sides[0].unionByName(sides[1]).groupBy(*TRUST).agg(F.count(F.lit(1)).alias("n")).where("n = 1")
    return fact.join(changed.select("org_code").distinct(), "org_code", "left_semi").select(*KEYS).distinct()


def years_of(keys: DataFrame) -> list[str]:
    """The financial years among the keys; there are as many as years have been published."""
    return sorted(row[0] for row in keys.select("financial_year").distinct().collect())


def scorecard_of(fact: DataFrame, keys: DataFrame, years: list[str], dim_trust: DataFrame, dim_subcode: DataFrame) -> DataFrame:
    """The scorecard of the given organisation-years alone; ``years`` has all years of the keys."""
    lines = fact.filter(F.col("financial_year").isin(years)).join(keys, KEYS, "left_semi")
    return views.scorecard(lines, dim_trust, dim_subcode)


def refresh_into(path: str, fact: DataFrame, keys: list[DataFrame], dim_trust: DataFrame, dim_subcode: DataFrame) -> list[str]:
    """Brings the stored scorecard at ``path`` up to date with the facts for the touched keys; returns the years it rewrote.

    Without a stored scorecard all of it is derived. Refreshing twice with the same keys changes nothing.
    """
    spark = fact.sparkSession
    stored = read_table(spark, path)
    if stored is None:
        replace_partitions(views.scorecard(fact, dim_trust, dim_subcode), path)
        return years_of(fact.select("financial_year"))
    keys = materialise(reduce(DataFrame.unionByName, keys).distinct())
    years = years_of(keys)
    if not years:
        return []
    fresh = scorecard_of(fact, keys, years, dim_trust, dim_subcode)
    old = stored.filter(F.col("financial_year").isin(years))
    merged = materialise(old.join(keys, KEYS, "left_anti").unionByName(fresh))
    emptied = old.select(*PARTITIONS).distinct().exceptAll(merged.select(*PARTITIONS).distinct()).collect()
    replace_partitions(merged, path)
    for row in emptied:  # no organisation is left there, so nothing has replaced the partition
        _drop_partition(spark, path, row)
    return years


def _drop_partition(spark, path: str, row) -> None:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    files, where = hadoop_path(spark, "/".join([path, *(f"{name}={escape(row[name])}" for name in PARTITIONS)]))
    files.delete(where, True)
