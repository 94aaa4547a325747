"""Readers of the published extracts (CSV or Parquet copies of the two sheets)."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from provfin.operators.ingest import CORRUPT, resolve_headers
from provfin.refdata import FILE_EXCLUDE, FILE_GLOB, LINE_HEADERS, PROVIDER_HEADERS


def discover(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the extracts in a folder, sorted; only the listing is read, not the content."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", FILE_GLOB).load(folder).select("path")
    wanted = listing.filter(~F.lower("path").contains(FILE_EXCLUDE)).orderBy("path")
    return [row.path for row in wanted.collect()]


def _header(spark: SparkSession, path: str) -> str:
    """First line of a text file, wherever it lies; no job is run for it."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).open(where)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return (reader.readLine() or "").removeprefix("\ufeff")
    finally:
        reader.close()


def _groups(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """One frame for each header that the files have, however many files share it. Columns are text by declaration, not inferred."""
    by_header: dict[tuple[str, ...], list[str]] = {}
    columnar = [p for p in paths if p.lower().endswith(".parquet")]
    for path in paths:
        if path not in columnar:
            by_header.setdefault(tuple(next(csv.reader([_header(spark, path)]), [])), []).append(path)
    frames = []
    for header, files in by_header.items():
        schema = StructType([StructField(name, StringType()) for name in (*header, CORRUPT)])
        # rows that do not fit their header are only seen by a parser that cuts them into all columns
        told = {"header": True, "columnNameOfCorruptRecord": CORRUPT, "columnPruning": False}
        frames.append(spark.read.schema(schema).options(**told).csv(files))
    if columnar:
        frames.append(spark.read.option("mergeSchema", True).parquet(*columnar))
    return [f.select("*", F.col("_metadata.file_name").alias("source_file")) for f in frames]


def _read_all(spark: SparkSession, paths: list[str], headers: dict, optional: tuple[str, ...] = ()) -> DataFrame:
    """All extracts, whose headers differ by year, as one frame under canonical published headers: a branch for each header."""
    if not paths:
        raise ValueError("No extracts found")
    frames = [
        resolve_headers(frame, headers, optional, kept=tuple(c for c in (CORRUPT,) if c in frame.columns)) for frame in _groups(spark, paths)
    ]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    published = {name: known[0] for name, known in headers.items() if name in merged.columns}
    return merged.withColumnsRenamed(published)


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Account lines for ``operators.ingest.clean_lines``; CSV rows that do not fit their header are told in a column of their own."""
    return _read_all(spark, paths, LINE_HEADERS)


def read_providers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Provider lists for ``operators.ingest.clean_providers``."""
    return _read_all(spark, paths, PROVIDER_HEADERS, ("region", "sector", "comments"))
