"""Intake of newly published files as a stream that ends when it has caught up.

The file source keeps the files it has seen in its checkpoint, so a run opens new files alone. A micro-batch is a list of file names:
the source reads names, not contents, and each batch is handed to the readers, which know the headers of all years. Promotion is an
upsert, so a batch that is repeated after a crash leaves the same facts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provfin.operators import ingest, merge
from provfin.refdata import FILE_EXCLUDE, FILE_GLOB
from provfin.sources import readers, sinks

_LISTING = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def new_files(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the paths of published files; contents are not read."""
    listed = spark.readStream.schema(_LISTING).format("binaryFile")
    listed = listed.option("pathGlobFilter", FILE_GLOB).option("maxFilesPerTrigger", files_per_batch)
    return listed.load(folder).select("path").filter(~F.lower("path").contains(FILE_EXCLUDE))


def each_batch(files: DataFrame, checkpoint: str, load: Callable[[list[str], int], None]) -> int:
    """Calls ``load`` with the paths of every new batch until there are no more; returns how many files were new."""
    seen = 0

    def run(batch: DataFrame, number: int) -> None:
        nonlocal seen
        paths = sorted(row.path for row in batch.collect())  # bounded by the files of a batch
        if paths:
            load(paths, number)
            seen += len(paths)

    query = files.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(run).start()
    query.awaitTermination()
    return seen


def promote_new(
    spark: SparkSession, folder: str, providers: DataFrame, fact_path: str, checkpoint: str, files_per_batch: int = 1000
) -> int:
    """Promotes the lines of files not seen before into the facts at ``fact_path``; returns how many files there were."""

    def load(paths: list[str], number: int) -> None:
        lines = ingest.clean_lines(readers.read_lines(spark, paths))
        sinks.promote_into(fact_path, merge.promote_lines(lines, providers))

    return each_batch(new_files(spark, folder, files_per_batch), checkpoint, load)
