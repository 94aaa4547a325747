"""Published account files as a data source: planning lists the files once, executors open them.

A partition is a bundle of whole files of about one size. The task that reads a file reads its header too, whichever generation it is of,
and tells year and type from the file's name once; lines then carry both as columns. Planning never opens a file.
"""

from __future__ import annotations

import csv
import fnmatch
import re
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from provfin.operators.ingest import CORRUPT
from provfin.refdata import FILE_EXCLUDE, FILE_GLOB, FILE_YEAR_PATTERN, LINE_HEADERS

NAME = "account_files"
#: Bytes of files that one task reads, unless a file alone has more.
BUNDLE_BYTES = 32 << 20
COLUMNS = [*(known[0] for known in LINE_HEADERS.values()), CORRUPT, "source_file", "trust_type", "financial_year"]


class Bundle(InputPartition):
    """Paths of files, and the names they are known by."""

    def __init__(self, files: list[tuple[str, str]]):
        self.files = files


class AccountFiles(DataSource):
    """``spark.read.format("account_files").load(folder)``: CSV files whose names follow the publisher's pattern."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return ", ".join(f"`{c}` STRING" for c in COLUMNS)

    def reader(self, schema) -> DataSourceReader:
        return AccountReader(self.options["path"], int(self.options.get("bundle_bytes", BUNDLE_BYTES)))


class AccountReader(DataSourceReader):
    def __init__(self, folder: str, bundle_bytes: int):
        self.folder, self.bundle_bytes = folder, bundle_bytes

    def _files(self):
        """The file system of the folder, and the folder as it knows it."""
        from pyarrow import fs

        if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:", self.folder):
            return fs.FileSystem.from_uri(self.folder.replace("file:/", "file:///", 1) if re.match("file:/[^/]", self.folder) else self.folder)
        return fs.LocalFileSystem(), self.folder

    def partitions(self) -> list[Bundle]:
        from pyarrow import fs

        files, folder = self._files()
        found = [f for f in files.get_file_info(fs.FileSelector(folder)) if f.is_file and fnmatch.fnmatchcase(f.base_name, FILE_GLOB)]
        wanted = sorted((f for f in found if FILE_EXCLUDE not in f.base_name.lower()), key=lambda f: f.path)
        bundles, size = [], self.bundle_bytes
        for file in wanted:
            if size + file.size > self.bundle_bytes:
                bundles.append([])
                size = 0
            bundles[-1].append((file.path, file.base_name))
            size += file.size
        return [Bundle(b) for b in bundles] or [Bundle([])]

    def read(self, partition: Bundle) -> Iterator:
        files, _ = self._files()
        for path, name in partition.files:
            yield from self._lines(files, path, name)

    def _lines(self, files, path: str, name: str) -> Iterator:
        import pyarrow as pa
        from pyarrow import csv as table

        year = re.search(FILE_YEAR_PATTERN, name)
        if year is None:
            raise ValueError(f"no year in the file name {name}")
        fixed = {"source_file": name, "trust_type": "FOUNDATION_TRUST" if "foundation" in name.lower() else "NHS_TRUST", "financial_year": year[0].replace("-", "/")}
        with files.open_input_stream(path) as stream:
            header = next(csv.reader([pa.PythonFile(stream).read(1 << 16).decode("utf-8-sig", "replace").split("\n", 1)[0].rstrip("\r")]), [])
        missing = [known[0] for known in LINE_HEADERS.values() if not set(known) & set(header)]
        if missing:
            raise ValueError(f"none of the known headers stands for {missing} in {name}")
        odd: list[str] = []

        def malformed(row) -> str:
            odd.append(row.text)
            return "skip"

        def batch(columns: dict, rows: int):
            arrays = [columns.get(c, pa.array([fixed.get(c)] * rows, pa.string())) for c in COLUMNS]
            return pa.RecordBatch.from_arrays(arrays, COLUMNS)

        with files.open_input_stream(path) as stream:
            reader = table.open_csv(
                stream,
                table.ReadOptions(use_threads=False, block_size=1 << 20),
                table.ParseOptions(invalid_row_handler=malformed),
                table.ConvertOptions(column_types=dict.fromkeys(header, pa.string()), null_values=[""], strings_can_be_null=True),
            )
            for part in reader:
                named = dict(zip((n.removeprefix("﻿") for n in part.schema.names), part.columns))
                yield batch({known[0]: named[next(k for k in known if k in named)] for known in LINE_HEADERS.values()}, part.num_rows)
                if odd:
                    yield batch({CORRUPT: pa.array(odd, pa.string())}, len(odd))
                    odd.clear()
        if odd:
            yield batch({CORRUPT: pa.array(odd, pa.string())}, len(odd))


def register(spark: SparkSession) -> None:
    """Makes the source known to a session; its code travels with the query, workers need not import this library."""
    import provfin.sources.files as own

    cloudpickle.register_pickle_by_value(own)
    spark.dataSource.register(AccountFiles)
