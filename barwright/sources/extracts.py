"""Landed vendor extracts as a data source of their own, for batches and streams.

A vendor lands Parquet files in a folder that all executors share, whole and under names that sort in
the order of landing. Each file is a partition, read in its executor as Arrow batches. A read that fails
is tried again from the batch it had come to, so a short fault of the store costs one file a moment and not
the job. A stream's offset is the name of the last file it has seen: a restarted one goes on after that.

    spark.dataSource.register(LandedExtracts)
    spark.read.format("landed_extracts").option("path", folder).load()
    spark.readStream.format("landed_extracts").option("path", folder).load()

Options: ``path``; ``attempts`` for each file (3); ``batchRows`` of an Arrow batch (8192); for streams
``filesPerBatch``, the most files of a micro-batch that :func:`latestOffset` offers at once (all).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, InputPartition,
)
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

PAUSE = 0.2


def store_of(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system that a path or URI names, and the path there."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pafs.LocalFileSystem(), path


def landed_files(path: str) -> list[str]:
    """Names of the files in the folder, in order. Hidden and unfinished ones do not count."""
    store, folder = store_of(path)
    found = store.get_file_info(pafs.FileSelector(folder))
    return sorted(f.base_name for f in found if f.type == pafs.FileType.File
                  and f.base_name.endswith(".parquet") and f.base_name[0] not in "._")


def open_file(path: str, name: str) -> pq.ParquetFile:
    store, folder = store_of(path)
    return pq.ParquetFile(store.open_input_file(f"{folder.rstrip('/')}/{name}"),
                          coerce_int96_timestamp_unit="us")


def batches_of(open_: Callable[[], pq.ParquetFile], schema: pa.Schema, attempts: int,
               rows: int) -> Iterator[pa.RecordBatch]:
    """The batches of a file. After a failure the file is opened again and goes on where it was."""
    given = failures = 0
    while True:
        try:
            for n, batch in enumerate(open_().iter_batches(rows, columns=schema.names)):
                if n >= given:
                    given, failures = n + 1, 0
                    yield batch.select(schema.names).cast(schema)
            return
        except (OSError, pa.ArrowInvalid):
            failures += 1
            if failures >= attempts:
                raise
            time.sleep(PAUSE * failures)


class Extract(InputPartition):
    """One landed file."""

    def __init__(self, name: str):
        super().__init__(name)


class _Files:
    """What readers of batches and of streams do alike."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.path = options["path"]
        self.attempts = int(options.get("attempts", 3))
        self.rows = int(options.get("batchRows", 8192))
        self.most = int(options.get("filesPerBatch", 0))
        self.wanted = schema

    def read(self, partition: Extract) -> Iterator[pa.RecordBatch]:
        return batches_of(lambda: open_file(self.path, partition.value),
                          to_arrow_schema(self.wanted), self.attempts, self.rows)


class ExtractReader(_Files, DataSourceReader):
    def partitions(self) -> list[Extract]:
        return [Extract(name) for name in landed_files(self.path)]


class ExtractStreamReader(_Files, DataSourceStreamReader):
    """Offsets are names of files: everything up to and with that one has been seen."""

    def __init__(self, options: dict[str, str], schema: StructType):
        super().__init__(options, schema)
        self.offered = ""

    def initialOffset(self) -> dict[str, Any]:
        return {"file": ""}

    def latestOffset(self) -> dict[str, Any]:
        later = [name for name in landed_files(self.path) if name > self.offered]
        if later:
            self.offered = later[:self.most][-1] if self.most else later[-1]
        return {"file": self.offered}

    def partitions(self, start: dict[str, Any], end: dict[str, Any]) -> list[Extract]:
        self.offered = max(self.offered, end["file"])
        return [Extract(name) for name in landed_files(self.path) if start["file"] < name <= end["file"]]

    def commit(self, end: dict[str, Any]) -> None:
        """Files stay: what is landed is the vendor's."""


class LandedExtracts(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_extracts"

    def schema(self) -> StructType:
        """That of the first file."""
        names = landed_files(self.options["path"])
        if not names:
            raise FileNotFoundError(f"no extract has landed in {self.options['path']}")
        return from_arrow_schema(open_file(self.options["path"], names[0]).schema_arrow,
                                 prefer_timestamp_ntz=True)

    def reader(self, schema: StructType) -> DataSourceReader:
        return ExtractReader(dict(self.options), schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return ExtractStreamReader(dict(self.options), schema)
