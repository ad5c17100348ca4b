"""A streaming source of the ledger's failed files.

An offset is the number of a manifest of the ledger. A batch offers the failed files
among the open entries of the newest manifest, which lie apart from the others; a
load that ends them, or fails them again, makes the next number. So a stream offers
a failed file once per run until it has come right, and no file while the ledger
stands still.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from stratafold import fixed_values as fv
from stratafold.sources.array_files import file_system

FORMAT = "ledger_failed_files"
OFFSET = "ledger"


@dataclass
class OpenFolder(InputPartition):
    """The open entries of one day, as one write left them; nothing for an empty batch."""

    day: str | None = None
    folder: str | None = None


class FailedFileReader(DataSourceStreamReader):
    def __init__(self, ledger: str):
        self.ledger = ledger

    def _newest(self, base: str, store: fs.FileSystem) -> tuple[int, str | None]:
        found = store.get_file_info(fs.FileSelector(f"{base}/manifests", allow_not_found=True))
        numbers = {int(f.base_name.removesuffix(".json")): f.path for f in found if f.base_name[:1].isdigit() and f.base_name.endswith(".json")}
        return (max(numbers), numbers[max(numbers)]) if numbers else (0, None)

    def initialOffset(self) -> dict:
        return {OFFSET: 0}

    def latestOffset(self) -> dict:
        store, base = file_system(self.ledger)
        return {OFFSET: self._newest(base, store)[0]}

    def partitions(self, start: dict, end: dict) -> list[OpenFolder]:
        store, base = file_system(self.ledger)
        path = self._newest(base, store)[1]
        if path is None:
            return [OpenFolder()]
        with store.open_input_stream(path) as stream:
            apart = json.loads(stream.read()).get("apart", {})
        return [OpenFolder(day, folder) for day, folders in sorted(apart.items()) for folder in folders] or [OpenFolder()]

    def read(self, partition: OpenFolder) -> Iterator[tuple[str, dt.date]]:
        if partition.folder is None:
            return
        store, base = file_system(self.ledger)
        day = dt.date.fromisoformat(partition.day)
        for info in store.get_file_info(fs.FileSelector(f"{base}/data/{partition.folder}")):
            if info.base_name.endswith(".parquet"):
                with store.open_input_file(info.path) as file:
                    for batch in pq.ParquetFile(file).iter_batches(columns=["gcs_path", "status"]):
                        for row in batch.to_pylist():
                            if row["status"] == fv.LEDGER_FAILED:
                                yield row["gcs_path"], day


class FailedFiles(DataSource):
    """Option ``ledger``: the folder of the ledger's table."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "gcs_path string, fecha_archivo date"

    def streamReader(self, schema: StructType) -> FailedFileReader:
        return FailedFileReader(self.options["ledger"])
