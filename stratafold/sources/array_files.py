"""One JSON array file per path, written and put in place by the tasks.

A data source for writing: rows (path, value), sorted by path within a task, where
all rows of a path are in one task. Elements are streamed into a draft, so no file
is ever held whole; a finished draft takes its place in one step, or on object
stores appears when it is closed. A task that is repeated replaces its files by
equal ones. Drafts lie in one folder of the job's own, which the commit or the abort
removes, so the driver does one step however many files there are.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "array_files"
# Stores where a file appears whole once it is closed, and a rename would copy it.
OBJECT_STORES = (fs.S3FileSystem, fs.GcsFileSystem, *((fs.AzureFileSystem,) if hasattr(fs, "AzureFileSystem") else ()))


def file_system(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder as tasks reach it, and the folder's path there."""
    local = re.match(r"(?:file:)?/+(.*)", root)
    if local:
        return fs.LocalFileSystem(), "/" + local.group(1)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", root))


@dataclass
class Written(WriterCommitMessage):
    files: int
    elements: int


class _Draft:
    """A file being written, and the step that puts it in place."""

    def __init__(self, store: fs.FileSystem, drafts: str, target: str):
        self.store, self.target, self.elements = store, target, 0
        store.create_dir(target.rsplit("/", 1)[0], recursive=True)
        self.path = target if isinstance(store, OBJECT_STORES) else f"{drafts}/{uuid.uuid4().hex}"
        self.stream = store.open_output_stream(self.path)

    def add(self, element: bytes) -> None:
        self.stream.write(b",\n" if self.elements else b"[")
        self.stream.write(element)
        self.elements += 1

    def place(self) -> None:
        self.stream.write(b"]")
        self.stream.close()
        if self.path == self.target:
            return
        if not isinstance(self.store, fs.LocalFileSystem) and self.store.get_file_info(self.target).type != fs.FileType.NotFound:
            self.store.delete_file(self.target)  # a rename there does not replace
        self.store.move(self.path, self.target)


class ArrayFileWriter(DataSourceArrowWriter):
    def __init__(self, root: str, drafts: str):
        self.root, self.drafts = root, drafts

    def _drafts(self) -> tuple[fs.FileSystem, str, str]:
        store, base = file_system(self.root)
        return store, base, f"{base}/{self.drafts}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base, drafts = self._drafts()
        if not isinstance(store, OBJECT_STORES):
            store.create_dir(drafts, recursive=True)
        now, files, elements = None, 0, 0
        for batch in iterator:
            for path, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if now is None or path != now[0]:
                    if now:
                        now[1].place()
                    now = path, _Draft(store, drafts, f"{base}/{path}")
                    files += 1
                now[1].add(value)
                elements += 1
        if now:
            now[1].place()
        return Written(files, elements)

    def _clear(self) -> None:
        store, _, drafts = self._drafts()
        if store.get_file_info(drafts).type == fs.FileType.Directory:
            store.delete_dir(drafts)

    def commit(self, messages: list[Written | None]) -> None:
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        """Files already in place are whole and stay; a repeat replaces them."""
        self._clear()


class ArrayFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, value string"

    def writer(self, schema: StructType, overwrite: bool) -> ArrayFileWriter:
        return ArrayFileWriter(self.options["root"], f"_drafts-{uuid.uuid4().hex}")


def write_array_files(rows: DataFrame, root: str) -> None:
    """Rows (path below ``root``, value: JSON text of one element) to one array file per path.

    The rows of a path meet in one task, which streams them; the sort that brings
    them together spills. A path without rows keeps its file.
    """
    rows.sparkSession.dataSource.register(ArrayFiles)
    dealt = rows.select("path", "value").repartition("path").sortWithinPartitions("path")
    dealt.write.format(FORMAT).mode("append").option("root", root).save()
