"""Listing the raw files of some days: by tasks, one job for all platforms, days and layouts."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold import fixed_values as fv
from stratafold.functions import paths
from stratafold.session import glob_matches, share_listing
from stratafold.sources.array_files import file_system

# Two layouts of the same content. "array": one JSON array per file. "lines":
# one JSON object per line and any number of part files, which Spark can split.
LAYOUTS = ARRAY, LINES = "array", "lines"

FILE_COLUMNS = "gcs_path string, file_path string, account_id string, fecha_archivo date, file_bytes bigint"
# Stores that tasks list themselves; elsewhere Spark's own globbing does it.
LISTED_BY_TASKS = re.compile(r"(/|file:|s3[an]?:|gs:|abfss?:)")


def day_glob(root: str, source: str, kind: str, day: dt.date | str, layout: str = ARRAY) -> str:
    if layout == LINES:
        return f"{root}/raw/source={source.lower()}/tipo={kind}/fecha={day}/id=*/*"
    return f"{root}/raw/{source.lower()}/{kind}/*/{day}/{fv.RAW_FILE_NAME}"


def _described(files: DataFrame, parts: Column, *more: str) -> DataFrame:
    """What the path of each (path, length) says."""
    where = F.col("parts")
    return files.withColumn("parts", parts).select(
        paths.file_key(where).alias("gcs_path"),
        F.col("path").alias("file_path"),
        paths.part_account(where).alias("account_id"),
        paths.part_day(where).alias("fecha_archivo"),
        F.col("length").alias("file_bytes"),
        *more,
    )


def list_files(spark: SparkSession, globs: str | Sequence[str]) -> DataFrame:
    """Files under the globs with what their path says; contents are not read."""
    found = [g for g in ([globs] if isinstance(globs, str) else globs) if glob_matches(spark, g)]
    if not found:
        return spark.createDataFrame([], FILE_COLUMNS)
    share_listing(spark)
    listed = spark.read.format("binaryFile").load(found).withColumn("uri", F.col("_metadata.file_path"))
    return _described(listed, paths.uri_parts(F.col("uri")))


def _hidden(name: str) -> bool:
    return name.startswith((".", "_"))


def _children(store: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return [f for f in found if not _hidden(f.base_name)]


def list_days(
    spark: SparkSession, root: str, kind: str, platforms: Sequence[str], days: Sequence[dt.date], layouts: Sequence[str] = LAYOUTS
) -> DataFrame:
    """The raw files of some days with their platform and layout, as ``list_files`` gives them.

    The driver names the folders in which accounts lie: one per platform for arrays,
    one per platform and day for lines. A first stage lists those; their accounts
    are dealt out, and a second stage looks into each account.
    """
    names = [d.isoformat() for d in sorted(set(days))]
    if not platforms or not names:
        return spark.createDataFrame([], f"{FILE_COLUMNS}, platform string, layout string")
    if not LISTED_BY_TASKS.match(root):
        globbed = [
            list_files(spark, [day_glob(root, p, kind, day, form) for day in names]).withColumns({"platform": F.lit(p), "layout": F.lit(form)})
            for p in platforms for form in layouts
        ]
        return reduce(DataFrame.unionByName, globbed)

    above = [(p, ARRAY, f"raw/{p.lower()}/{kind}") for p in platforms if ARRAY in layouts]
    above += [(p, LINES, f"raw/source={p.lower()}/tipo={kind}/fecha={day}") for p in platforms for day in names if LINES in layouts]
    columns, schema = ["platform", "layout", "folder"], "platform string, layout string, folder string"

    def accounts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(root)
        for batch in batches:
            for platform, layout, folder in zip(*(c.to_pylist() for c in batch.columns)):
                own = [f"{folder}/{f.base_name}" for f in _children(store, f"{base}/{folder}") if f.type == fs.FileType.Directory]
                yield pa.RecordBatch.from_arrays([pa.array([platform] * len(own), pa.string()), pa.array([layout] * len(own), pa.string()), pa.array(own, pa.string())], columns)

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(root)
        for batch in batches:
            rows = []
            for platform, layout, folder in zip(*(c.to_pylist() for c in batch.columns)):
                if layout == LINES:
                    found = _children(store, f"{base}/{folder}")
                else:
                    found = store.get_file_info([f"{base}/{folder}/{day}/{fv.RAW_FILE_NAME}" for day in names])
                rows += [(platform, layout, f"{root}{f.path.removeprefix(base)}", f.size) for f in found if f.type == fs.FileType.File]
            arrays = [pa.array(values, t) for values, t in zip(zip(*rows) if rows else [[]] * 4, [pa.string()] * 3 + [pa.int64()])]
            yield pa.RecordBatch.from_arrays(arrays, ["platform", "layout", "path", "length"])

    named = spark.createDataFrame(above, schema).repartition("platform", "folder")
    dealt = named.mapInArrow(accounts, schema).repartition("platform", "folder")
    found = dealt.mapInArrow(files, "platform string, layout string, path string, length long")
    return _described(found, paths.path_parts(F.col("path")), "platform", "layout")
