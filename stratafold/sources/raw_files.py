"""The raw layer: reading files and landing new ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold import fixed_values as fv
from stratafold.functions import paths
from stratafold.session import share_listing
from stratafold.sources.array_files import write_array_files
from stratafold.sources.listing import ARRAY, LINES


def array_schema(fields: Mapping[str, str]) -> str:
    return "array<struct<" + ",".join(f"`{name}`:{kind}" for name, kind in fields.items()) + ">>"


NO_ARRAY = "not a JSON array"
MALFORMED = "malformed JSON or an element that is not an object"
BLANKS = " \t\r\n"


def blank_trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def file_fault(text: Column, items: Column) -> Column:
    """Why a file as a whole is unusable, or NULL."""
    return (
        F.when(~F.coalesce(blank_trimmed(text).startswith("["), F.lit(False)), F.lit(NO_ARRAY))
        .when(items.isNull() | ~blank_trimmed(text).endswith("]"), F.lit(MALFORMED))
        .when(F.exists(items, lambda x: x.isNull()), F.lit("an element that is not an object"))
    )


def read_items(
    spark: SparkSession,
    files: str | Sequence[str],
    fields: Mapping[str, str],
    layout: str = ARRAY,
    *,
    streaming: bool = False,
    files_per_batch: int = 10_000,
) -> DataFrame:
    """One row per array element, as a struct of the fields named ``item``.

    A file that is unusable as a whole, and an empty array, give one row with a
    NULL item, so that every file shows up in the result. Only the named fields
    are taken out of the text.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch) if streaming else spark.read
    reader = reader.format("text").option("wholetext", str(layout == ARRAY).lower())
    # a stream takes one folder or glob, a batch read any number of paths
    share_listing(spark)
    lines = reader.load(files if isinstance(files, str) or streaming else list(files))
    parts = F.col("parts")
    named = lines.select(paths.uri_parts(F.col("_metadata.file_path")).alias("parts"), "value").select(
        paths.file_key(parts).alias("gcs_path"),
        paths.part_account(parts).alias("account_id"),
        paths.part_day(parts).alias("fecha_archivo"),
        "value",
    )
    return open_items(named, fields, layout)


def open_items(texts: DataFrame, fields: Mapping[str, str], layout: str = LINES) -> DataFrame:
    """Rows with JSON text in ``value`` to one row per item, other columns kept."""
    others = [c for c in texts.columns if c != "value"]
    # a line is read as an array of its own, so both layouts follow one rule
    text = F.col("value") if layout == ARRAY else F.concat(F.lit("["), F.col("value"), F.lit("]"))
    parsed = texts.select(*others, text.alias("text")).withColumn("items", F.from_json("text", array_schema(fields)))
    judged = parsed.select(*others, file_fault(F.col("text"), F.col("items")).alias("file_fault"), "items")
    usable = F.when(F.col("file_fault").isNull(), F.col("items"))
    return judged.select(*others, "file_fault", F.explode_outer(usable).alias("item"))


def land_items(items: DataFrame, root: str) -> None:
    """Write rows (source, tipo, id, fecha, item) to the raw layer as JSON lines.

    A rerun for the same account and day replaces what it wrote before; an
    account without rows writes nothing. A large account is split into several
    files of similar size.
    """
    lines = items.select(
        F.lower("source").alias("source"), "tipo", "id", F.date_format("fecha", "yyyy-MM-dd").alias("fecha"),
        F.to_json("item").alias("value"),
    )
    (
        lines.hint("rebalance", "source", "tipo", "fecha", "id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source", "tipo", "fecha", "id")
        .text(f"{root}/raw")
    )


def land_arrays(items: DataFrame, root: str) -> None:
    """Write rows (source, tipo, id, fecha, item) as one JSON array file per account and day.

    The layout puts an account's day into one file, which one task streams;
    ``land_items`` has no such limit. Tasks put their files in place themselves, each
    in one step, and a rerun replaces them.
    """
    day = F.date_format("fecha", "yyyy-MM-dd")
    path = F.concat_ws("/", F.lit("raw"), F.lower("source"), "tipo", "id", day, F.lit(fv.RAW_FILE_NAME))
    write_array_files(items.select(path.alias("path"), F.to_json("item").alias("value")), root)
