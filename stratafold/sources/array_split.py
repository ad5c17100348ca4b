"""One large JSON array read by many tasks.

The file is read as segments that end at a closing brace, which Spark's text reader
finds within byte ranges of its own choice. Quotes and brackets are counted in each
segment; prefix sums over a file's ranges, first within each range and then over
the ranges' totals, say for every segment whether it begins inside a string and how
deep it lies. An element ends where the depth is back to one, so segments between
two ends are the text of one element, and only those are brought together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratafold.functions import paths
from stratafold.plans.lake import Staging
from stratafold.sources.raw_files import MALFORMED, NO_ARRAY, array_schema, blank_trimmed, file_fault

# An element beyond this size fails its file instead of being put together.
MAX_ELEMENT = 64 * 1024 * 1024
TOO_LARGE = f"an element of more than {MAX_ELEMENT} bytes"


def _steps(pieces: Column, parity: int) -> Column:
    """How much deeper one is behind the pieces of even or odd number, the text outside strings."""
    outside = F.array_join(F.filter(pieces, lambda _, i: i % 2 == parity), "")
    opened = F.length(outside) - F.length(F.translate(outside, "{[", ""))
    return (opened - (F.length(outside) - F.length(F.translate(outside, "]", "")))).cast("long")


def segments(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """file, block (start of the byte range), at (order there), value, and its counts."""
    read = spark.read.format("text").option("lineSep", "}").load(list(files))
    cut = read.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value",
    )
    pieces = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    counted = cut.withColumn("pieces", pieces)
    return counted.select(
        "file", "block", "at", "value", (F.size("pieces") - 1).cast("long").alias("quotes"),
        _steps(F.col("pieces"), 0).alias("outer"), _steps(F.col("pieces"), 1).alias("inner"),
    )


def _running(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds the sum of ``value`` over all earlier segments of the file."""
    earlier = W.partitionBy("file", "block").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    blocks = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    totals = rows.groupBy("file", "block").agg(F.sum(value).alias("total"))
    offsets = totals.select("file", "block", F.coalesce(F.sum("total").over(blocks), F.lit(0)).alias("offset"))
    local = rows.withColumn(name, F.coalesce(F.sum(value).over(earlier), F.lit(0)))
    return local.join(offsets, ["file", "block"]).withColumn(name, F.col(name) + F.col("offset")).drop("offset")


def elements(parts: DataFrame, stage: Staging) -> DataFrame:
    """file, number, ended, text: each element with the separator before it, and what follows the last.

    ``parts`` is a written table. The prefix sums run over its counts alone, each
    written once; the texts are moved when it is known what belongs together. A text too
    large to put together is NULL.
    """
    place = ["file", "block", "at"]
    counts = parts.select(*place, "quotes", "outer", "inner", (F.octet_length("value") + 1).cast("long").alias("bytes"))
    quoted = stage.write(_running(counts, "quotes_before", F.col("quotes")), "quotes")
    # the brace that ends a segment counts unless it lies in a string
    closing = (F.col("quotes_before") + F.col("quotes")) % 2 == 0
    change = F.when(F.col("quotes_before") % 2 == 0, F.col("outer")).otherwise(F.col("inner")) - closing.cast("long")
    marked = quoted.select(*place, "bytes", closing.alias("closing"), change.alias("change"))
    deep = stage.write(_running(marked, "depth", F.col("change")), "depths")
    ends = (F.col("closing") & (F.col("depth") + F.col("change") == 1)).cast("long")
    ended = deep.select(*place, "bytes", ends.alias("ends"))
    placed = stage.write(_running(ended, "number", F.col("ends")), "numbers")
    sizes = placed.groupBy("file", "number").agg(F.sum("bytes").alias("bytes"), (F.max("ends") == 1).alias("ended"))
    large = sizes.where(F.col("bytes") > MAX_ELEMENT).select("file", "number", "ended")
    small = placed.join(large, ["file", "number"], "left_anti").join(parts.select(*place, "value"), place)
    joined = small.groupBy("file", "number").agg(
        (F.max("ends") == 1).alias("ended"), F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("parts")
    )
    text = F.array_join(F.col("parts")["value"], "}")
    whole = joined.select("file", "number", "ended", F.when(F.col("ended"), F.concat(text, F.lit("}"))).otherwise(text).alias("text"))
    return whole.unionByName(large.withColumn("text", F.lit(None).cast("string")))


def _judged(found: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Each element's text as an array of its own: its items and what fails the file."""
    first = F.col("number") == 0
    trimmed = blank_trimmed(F.col("text"))
    lead, rest = F.substring(trimmed, 1, 1), F.substr(trimmed, F.lit(2))
    array = (
        F.when(F.col("ended"), F.concat(F.lit("["), rest, F.lit("]")))
        .when(first, trimmed)
        .when(lead == ",", F.concat(F.lit("["), rest))
        .otherwise(F.lit("[]"))
    )
    parsed = found.select("*", trimmed.alias("trimmed"), lead.alias("lead"), array.alias("array"))
    parsed = parsed.withColumn("items", F.from_json("array", array_schema(fields)))
    behind = ~F.col("ended") & ~first
    fault = (
        F.when(F.col("text").isNull(), F.lit(TOO_LARGE))
        .when(first & (F.col("lead") != "["), F.lit(NO_ARRAY))
        .when(F.col("ended") & ~first & (F.col("lead") != ","), F.lit(MALFORMED))
        # behind the last object: the bracket and nothing else, or elements that are no objects
        .when(behind & (F.col("lead") == ",") & (F.coalesce(F.size("items"), F.lit(1)) == 0), F.lit(MALFORMED))
        .when(behind & (F.col("lead") != ",") & (F.col("trimmed") != "]"), F.lit(MALFORMED))
        .otherwise(file_fault(F.col("array"), F.col("items")))
    )
    return parsed.select("file", "number", "ended", "items", fault.alias("fault"))


def read_split_items(spark: SparkSession, files: Sequence[str], fields: Mapping[str, str], stage: Staging) -> DataFrame:
    """The rows of ``read_items`` for array files that no task could hold whole.

    A file fails for the same reasons, and for an element beyond ``MAX_ELEMENT``.
    """
    parts = stage.write(segments(spark, files), "segments")
    judged = _judged(stage.write(elements(parts, stage), "elements"), fields)
    # the first reason in the order in which a whole file is judged
    rank = F.when(F.col("fault") == NO_ARRAY, 0).when(F.col("fault") == TOO_LARGE, 1).when(F.col("fault") == MALFORMED, 2).when(F.col("fault").isNotNull(), 3)
    by_file = judged.groupBy("file").agg(
        F.min_by("fault", rank).alias("fault"), F.bool_and("ended").alias("open"),
        F.sum(F.coalesce(F.size("items"), F.lit(0))).alias("n"),
    )
    torn = F.when(F.col("open"), F.lit(MALFORMED))
    verdicts = stage.write(by_file.select("file", F.coalesce("fault", torn).alias("file_fault"), "n"), "verdicts")
    bare = verdicts.where("file_fault IS NOT NULL OR n = 0")
    good = judged.join(bare, "file", "left_anti").select("file", F.lit(None).cast("string").alias("file_fault"), F.explode("items").alias("item"))
    rows = good.unionByName(bare.select("file", "file_fault", F.lit(None).cast(good.schema["item"].dataType).alias("item")))
    named = rows.withColumn("parts", paths.uri_parts(F.col("file")))
    where = F.col("parts")
    return named.select(
        paths.file_key(where).alias("gcs_path"), paths.part_account(where).alias("account_id"),
        paths.part_day(where).alias("fecha_archivo"), "file_fault", "item",
    )
