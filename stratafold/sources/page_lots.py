"""Landed result pages: ``lot, page, body`` rows, each body one page envelope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold import fixed_values as fv


def read_envelopes(pages: DataFrame) -> DataFrame:
    """Adds ``page_error``, ``next_page`` and ``items`` (array of VARIANT)."""
    body = F.try_parse_json("body")
    opened = pages.withColumn("envelope", body)
    envelope = F.col("envelope")
    is_object = F.coalesce(F.schema_of_variant(envelope).startswith("OBJECT"), F.lit(False))
    fault = F.try_variant_get(envelope, "$.error", "variant")
    data = F.try_variant_get(envelope, "$.data", "variant")
    items = F.try_variant_get(envelope, "$.data", "array<variant>")
    message = F.coalesce(F.try_variant_get(envelope, "$.error.message", "string"), F.lit(fv.UNKNOWN_PAGE_ERROR))
    return opened.select(
        *pages.columns,
        F.when(~is_object, F.lit("page is not a JSON object"))
        .when(fault.isNotNull(), message)
        .when(data.isNotNull() & items.isNull(), F.lit("data is not a list"))
        .alias("page_error"),
        F.try_variant_get(envelope, "$.paging.next", "string").alias("next_page"),
        items.alias("items"),
    )


def opened(pages: DataFrame) -> DataFrame:
    """Pages with their envelopes read, unless they have been read already."""
    return pages if "page_error" in pages.columns else read_envelopes(pages)


def lot_outcomes(pages: DataFrame, lot: Sequence[str] = ("lot",), *, numbered: bool = False) -> DataFrame:
    """Per lot: pages, rows and the first error in page order (NULL when good).

    The lot is bad as a whole if any page is, if a page arrived twice, or if its
    last page names a next one that never arrived; ``numbered`` says that pages
    count up by one, so that a missing page shows in the middle as well. Pages are
    aggregated before they are shuffled and first by page, so a lot with very many
    pages costs no more than any other.
    """
    single = opened(pages).groupBy(*lot, "page").agg(
        F.count("*").alias("times"),
        F.sum(F.coalesce(F.size("items"), F.lit(0))).alias("n_items"),
        F.min("page_error").alias("page_error"),
        F.max("next_page").alias("next_page"),
    )
    bad = F.col("page_error").isNotNull()
    grouped = single.groupBy(*lot).agg(
        F.sum("times").alias("n_pages"),
        F.sum("n_items").alias("n_items"),
        F.min_by("page_error", F.when(bad, F.col("page"))).alias("first_error"),
        F.max("times").alias("times"),
        (F.max("page") - F.min("page") + 1 - F.count("*")).alias("gaps"),
        F.max_by(F.struct("next_page"), "page").alias("last"),
    )
    error = F.coalesce(
        F.col("first_error"),
        F.when(F.col("times") > 1, F.lit("a page arrived twice")),
        F.when(F.lit(numbered) & (F.col("gaps") > 0), F.lit("a page is missing")),
        F.when(F.col("last.next_page").isNotNull(), F.lit("last page is missing")),
    )
    return grouped.select(
        *lot, "n_pages", F.when(error.isNull(), F.col("n_items")).otherwise(F.lit(0)).alias("n_rows"), error.alias("error")
    )


def flatten_pages(pages: DataFrame, outcomes: DataFrame, lot: Sequence[str] = ("lot",)) -> DataFrame:
    """All ``data`` elements of the good lots: lot, page, position, item."""
    bad_lots = outcomes.where("error IS NOT NULL").select(*lot)
    good = opened(pages).join(bad_lots, list(lot), "left_anti")
    return good.select(*lot, "page", F.posexplode("items").alias("position", "item"))
