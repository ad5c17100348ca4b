"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.llm.shared import Stages


def _mark(links: DataFrame) -> tuple:
    """A digest that two equal sets of links share."""
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(links: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the least of its neighbourhood."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(least, "u")
    down = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return down.unionByName(own).where("u <> v").distinct()


def components(links: DataFrame, stages: Stages) -> DataFrame:
    """(node, root) for every node with a link; root is the component's least node.

    ``links`` has long columns ``a`` and ``b``; order, repeats and self-links do not
    matter, nulls are no nodes. Each round is written to the shared folder. A star's
    centre may have any number of leaves: minima are aggregated before the shuffle
    and the join back has one row per node on its small side.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, path = stages.at(pairs, "links")
    mark = _mark(now)
    while mark[0]:
        grown, new_path = stages.at(_small_star(_large_star(now)), "links")
        new_mark = _mark(grown)
        stages.drop(path)
        now, path = grown, new_path
        if new_mark == mark:
            break
        mark = new_mark
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return leaves.unionByName(roots)
