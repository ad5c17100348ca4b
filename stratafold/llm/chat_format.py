"""Chat formatting: cumulative snapshots collapse into the longest conversation.

Logs often hold a conversation once after every turn. A conversation that is a
prefix of another one is dropped before rendering. Each turn's hash covers its
position, role and text; their running sums are the rolling hashes of all
prefixes. Sums are taken within blocks of turns and over the blocks, so a long
conversation is not one task's work, and no conversation is gathered whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratafold.llm.shared import Stages

HALVES = ("h0", "h1", "h2", "h3")


@dataclass(frozen=True)
class ChatRule:
    """Turn numbers are dealt into blocks of ``block``; text comes in parts of ``part`` turns."""

    block: int = 1024
    part: int = 1024
    opening: str = "<|im_start|>"
    closing: str = "<|im_end|>"


def _positions(conversations: DataFrame, rule: ChatRule) -> DataFrame:
    """(conv_id, position, role, text, block): turns numbered from 1 in order, repeats once."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
    turns = turns.where("conv_id IS NOT NULL AND turn IS NOT NULL").distinct()
    turns = turns.withColumn("block", F.floor(F.col("turn") / rule.block))
    within = F.row_number().over(W.partitionBy("conv_id", "block").orderBy("turn", "role", "text"))
    sizes = turns.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("conv_id", "block", before.alias("before"))
    numbered = turns.withColumn("within", within).join(starts, ["conv_id", "block"])
    return numbered.select("conv_id", "block", (F.col("before") + F.col("within")).alias("position"), "role", "text")


def _prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, position, prefix): the rolling hash of the turns up to each position.

    Two 64-bit hashes in four halves, whose sums stay far from a long's range.
    """
    low, high = F.lit(0xFFFFFFFF).cast("long"), 32
    hashed = turns.withColumn("a", F.xxhash64("position", "role", "text")).withColumn("b", F.xxhash64(F.lit(1), "text", "position", "role"))
    halves = [F.col("a").bitwiseAND(low), F.shiftrightunsigned("a", high), F.col("b").bitwiseAND(low), F.shiftrightunsigned("b", high)]
    hashed = hashed.select("conv_id", "block", "position", *[h.alias(n) for h, n in zip(halves, HALVES)])
    running = W.partitionBy("conv_id", "block").orderBy("position").rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    sums = hashed.groupBy("conv_id", "block").agg(*[F.sum(n).alias(n) for n in HALVES])
    bases = sums.select("conv_id", "block", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_before") for n in HALVES])
    within = hashed.select("conv_id", "block", "position", *[F.sum(n).over(running).alias(n) for n in HALVES])
    joined = within.join(bases, ["conv_id", "block"])
    return joined.select("conv_id", "position", F.struct(*[(F.col(n) + F.col(f"{n}_before")).alias(n) for n in HALVES]).alias("prefix"))


def maximal_conversations(turns: DataFrame, stages: Stages) -> DataFrame:
    """(conv_id, n_turns, n_collapsed) of conversations that are no other one's prefix.

    Of equal conversations the least conv_id stays; ``n_collapsed`` counts the others.
    """
    prefixes = stages.write(_prefix_hashes(turns), "prefixes")
    last = prefixes.groupBy("conv_id").agg(F.max("position").alias("n_turns"))
    whole = prefixes.join(last, "conv_id").where("position = n_turns").groupBy("n_turns", "prefix")
    whole = whole.agg(F.min("conv_id").alias("conv_id"), (F.count("*") - 1).alias("n_collapsed"))
    inner = prefixes.join(last, "conv_id").where("position < n_turns").select(F.col("position").alias("n_turns"), "prefix").distinct()
    return whole.join(inner, ["n_turns", "prefix"], "left_anti").select("conv_id", "n_turns", "n_collapsed")


def format_chats(conversations: DataFrame, rule: ChatRule | None = None) -> DataFrame:
    """conv_id, part, n_turns, n_collapsed, chat: the rendered maximal conversations.

    Turns are ordered by number, then role and text; repeated rows count once. A null
    role or text is empty. Rows without a conversation or a turn number belong nowhere
    and take no part. A conversation of up to ``part`` turns is one row, part 0.
    """
    rule = rule or ChatRule()
    stages = Stages(conversations.sparkSession)
    turns = stages.write(_positions(conversations, rule), "turns")
    kept = maximal_conversations(turns, stages)
    rendered = F.concat(F.lit(rule.opening), "role", F.lit("\n"), "text", F.lit(f"{rule.closing}\n"))
    parts = turns.join(kept, "conv_id").withColumn("part", F.floor((F.col("position") - 1) / rule.part))
    ordered = F.array_sort(F.collect_list(F.struct("position", rendered.alias("rendered"))))
    grouped = parts.groupBy("conv_id", "part", "n_turns", "n_collapsed").agg(ordered.alias("turns"))
    return grouped.withColumn("chat", F.array_join(F.transform("turns", lambda t: t["rendered"]), "")).drop("turns")


SQL = r"""
WITH turns AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), whole AS (
    SELECT conv_id, list({'r': role, 't': text} ORDER BY turn, role, text) AS turns, count(*) AS n_turns
    FROM turns GROUP BY conv_id
), firsts AS (
    SELECT turns, n_turns, min(conv_id) AS conv_id, count(*) - 1 AS n_collapsed FROM whole GROUP BY turns, n_turns
), prefixes AS (
    SELECT DISTINCT turns[1:i] AS turns FROM (SELECT turns, unnest(range(1, n_turns)) AS i FROM firsts)
)
SELECT f.conv_id, CAST(0 AS BIGINT) AS part, f.n_turns, f.n_collapsed,
       list_aggregate(list_transform(f.turns, lambda x: '<|im_start|>' || x.r || chr(10) || x.t || '<|im_end|>' || chr(10)), 'string_agg', '') AS chat
FROM firsts f ANTI JOIN prefixes p ON f.turns = p.turns
"""
