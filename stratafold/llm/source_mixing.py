"""Mixing sources to target weights by blocks.

The words of a source, its documents end to end in the order of their ids, are cut
into blocks of one length. Output slots take one block each. Shards of slots draw
multinomial counts of the sources, given that all draws of a source come to the
number of its blocks that its target needs: halving the shards again and again, the
left half's counts are a multivariate hypergeometric draw from the whole's, so that
each shard finds its own counts, and how many were drawn before it, without any
other shard. The j-th slot of a source takes block ``permutation(j)``; every pass
over the blocks has a permutation of its own, so no word comes a second time before
all have come once. The last slot of a source is cut where its target is reached.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.llm.positions import numbered
from stratafold.llm.shared import Stages

WORD = r"[^\x20\x09-\x0D]+"
NULL_SOURCE = "-"


@dataclass(frozen=True)
class MixRule:
    """``weights`` repeat over the sources by name; no source is taken more than ``most`` times."""

    weights: tuple[int, ...] = (1, 2, 3)
    most: int = 3
    block: int = 256
    shard: int = 4096
    seed: int = 42
    # Shards are drawn in strata of about so many slots, below what the generator allows.
    stratum: int = 1 << 29


@dataclass(frozen=True)
class Share:
    """What is taken of one source: ``slots`` blocks, the last of them cut to ``last`` words."""

    source: str
    size: int
    target: float
    blocks: int
    slots: int
    last: int


def targets(sizes: list[int], weights: tuple[int, ...], most: int) -> list[float]:
    """Shares of the whole by weight, none above ``most`` times its source's size.

    What a source cannot take goes to the others by weight, until none is above.
    """
    share = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    found, left, open_ = [0.0] * len(sizes), float(sum(sizes)), set(range(len(sizes)))
    while open_:
        scale = left / sum(share[i] for i in open_)
        above = {i for i in open_ if share[i] * scale > most * sizes[i]}
        for i in above or open_:
            found[i] = float(most * sizes[i]) if above else share[i] * scale
        left -= sum(found[i] for i in above)
        open_ -= above or set(open_)
    return found


def _mixed(values: np.ndarray, key: int) -> np.ndarray:
    """A hash of 64 bits, each bit depending on all of the value and the key."""
    with np.errstate(over="ignore"):
        z = values + np.uint64(key)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def permuted(index: np.ndarray, size: int, seed: tuple[int, ...], back: bool = False) -> np.ndarray:
    """A pseudorandom permutation of 0 .. size - 1 at the given places, or its inverse.

    Four rounds of a balanced Feistel network over the next power of four; values
    beyond the size walk on along their cycle.
    """
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = np.random.SeedSequence(seed).generate_state(4, np.uint64).tolist()

    def turned(v: np.ndarray) -> np.ndarray:
        left, right = v >> shift, v & mask
        for key in reversed(keys) if back else keys:
            if back:
                left, right = right ^ (_mixed(left, key) & mask), left
            else:
                left, right = right, left ^ (_mixed(right, key) & mask)
        return (left << shift) | right

    found = turned(index.astype(np.uint64))
    while (beyond := found >= size).any():
        found[beyond] = turned(found[beyond])
    return found.astype(np.int64)


def shares(sources: list[tuple[str, int]], rule: MixRule) -> list[Share]:
    """The target and the slots of each source, given in the order of their weights."""
    found = []
    for number, ((name, size), target) in enumerate(zip(sources, targets([s for _, s in sources], rule.weights, rule.most))):
        blocks = -(-size // rule.block)
        passes, rest = divmod(min(round(target), rule.most * size), size) if size else (0, 0)
        slots, last = passes * blocks, rule.block
        if rest:
            # the source's last block is shorter; count it where the last, partial pass comes to it
            lack = blocks * rule.block - size
            short = int(permuted(np.array([blocks - 1]), blocks, (rule.seed, number, passes), back=True)[0])
            partial = -(-rest // rule.block)
            if partial > short:
                partial = -(-(rest + lack) // rule.block)
            over = partial * rule.block - (lack if partial > short else 0) - rest
            slots, last = slots + partial, (rule.block - lack if partial - 1 == short else rule.block) - over
        found.append(Share(name, size, target, blocks, slots, last))
    return found


def shard_counts(slots: np.ndarray, sizes: list[int], shard: int, seed: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each source in a shard, and in the shards before it.

    ``slots`` of each source are dealt out at random over shards of the given ``sizes``.
    """
    before, here, low, high = np.zeros_like(slots), slots, 0, len(sizes)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    while high - low > 1:
        middle = (low + high) // 2
        draw = np.random.default_rng([*seed, low, high])
        left = draw.multivariate_hypergeometric(here, int(ends[middle] - ends[low]), method="marginals")
        if shard < middle:
            here, high = left, middle
        else:
            before, here, low = before + left, here - left, middle
    return here, before


def _slots(spark, plan: list[Share], rule: MixRule) -> DataFrame:
    """One row per slot: shard, slot, tree (source), block, words (at most)."""
    counts = np.array([s.slots for s in plan], np.int64)
    strata = max(1, -(-int(counts.sum()) // rule.stratum))
    # a stratum has its part of every source, to a slot
    edges = [np.array([c * k // strata for c in counts.tolist()], np.int64) for k in range(strata + 1)]
    shards = [-(-int((b - a).sum()) // rule.shard) for a, b in zip(edges, edges[1:])]
    first = np.concatenate([[0], np.cumsum(shards)]).astype(np.int64)
    names = ["shard", "slot", "tree", "block", "words"]
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]

    def drawn(number: int) -> list:
        stratum = int(np.searchsorted(first, number, side="right")) - 1
        whole = edges[stratum + 1] - edges[stratum]
        total, count = int(whole.sum()), shards[stratum]
        sizes = [min(rule.shard, total - k * rule.shard) for k in range(count)]
        here, before = shard_counts(whole, sizes, number - int(first[stratum]), (rule.seed, stratum))
        order = np.random.default_rng([rule.seed, stratum, number, 1]).permutation(int(here.sum()))
        tree, block, words = [], [], []
        for source, share in enumerate(plan):
            nth = int(edges[stratum][source] + before[source]) + np.arange(here[source])
            at = np.empty(len(nth), np.int64)
            for turn in np.unique(nth // max(1, share.blocks)).tolist():
                own = nth // share.blocks == turn
                at[own] = permuted(nth[own] % share.blocks, share.blocks, (rule.seed, source, turn))
            tree += [share.source] * len(nth)
            block.append(at)
            words.append(np.where(nth == share.slots - 1, share.last, rule.block))
        return [[number] * len(order), order.astype(np.int32), tree, np.concatenate(block), np.concatenate(words)]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(drawn(number), kinds)], names)

    numbers = spark.range(0, int(first[-1]), 1, max(1, -(-int(first[-1]) // 16)))
    return numbers.mapInArrow(dealt, "shard long, slot int, tree string, block long, words long")


@dataclass(frozen=True)
class Mix:
    """``documents``: row, doc_id, tree, size, source_size, target. ``pieces``: shard, slot,
    tree, block, at (the piece's place in the slot), row, doc_id, start (words of the
    document before it), words."""

    documents: DataFrame
    pieces: DataFrame


def mix(docs: DataFrame, rule: MixRule | None = None) -> Mix:
    """Slots filled with pieces of documents, so that sources meet their targets.

    A row's size is the number of words in its text (null: none). Each row is a
    document of its own, those with equal or null ids too; documents without words
    have no pieces. Every source that the table names has a place in the order of
    weights, its documents empty or not; rows without a source are the last. The
    plan has one entry per source and goes through the driver.
    """
    rule = rule or MixRule()
    spark = docs.sparkSession
    stages = Stages(spark)
    tree = F.when(F.col("source").isNull(), NULL_SOURCE).otherwise(F.concat(F.lit("="), "source"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    counted = stages.write(docs.select(F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"), size.alias("size")), "sizes")
    placed = stages.write(numbered(counted, "tree", ["doc_id", "size"], stages, "size"), "placed")
    totals = [(r["tree"], r["n"]) for r in counted.groupBy("tree").agg(F.sum("size").alias("n")).collect()]
    plan = shares(sorted(totals, key=lambda s: (s[0] == NULL_SOURCE, s[0])), rule)

    goal = spark.createDataFrame([(s.source, s.target) for s in plan], "tree string, target double")
    documents = placed.withColumnRenamed("group_weight", "source_size").join(goal, "tree")
    end = F.col("before") + F.col("size")
    blocks = F.sequence(F.expr(f"before div {rule.block}L"), F.expr(f"(before + size - 1) div {rule.block}L"))
    spread = placed.where("size > 0").select("tree", "row", "doc_id", "before", end.alias("end"), F.explode(blocks).alias("block"))
    low = F.greatest(F.col("before"), F.col("block") * rule.block)
    high = F.least(F.col("end"), (F.col("block") + 1) * rule.block)
    pieces = spread.select(
        "tree", "block", (low - F.col("block") * rule.block).alias("at"), "row", "doc_id",
        (low - F.col("before")).alias("start"), (high - low).alias("own"),
    )
    # slots grow with the corpus, which Spark cannot tell from the range of shards
    joined = _slots(spark, plan, rule).hint("merge").join(pieces, ["tree", "block"])
    taken = F.least(F.col("own"), F.col("words") - F.col("at"))
    filled = joined.where(F.col("words") > F.col("at")).withColumn("words", taken).drop("own")
    return Mix(documents, filled)


def mixed_sizes(docs: DataFrame, rule: MixRule | None = None) -> DataFrame:
    """doc_id, size, source_size, target and the words that the mix takes of each document."""
    found = mix(docs, rule)
    taken = found.pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    joined = found.documents.join(taken, "row", "left")
    return joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def slot_texts(docs: DataFrame, pieces: DataFrame) -> DataFrame:
    """shard, slot and the words of each slot, joined by blanks, of documents with distinct ids."""
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), words.alias("all"))
    own = F.slice("all", (F.col("start") + 1).cast("int"), F.col("words").cast("int"))
    read = pieces.join(texts, "doc_id").select("shard", "slot", F.struct("at", F.array_join(own, " ").alias("text")).alias("piece"))
    return read.groupBy("shard", "slot").agg(F.array_join(F.sort_array(F.collect_list("piece"))["text"], " ").alias("text"))
