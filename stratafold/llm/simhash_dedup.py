"""SimHash near-duplicates, candidates by chains of fingerprint segments around a ring.

Let a fingerprint be cut into m segments on a ring and two fingerprints differ in
at most k bits. Then from some segment on, every chain of l = 1 .. m consecutive
segments differs in at most l * k / m bits (the pigeonring principle). With m = 5
and k = 4 the first segment must agree, the first two differ in one bit at most,
and so on. The join key is the first two segments; the one bit that may differ is
enumerated on one side. The longer chains are checked before the whole distance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold.llm.components import components
from stratafold.llm.shared import Stages, encoded_texts, id_and_text, small_batches, sorted_join

SEED = 42
BLOCK = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")


@dataclass(frozen=True)
class SimHashRule:
    shingle: int = 4
    distance: int = 4
    segments: int = 5

    @property
    def widths(self) -> list[int]:
        return [64 // self.segments + (i < 64 % self.segments) for i in range(self.segments)]

    @property
    def offsets(self) -> list[int]:
        return [sum(self.widths[:i]) for i in range(self.segments)]

    def budget(self, length: int) -> int:
        return length * self.distance // self.segments

    def __post_init__(self) -> None:
        if not 0 <= self.budget(2) <= 1 or self.budget(1) != 0:
            raise ValueError("the join key needs a first segment that agrees and a second with one bit of difference at most")


def _word_blocks(data: bytes) -> Iterator[list[bytes]]:
    at = 0
    while at < len(data):
        end = at + BLOCK
        if end < len(data):
            space = SPACE.search(data, end)
            end = space.start() if space else len(data)
        yield data[at:end].split()
        at = end


def fingerprint(data: bytes, shingle: int) -> int:
    """The fingerprint of a UTF-8 text; bytes.lower and split treat ASCII only."""
    ones, total, carry, any_hashed = np.zeros(64, np.int64), 0, [], False
    hashed = xxhash.xxh64_intdigest
    for words in _word_blocks(data.lower()):
        words = carry + words
        shingles = zip(*(islice(words, i, None) for i in range(shingle)))
        values = np.fromiter((hashed(b" ".join(s), SEED) for s in shingles), np.uint64)
        if len(values):
            any_hashed = True
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            total += len(values)
        carry = words[-(shingle - 1) :] if shingle > 1 else []
    if not any_hashed:
        return xxhash.xxh64_intdigest(b" ".join(carry), SEED) if carry else 0
    return int((np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64)) * (2 * ones > total)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, rule: SimHashRule) -> DataFrame:
    """(doc_id, fp) per row; the 64 bits of fp as a signed long."""
    small_batches(docs.sparkSession)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t, rule.shingle) for t in encoded_texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.int64())], ["doc_id", "fp"])

    return id_and_text(docs).mapInArrow(hashed, "doc_id long, fp long")


def _segment(fp: Column, rule: SimHashRule, i: int) -> Column:
    i %= rule.segments
    return F.shiftrightunsigned(fp, rule.offsets[i]).bitwiseAND(F.lit((1 << rule.widths[i]) - 1).cast("long"))


def _key(fp: Column, rule: SimHashRule, i: int, flip: int = 0) -> Column:
    """The start of the chain, its first segment, and its second with the bits of ``flip`` turned."""
    first, second = rule.widths[i], rule.widths[(i + 1) % rule.segments]
    high = F.shiftleft(_segment(fp, rule, i + 1).bitwiseXOR(F.lit(flip).cast("long")), first)
    return _segment(fp, rule, i).bitwiseOR(high).bitwiseOR(F.lit(i << (first + second)).cast("long"))


def _index_keys(rule: SimHashRule) -> Column:
    fp = F.col("fp")
    return F.explode(F.array(*[_key(fp, rule, i) for i in range(rule.segments)]))


def _probe_keys(rule: SimHashRule) -> Column:
    fp, keys = F.col("fp"), []
    for i in range(rule.segments):
        flips = [0] + [1 << b for b in range(rule.widths[(i + 1) % rule.segments])] * rule.budget(2)
        base = _key(fp, rule, i)
        masks = F.array(*[F.lit(f << rule.widths[i]).cast("long") for f in flips])
        keys.append(F.transform(masks, lambda m: base.bitwiseXOR(m)))
    return F.explode(F.concat(*keys))



def _within_ring(a: str, b: str, rule: SimHashRule) -> Column:
    """Every longer chain from some start stays in its budget, the whole ring last."""
    differ = F.col(a).bitwiseXOR(F.col(b))
    counts = [F.bit_count(_segment(differ, rule, i)) for i in range(rule.segments)]
    found = F.lit(False)
    for start in range(rule.segments):
        chain, total = F.lit(True), F.lit(0)
        for length in range(1, rule.segments):
            total = total + counts[(start + length - 1) % rule.segments]
            chain = chain & (total <= rule.budget(length))
        found = found | chain
    return found & (F.bit_count(differ) <= rule.distance)


def _labelled(distinct: DataFrame, links: DataFrame, stages: Stages) -> DataFrame:
    """(fp, comp) of every distinct fingerprint; one without links is its own."""
    found = components(links, stages).select(F.col("node").alias("fp"), F.col("root").alias("comp"))
    joined = distinct.select("fp").join(found, "fp", "left")
    return joined.select("fp", F.coalesce("comp", "fp").alias("comp"))


def _star_links(distinct: DataFrame, rule: SimHashRule, stages: Stages) -> DataFrame:
    """Link every fingerprint of a bucket to the bucket's least, where they are near."""
    keyed = distinct.select("fp", _index_keys(rule).alias("key"))
    hubs = keyed.groupBy("key").agg(F.min("fp").alias("hub"))
    near = sorted_join(keyed).join(hubs, "key").where((F.col("fp") != F.col("hub")) & _within_ring("fp", "hub", rule))
    return near.select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct()


def _cross_links(labelled: DataFrame, rule: SimHashRule, stages: Stages) -> DataFrame:
    """Links between fingerprints that no star has joined yet, as links of their components.

    Within a bucket only members of different components meet. The commonest
    component of a bucket is never paired with itself, so a large group of near
    copies costs its size times the number of strangers in its buckets.
    """
    index = labelled.select("fp", "comp", _index_keys(rule).alias("key"))
    sizes = index.groupBy("key", "comp").agg(F.count("*").alias("n"))
    keys = sizes.groupBy("key").agg(F.max_by("comp", "n").alias("main"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    probes = labelled.select(F.col("fp").alias("probe"), F.col("comp").alias("probe_comp"), _probe_keys(rule).alias("key"))
    live = sorted_join(probes).join(keys, "key").where("lo <> probe_comp OR hi <> probe_comp")
    live = stages.write(live.select("key", "probe", "probe_comp", "main"), "probes")
    wanted = live.groupBy("key").agg(F.first("main").alias("main"))
    met = stages.write(sorted_join(index).join(wanted, "key"), "met").select("key", "fp", "comp", "main")
    rest = met.where("comp <> main").drop("main")
    main = met.where("comp = main").drop("main")
    differ = F.col("comp") != F.col("probe_comp")
    pairs = [sorted_join(live).join(rest, "key"), sorted_join(live.where("probe_comp <> main")).join(main, "key")]
    near = [p.where(differ & _within_ring("fp", "probe", rule)).select(F.col("comp").alias("a"), F.col("probe_comp").alias("b")) for p in pairs]
    return near[0].unionByName(near[1]).distinct()


def near_duplicates(docs: DataFrame, rule: SimHashRule | None = None) -> DataFrame:
    """doc_id, fingerprint and component_id of every document.

    Fingerprints of at most ``distance`` differing bits are linked; component_id is
    the least doc_id reachable. Texts without words (empty, null, white space) have
    fingerprint zero and are linked like any other. Repeated rows give repeated
    results. A document without an id is linked too but never names a component:
    component_id is null where no member has an id. An empty table gives no rows.
    """
    rule = rule or SimHashRule()
    stages = Stages(docs.sparkSession)
    hashed = stages.write(fingerprints(docs, rule), "fingerprints")
    distinct = stages.write(hashed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    stars = stages.write(_labelled(distinct, _star_links(distinct, rule, stages), stages), "stars")
    joined = components(_cross_links(stars, rule, stages), stages).select(F.col("node").alias("comp"), "root")
    final = stars.join(joined, "comp", "left").select("fp", F.coalesce("root", "comp").alias("label"))
    named = final.join(distinct, "fp")
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = named.join(least, "label").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return sorted_join(hashed).join(ids, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, rule: SimHashRule | None = None) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id.

    Of repeated rows one stays. Documents without an id stay: nothing tells which
    of them would stand for their group.
    """
    found = near_duplicates(docs, rule).where("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    kept = docs.join(found, docs["doc_id"] == found["__kept"], "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id IS NULL")).select(docs.columns)
