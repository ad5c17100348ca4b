"""Packing: window-filling combinations of lengths by non-negative least squares.

A document's full windows are sequences of their own. What is left of it, its
tail, is shorter than a window. The histogram of tail lengths has as many entries
as a window has tokens, whatever the number of documents. Combinations of two or
three lengths that fill a window exactly are enumerated from the histogram, their
repeat counts solved for by least squares without negatives and rounded down. What
that leaves over is laid end to end and cut at the windows' ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratafold.llm.shared import Stages, column, id_and_text, literal_array, small_batches
from stratafold.llm.tokens import Vocabulary, encoder

WINDOW = 1024
END_ID = 0
# Tails of one length are numbered in parts of about so many.
PART_ROWS = 1000
# Rows and windows of a task are numbered below its partition's number.
LOCAL_BITS = 40

TOKENS = "row_id long, doc_id long, doc_tokens long, first_window long, window_crcs array<long>, tail binary, tail_len int"


@dataclass(frozen=True)
class Plan:
    """Where the j-th tail of a length goes: in ``used`` of them by combinations, the rest end to end.

    ``starts`` .. ``offsets`` list the ranges of ranks, those of length l in
    ``first[l]:first[l + 1]`` by start: a sequence takes ``copies`` of the length.
    """

    first: np.ndarray
    starts: np.ndarray
    sequences: np.ndarray
    copies: np.ndarray
    offsets: np.ndarray
    used: np.ndarray
    laid: np.ndarray
    combined: int
    total: int


def combinations(histogram: np.ndarray, window: int) -> np.ndarray:
    """Ascending triples of lengths found in the histogram that sum to the window; 0 stands for none."""
    have = histogram > 0
    lengths = np.flatnonzero(have)
    found = [np.empty((0, 3), np.int64)]
    for a in [0, *lengths[lengths > 0].tolist()]:
        b = lengths[(lengths >= max(a, 1)) & (lengths <= (window - a) // 2)]
        c = window - a - b
        keep = have[c]
        found.append(np.stack([np.full(keep.sum(), a), b[keep], c[keep]], axis=1))
    return np.concatenate(found)


def repeat_counts(combos: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Non-negative least squares for A x = histogram by accelerated projected gradients.

    A has the copies of each length in each combination; it is only ever applied.
    """
    size = len(histogram)
    wanted = histogram.astype(float)
    wanted[0] = 0

    def apply(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(combos[:, i], x, size) for i in range(3))
        out[0] = 0
        return out

    def back(r: np.ndarray) -> np.ndarray:
        return r[combos].sum(axis=1)

    v = np.ones(len(combos))
    for _ in range(20):
        v = back(apply(v / np.linalg.norm(v)))
    step = 1 / (1.05 * np.linalg.norm(v))
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        following = np.maximum(0, y - step * back(apply(y) - wanted))
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = following + (t - 1) / t_next * (following - x)
        x, t = following, t_next
    return x


def plan_packing(histogram: np.ndarray, window: int = WINDOW) -> Plan:
    """The plan for so many tails of each length; entry 0 is ignored."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    used = np.zeros(window, np.int64)
    ranges: list[tuple[int, int, int, int, int]] = []  # length, first rank, first sequence, copies, offset
    sequence = 0
    combos = combinations(left, window)
    if len(combos):
        solved = repeat_counts(combos, left)
        for i in np.argsort(-solved, kind="stable"):
            whole = int(solved[i])
            if whole == 0:
                break
            parts = [(int(n), int(k)) for n, k in zip(*np.unique(combos[i], return_counts=True)) if n]
            times = min(whole, *(int(left[n]) // k for n, k in parts))
            if times <= 0:
                continue
            offset = 0
            for n, k in parts:
                ranges.append((n, int(used[n]), sequence, k, offset))
                used[n] += times * k
                left[n] -= times * k
                offset += n * k
            sequence += times
    ranges.sort()
    table = np.array(ranges, np.int64).reshape(-1, 5)
    weight = left * np.arange(window)
    laid = np.concatenate([[0], np.cumsum(weight)[:-1]])
    total = sequence + int(-(-weight.sum() // window))
    first = np.searchsorted(table[:, 0], np.arange(window + 1))
    return Plan(first, table[:, 1], table[:, 2], table[:, 3], table[:, 4], used, laid, sequence, total)


def place(plan: Plan, length: int, rank: int, window: int = WINDOW) -> list[tuple[int, int, int, int]]:
    """(start in the tail, length, sequence, offset there) of each piece of one tail."""
    if rank < plan.used[length]:
        own = slice(plan.first[length], plan.first[length + 1])
        i = plan.first[length] + int(np.searchsorted(plan.starts[own], rank, side="right")) - 1
        nth, copy = divmod(rank - int(plan.starts[i]), int(plan.copies[i]))
        return [(0, length, int(plan.sequences[i]) + nth, int(plan.offsets[i]) + copy * length)]
    at = int(plan.laid[length]) + (rank - int(plan.used[length])) * length
    room = window - at % window
    pieces = [(0, min(length, room), plan.combined + at // window, at % window)]
    if length > room:
        pieces.append((room, length - room, plan.combined + at // window + 1, 0))
    return pieces


def _tokens(docs: DataFrame, window: int, vocabulary: Vocabulary) -> DataFrame:
    """Checksums of each document's full windows, and the ids of its tail."""
    names = [part.split()[0] for part in TOKENS.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.binary(), pa.int32()]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        row = windows = TaskContext.get().partitionId() << LOCAL_BITS
        for batch in batches:
            rows = []
            for doc, text in zip(column(batch, "doc_id"), column(batch, "text")):
                total, crcs, rest = 0, [], np.empty(0, "<u4")
                for ids in chain(own.parts(text), [[END_ID]]):
                    total += len(ids)
                    rest = np.concatenate([rest, np.array(ids, "<u4")])
                    full = len(rest) // window
                    crcs += [crc32(rest[i * window : (i + 1) * window].tobytes()) for i in range(full)]
                    rest = rest[full * window :]
                rows.append((row, doc, total, windows, crcs, rest.tobytes(), len(rest)))
                row += 1
                windows += len(crcs)
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names)

    return id_and_text(docs).mapInArrow(encoded, TOKENS)


def _ranked(tokens: DataFrame, histogram: np.ndarray) -> DataFrame:
    """Number the tails of each length from 0: within parts, then by the parts' sizes."""
    parts = literal_array([max(1, -(-int(n) // PART_ROWS)) for n in histogram])
    salted = tokens.withColumn("part", F.pmod(F.xxhash64("row_id"), F.get(parts, F.col("tail_len"))))
    sizes = salted.groupBy("tail_len", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("tail_len").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("tail_len", "part", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(W.partitionBy("tail_len", "part").orderBy("row_id")) - 1
    numbered = salted.withColumn("within", within).join(starts, ["tail_len", "part"])
    return numbered.withColumn("rank", F.col("before") + F.col("within")).drop("part", "before", "within")


def pack(docs: DataFrame, window: int = WINDOW, vocabulary: Vocabulary | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its whole text (null: empty) and one end id, so
    each has a piece. Only tails that the combinations leave over are cut. Every
    row of ``docs`` is a document, repeated rows and null ids included. The pieces
    of one sequence lie end to end from offset 0; all but the last are full.
    """
    vocabulary = vocabulary or Vocabulary()
    spark = docs.sparkSession
    small_batches(spark)
    tokens = Stages(spark).write(_tokens(docs, window, vocabulary), "tokens")
    histogram = np.zeros(window, np.int64)
    for row in tokens.groupBy("tail_len").count().collect():  # one row per length below the window
        histogram[row["tail_len"]] = row["count"]
    plan = spark.sparkContext.broadcast(plan_packing(histogram, window))

    pieces = "array<struct<start:long,length:long,sequence_id:long,offset:long>>"
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "sequence_id", "offset")]))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [
                [dict(zip(("start", "length", "sequence_id", "offset"), p)) for p in place(plan.value, n, j, window)] if n else []
                for n, j in zip(column(batch, "tail_len"), column(batch, "rank"))
            ]
            rest = [batch.column(c) for c in ("doc_id", "doc_tokens", "tail", "tail_len")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(own, kind)], ["doc_id", "doc_tokens", "tail", "tail_len", "pieces"])

    ranked = _ranked(tokens.where("tail_len > 0").select("row_id", "doc_id", "doc_tokens", "tail", "tail_len"), histogram)
    ranked = ranked.select("doc_id", "doc_tokens", "tail", "tail_len", "rank")
    tails = ranked.mapInArrow(placed, f"doc_id long, doc_tokens long, tail binary, tail_len int, pieces {pieces}")
    tails = tails.withColumn("p", F.explode("pieces"))
    cut = F.expr("substring(tail, CAST(4 * p.start + 1 AS int), CAST(4 * p.length AS int))")
    tails = tails.select(
        "doc_id",
        (F.col("doc_tokens") - F.col("tail_len") + F.col("p.start")).alias("start"),
        "p.length",
        F.crc32(cut).alias("ids_crc32"),
        "doc_tokens",
        "p.sequence_id",
        "p.offset",
    )
    windows = tokens.select("doc_id", "doc_tokens", "first_window", F.posexplode("window_crcs").alias("i", "crc"))
    full = windows.select(
        "doc_id",
        (F.col("i").cast("long") * window).alias("start"),
        F.lit(window).cast("long").alias("length"),
        F.col("crc").alias("ids_crc32"),
        "doc_tokens",
        (F.lit(plan.value.total) + F.col("first_window") + F.col("i")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return tails.unionByName(full)
