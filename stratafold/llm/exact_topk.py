"""Exact top-k search by inner product with a table of distances to pivots.

With c longer than any vector, x' = (x, sqrt(c^2 - |x|^2)) turns the largest inner
product into the nearest point: |q' - x'|^2 = |q|^2 + c^2 - 2 q.x for q' = (q, 0).
A pivot p gives |q' - x'| >= | |q' - p| - |x' - p| |, and many pivots the largest of
these. Candidates are scored in the order of that bound; a query is done when the
next bound lies beyond its k-th best. Vectors are dealt into blocks of fixed size;
each block of queries meets each block of candidates, and the best of all blocks
are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratafold.llm.shared import Stages

# Whole numbers up to here multiply and add without rounding in doubles.
EXACT = 1 << 53
STEP = 512


@dataclass(frozen=True)
class SearchRule:
    k: int = 5
    every: int = 50
    pivots: int = 16
    queries: int = 512
    candidates: int = 4096
    sample: int = 2048


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v): floor(256 x) of every component; rows that cannot take part are left out."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * 256)).alias("v"))


def _blocks(vectors: DataFrame, size: int, width: int, stages: Stages, label: str) -> DataFrame:
    """Rows of up to ``size`` vectors: block, their ids, their components one after the other."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = [], []
        def block() -> pa.RecordBatch:
            arrays = [pa.array([ids], pa.list_(pa.int64())), pa.array([np.stack(rows).tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["ids", "data"])
        for batch in batches:
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist()):
                ids.append(i)
                rows.append(np.array(v + [0] * (width - len(v)), np.int64))
                if len(ids) == size:
                    yield block()
                    ids, rows = [], []
        if ids:
            yield block()

    found = vectors.mapInArrow(packed, "ids array<long>, data binary")
    return stages.write(found.withColumn("block", F.monotonically_increasing_id()), label)


def _matrix(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, np.int64).reshape(-1, width)


def _products(candidates: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as whole numbers; arbitrary size where doubles would round."""
    if exact:
        return (candidates.astype(float) @ query.astype(float)).astype(np.int64)
    wide = candidates.astype(object) @ query.astype(object)
    return np.array([max(min(int(p), 2**63 - 1), -(2**63)) for p in wide], np.int64)


def search_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, pivots: np.ndarray, k: int) -> list[tuple]:
    """(query number, vec_id, score) of each query's k best in the block, ties to the smaller id."""
    norms = (vectors.astype(float) ** 2).sum(axis=1)
    top = float(norms.max())
    lifted = np.concatenate([vectors.astype(float), np.sqrt(np.maximum(top - norms, 0))[:, None]], axis=1)
    flat = np.concatenate([queries.astype(float), np.zeros((len(queries), 1))], axis=1)
    anchors = np.concatenate([pivots.astype(float), np.zeros((len(pivots), 1))], axis=1)
    to_pivots = lambda m: np.sqrt(np.maximum(((m[:, None, :] - anchors[None]) ** 2).sum(axis=2), 0))
    table = to_pivots(lifted).T.copy()
    query_norms = (flat**2).sum(axis=1)
    largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * vectors.shape[1]
    exact = largest < EXACT
    slack = 1e-9 * (top + float(query_norms.max(initial=0)) + 1)
    found = []
    for number, query in enumerate(queries):
        bound = np.zeros(len(vectors))
        for pivot, near in enumerate(np.sqrt(((flat[number] - anchors) ** 2).sum(axis=1))):
            np.maximum(bound, np.abs(table[pivot] - near), out=bound)
        # the largest score that a candidate's bound leaves possible
        possible = (query_norms[number] + top - bound**2) / 2 + slack
        order = np.argsort(-possible, kind="stable")
        best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)
        for at in range(0, len(order), STEP):
            part = order[at : at + STEP]
            if len(best) == k and possible[part[0]] < best[-1]:
                break
            part = part[ids[part] != query_ids[number]]
            best_ids = np.concatenate([best_ids, ids[part]])
            best = np.concatenate([best, _products(vectors[part], query, exact)])
            chosen = np.lexsort((best_ids, -best))[:k] if exact else np.array(sorted(range(len(best)), key=lambda i: (-int(best[i]), best_ids[i]))[:k], int)
            best_ids, best = best_ids[chosen], best[chosen]
        found += [(number, int(i), int(s)) for i, s in zip(best_ids, best)]
    return found


def top_k(embeddings: DataFrame, rule: SearchRule | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other vectors of every query.

    Queries are the rows whose vec_id is divisible by ``every``; repeated equal query
    rows count once, a query whose id comes with different vectors is several. All rows
    with another vec_id are candidates, repeated ones as often as they occur. Rows
    without an id or with a null or non-finite component take no part. Shorter
    vectors count as filled up with zeros; scores beyond a long are cut to its range.
    """
    rule = rule or SearchRule()
    spark = embeddings.sparkSession
    stages = Stages(spark)
    vectors = stages.write(integer_vectors(embeddings), "vectors")
    width = max(1, vectors.agg(F.max(F.size("v"))).first()[0] or 0)
    pivots = [r["v"] for r in vectors.orderBy(F.xxhash64("vec_id", "v")).limit(rule.sample).select("v").collect()]
    chosen = spark.sparkContext.broadcast(_spread(np.array([v + [0] * (width - len(v)) for v in pivots], np.int64).reshape(-1, width), rule.pivots))
    candidates = _blocks(vectors, rule.candidates, width, stages, "candidates")
    queries = vectors.where(F.col("vec_id") % rule.every == 0).distinct()
    queries = _blocks(queries, rule.queries, width, stages, "queries").select(
        F.col("block").alias("query_block"), F.col("ids").alias("query_ids"), F.col("data").alias("query_data")
    )
    # every block of queries with every block of candidates, by the number of the former
    numbers = [r[0] for r in queries.select("query_block").collect()]
    pairs = candidates.withColumn("query_block", F.explode(F.array(*[F.lit(n) for n in numbers]).cast("array<long>")))
    pairs = pairs.join(queries, "query_block").select("query_block", "query_ids", "query_data", "ids", "data")
    schema = "query_block long, number int, query_id long, vec_id long, score long"
    k = rule.k

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                query_ids, ids = np.array(row["query_ids"]), np.array(row["ids"])
                hits = search_block(_matrix(row["query_data"], width), query_ids, _matrix(row["data"], width), ids, chosen.value, k)
                columns = [(row["query_block"], n, int(query_ids[n]), i, s) for n, i, s in hits]
                yield pa.RecordBatch.from_pylist([dict(zip(("query_block", "number", "query_id", "vec_id", "score"), c)) for c in columns], pa.schema([("query_block", pa.int64()), ("number", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]))

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    best = pairs.repartition("query_block", F.xxhash64("ids")).mapInArrow(searched, schema)
    ranked = best.withColumn("rank", F.row_number().over(W.partitionBy("query_block", "number").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _spread(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots far from each other: each next one is farthest from those before."""
    if not len(sample):
        return sample
    points = sample.astype(float)
    chosen = [0]
    near = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(points)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


SQL = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM usable q JOIN usable c ON c.vec_id <> q.vec_id
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
