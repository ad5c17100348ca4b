"""Whitening of embeddings: principal components by incremental eigendecomposition.

Every task keeps the eigenpairs of its own vectors' scatter, one centred rank-one
update per vector (``secular``). The tasks' spectra are combined by further such
updates, a few at a time, until one is left. A last pass over all vectors projects
them on its whole basis; the eigenpairs of that small, nearly diagonal matrix
(Rayleigh-Ritz) turn the basis into the components to double precision. Vectors
are whole numbers, so that sums, means and centred entries carry no rounding of
the entries' common offset.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.llm.secular import Spectrum
from stratafold.llm.shared import Stages

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
# Spectra that one task combines.
FAN = 16
# Components with less than this part of the largest variance count as constant.
CONSTANT = 1e-12
BATCH = 4096
SPECTRUM = "part long, rows long, mean array<double>, eigenvalues array<double>, vectors array<double>"


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): floor(64 c) + 1000000 of each entry; rows with a null or non-finite one are left out."""
    c = F.col("embedding").cast("array<double>")
    whole = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = embeddings.where(F.col("embedding").isNotNull() & F.coalesce(whole, F.lit(False)))
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(c, lambda v: F.floor(v * SCALE).cast("long") + F.lit(OFFSET).cast("long")).alias("x"),
    )


def matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The vectors as rows; shorter ones are filled up with the value of a zero."""
    x = batch.column("x")
    sizes = pc.list_value_length(x).to_numpy(zero_copy_only=False)
    found = np.full((len(sizes), width), OFFSET, np.int64)
    found[np.arange(width) < sizes[:, None]] = x.flatten().to_numpy(zero_copy_only=False)
    return found


@dataclass(frozen=True)
class Frame:
    """Number of vectors and the sum of each dimension, exact."""

    rows: int
    sums: np.ndarray

    @property
    def width(self) -> int:
        return len(self.sums)

    @property
    def middle(self) -> np.ndarray:
        """A whole number near the mean of each dimension."""
        return self.sums // max(1, self.rows)

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n * x - S of each entry, exact."""
        return self.rows * x - self.sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.apart(x) / self.rows


def _summed(vectors: DataFrame, width: int, matrices: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of a small matrix per batch, added up within tasks, then over them."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = matrices(matrix(batch, width)).ravel()
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["cell", "value"])

    empty = matrices(np.full((0, width), OFFSET, np.int64))
    kind = "long" if empty.dtype == np.int64 else "double"
    cells = vectors.mapInArrow(added, f"cell long, value {kind}").groupBy("cell").agg(F.sum("value").alias("value"))
    found = empty.copy().ravel()
    for row in cells.collect():  # a cell of a matrix by dimensions each
        found[row["cell"]] = row["value"]
    return found.reshape(empty.shape)


def _spectra(vectors: DataFrame, frame: Frame) -> DataFrame:
    """One row per task with vectors: their number, mean and eigenpairs."""
    width, middle = frame.width, frame.middle

    def decomposed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum.empty(width)
        for batch in batches:
            for row in (matrix(batch, width) - middle).astype(float):
                own.add(row)
        if own.rows:
            yield pa.RecordBatch.from_pandas(_stored(TaskContext.get().partitionId(), own), preserve_index=False)

    return vectors.mapInArrow(decomposed, SPECTRUM)


def _stored(part: int, spectrum: Spectrum) -> pd.DataFrame:
    row = [part, spectrum.rows, spectrum.mean, spectrum.values, spectrum.vectors.ravel()]
    return pd.DataFrame([row], columns=["part", "rows", "mean", "eigenvalues", "vectors"])


def _loaded(row) -> Spectrum:
    width = len(row.mean)
    vectors = np.array(row.vectors, float).reshape(width, width)
    return Spectrum(int(row.rows), np.array(row.mean, float), np.array(row.eigenvalues, float), vectors)


def _combined(rows: pd.DataFrame) -> pd.DataFrame:
    spectra = [_loaded(r) for r in rows.sort_values("part").itertuples()]
    for other in spectra[1:]:
        spectra[0].join(other)
    return _stored(int(rows["part"].min()) // FAN, spectra[0])


def basis(vectors: DataFrame, frame: Frame, stages: Stages) -> np.ndarray:
    """The eigenvectors (columns) that the tasks' combined spectra give."""
    found = stages.write(_spectra(vectors, frame), "spectra")
    while found.count() > 1:
        found = stages.write(found.groupBy(F.expr(f"part div {FAN}L")).applyInPandas(_combined, SPECTRUM), "spectra")
    return _loaded(found.first()).vectors


@dataclass(frozen=True)
class Whitening:
    """Components (columns) by falling variance, and the trace of the covariance."""

    frame: Frame
    components: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def varied(self) -> np.ndarray:
        return self.variances > CONSTANT * max(float(self.variances.max(initial=0)), 0)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened vectors; NaN for components without variance."""
        spread = np.sqrt(np.where(self.varied, self.variances, np.nan))
        return (self.frame.centred(x) @ self.components) / spread


def fit(vectors: DataFrame, stages: Stages, components: int = COMPONENTS) -> Whitening | None:
    """The components of written ``vectors`` (vec_id, x); None if there are none."""
    shape = vectors.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width")).first()
    if not shape["n"]:
        return None
    sums = _summed(vectors, shape["width"], lambda x: x.sum(axis=0, dtype=np.int64))
    frame = Frame(shape["n"], sums)
    if not frame.width:
        return Whitening(frame, np.zeros((0, 0)), np.zeros(0), 0.0)
    # orthonormal to the last bit, so that the projected matrix has the same eigenvalues
    rough = np.linalg.qr(basis(vectors, frame, stages))[0]

    def scatter(x: np.ndarray) -> np.ndarray:
        y = frame.centred(x) @ rough
        return y.T @ y

    projected = _summed(vectors, frame.width, scatter) / frame.rows
    values, turned = np.linalg.eigh((projected + projected.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    return Whitening(frame, rough @ turned[:, order], np.maximum(values[order], 0), float(np.trace(projected)))


def _identity_error(vectors: DataFrame, found: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity, varied components only."""
    varied = found.varied
    count = int(varied.sum())
    if not count:
        return 0.0

    def moments(x: np.ndarray) -> np.ndarray:
        y = found.project(x)[:, varied]
        return np.vstack([y.T @ y, y.sum(axis=0)])

    summed = _summed(vectors, found.frame.width, moments) / found.frame.rows
    mean = summed[count]
    return float(np.abs(summed[:count] - np.outer(mean, mean) - np.eye(count)).max())


def _deviations(apart: np.ndarray) -> list[int]:
    """Sum of squares of each row, exact; cut to a long's range."""
    reach = int(np.abs(apart).max(initial=0))
    if reach * reach * apart.shape[1] < 1 << 63:
        return (apart * apart).sum(axis=1).tolist()
    return [min(sum(v * v for v in row), (1 << 63) - 1) for row in apart.tolist()]


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error.

    One row per remaining vector and component, up to ``components`` and the number of
    dimensions; repeated rows and rows without an id count and come back as often as
    they occur. Shorter vectors are filled up with zeros to the longest one's
    length. A component without variance has null for ``whitened`` and 0 for
    ``explained``, and no part in ``identity_error``. Sums are exact as long as n * x
    fits in a long (some 10^12 vectors).
    """
    spark = embeddings.sparkSession
    stages = Stages(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    vectors = stages.write(integer_vectors(embeddings), "vectors")
    found = fit(vectors, stages, components)
    names = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if found is None or not found.frame.width:
        return spark.createDataFrame([], names)
    frame, width = found.frame, found.frame.width
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.float64())]

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch, width)
            rows = [batch.column("vec_id"), pa.array(_deviations(frame.apart(x)), kinds[1]), pa.array(list(found.project(x)), kinds[2])]
            yield pa.RecordBatch.from_arrays(rows, ["vec_id", "deviation", "z"])

    explained = [float(e) / found.trace if found.trace > 0 else 0.0 for e in np.where(found.varied, found.variances, 0)]
    rows = vectors.mapInArrow(projected, "vec_id long, deviation long, z array<double>")
    each = rows.select("vec_id", "deviation", F.posexplode("z").alias("at", "z"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(frame.rows).cast("long").alias("n"),
        "deviation",
        F.when(~F.isnan("z"), F.col("z")).alias("whitened"),
        F.array(*[F.lit(e) for e in explained])[F.col("at")].alias("explained"),
        F.lit(_identity_error(vectors, found)).alias("identity_error"),
    )
