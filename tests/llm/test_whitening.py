import numpy as np
import pytest

from stratafold.llm.secular import Spectrum
from stratafold.llm.whitening import whiten

NAMES = "vec_id long, embedding array<float>, x string, part string, z string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], NAMES)


def expected(vectors, components=32):
    c = np.array([np.floor(64 * np.array(v, np.float32).astype(float)) for v in vectors])
    x = c.astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    apart = n * x - total
    centred = apart / n
    cov = centred.T @ centred / n
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1][:components], vecs[:, ::-1][:, :components]
    return (apart**2).sum(axis=1), values, centred @ vecs, np.trace(cov)


def check(rows, got, components=32):
    deviation, values, projected, trace = expected([v for _, v in rows], components)
    width = len(values)
    assert len(got) == len(rows) * width
    table = {}
    for r in got:
        table.setdefault(r["vec_id"], {})[r["component"]] = r
    z = np.array([[table[i][k + 1]["whitened"] for k in range(width)] for i, _ in rows])
    want = projected / np.sqrt(values)
    signs = np.sign((z * want).sum(axis=0))
    assert np.abs(z * signs - want).max() < 1e-9
    for number, (i, _) in enumerate(rows):
        for k in range(width):
            r = table[i][k + 1]
            assert (r["n"], r["deviation"]) == (len(rows), deviation[number])
            assert r["explained"] == pytest.approx(values[k] / trace, rel=1e-9)
            assert r["identity_error"] < 1e-9


def test_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").repartition(5)
    check([(r["vec_id"], r["embedding"]) for r in table.collect()], whiten(table).collect())


def test_spectra_of_many_tasks(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=6) * [9, 5, 3, 2, 1, 0.5]).tolist()) for i in range(200)]
    check(rows, whiten(frame(spark, rows).repartition(40)).collect())


def test_fewer_components_than_dimensions(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(50)]
    check(rows, whiten(frame(spark, rows), 2).collect(), 2)


def test_nulls_infinities_and_short_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [0.5, -1.0]), (3, [3.0]), (4, [0.25, 4.0])]
    bad = [(5, None), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0])]
    got = whiten(frame(spark, rows + bad)).collect()
    check([(i, (v + [0.0])[:2]) for i, v in rows], got)


def test_repeated_rows_and_rows_without_an_id_count(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, -1.0]), (2, [0.0, 0.5])]
    got = whiten(frame(spark, rows)).collect()
    assert {r["n"] for r in got} == {4} and len(got) == 8
    assert sorted(str(r["vec_id"]) for r in got) == sorted(["1"] * 4 + ["None"] * 2 + ["2"] * 2)


def test_constant_dimensions_have_no_whitened_value(spark):
    rows = [(i, [float(i), 7.0, float(2 * i)]) for i in range(6)]
    got = whiten(frame(spark, rows)).collect()
    assert {r["component"] for r in got if r["whitened"] is None} == {2, 3}
    assert all(r["explained"] == pytest.approx(1) for r in got if r["component"] == 1)
    assert all(r["identity_error"] < 1e-9 for r in got)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])]])
def test_nothing_to_fit(spark, rows):
    assert whiten(frame(spark, rows)).collect() == []


def test_one_vector(spark):
    (row,) = whiten(frame(spark, [(1, [2.5])])).collect()
    assert (row["n"], row["deviation"], row["whitened"], row["explained"]) == (1, 0, None, 0.0)


@pytest.mark.parametrize("kind", ["plain", "low rank", "equal values", "repeated"])
def test_updates_keep_eigenpairs(kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 12)) * np.geomspace(1, 30, 12)
    if kind == "low rank":
        x = rng.normal(size=(300, 3)) @ rng.normal(size=(3, 12))
    if kind == "equal values":
        x = np.vstack([np.eye(12), -np.eye(12)] * 3)
    if kind == "repeated":
        x = np.repeat(rng.integers(-9, 9, size=(4, 12)), 20, axis=0).astype(float)
    parts = []
    for rows in np.array_split(x, 4):
        own = Spectrum.empty(12)
        for row in rows:
            own.add(row)
        parts.append(own)
    whole = parts[0]
    for other in parts[1:]:
        whole.join(other)
    centred = x - x.mean(axis=0)
    scatter = centred.T @ centred
    assert whole.rows == len(x) and np.allclose(whole.mean, x.mean(axis=0))
    assert np.abs(whole.vectors.T @ whole.vectors - np.eye(12)).max() < 1e-12
    assert np.abs(whole.vectors * whole.values @ whole.vectors.T - scatter).max() < 1e-11 * np.abs(scatter).max()
