import math
from fractions import Fraction

import numpy as np
import pytest

from gradewise.llm import queries, whitening
from gradewise.llm.whitening import LARGEST, fit_whitening, from_digits, to_digits, usable, whitened_components

SCHEMA = "vec_id bigint, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def table(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], schema)


def random_vectors(n, width, seed=1):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, width)) @ rng.normal(size=(width, width)) * 0.1 + rng.normal(size=width)
    return [[float(c) for c in row] for row in mixed.astype(np.float32)]


def exact(vectors):
    """x, sums and covariance by fractions."""
    x = [[math.floor(1024 * Fraction(c)) + 100_000 for c in v] for v in vectors]
    n, width = len(x), len(x[0])
    sums = [sum(row[i] for row in x) for i in range(width)]
    apart = [[Fraction(row[i]) - Fraction(sums[i], n) for i in range(width)] for row in x]
    cov = [[float(sum(a[i] * a[j] for a in apart) / n) for j in range(width)] for i in range(width)]
    return x, sums, np.array(cov), np.array([[float(a) for a in row] for row in apart])


def test_equals_fractions_and_a_plain_eigendecomposition(spark):
    vectors = random_vectors(150, 12)
    x, sums, cov, apart = exact(vectors)
    n = len(x)
    values, unit = np.linalg.eigh(cov)
    found = whitened_components(table(spark, vectors).repartition(4)).collect()
    assert len(found) == n * 8 and {r.component for r in found} == set(range(1, 9))
    for c in range(1, 9):
        rows = sorted((r for r in found if r.component == c), key=lambda r: r.vec_id)
        expected = apart @ unit[:, -c] / math.sqrt(values[-c])
        got = np.array([r.whitened for r in rows])
        assert min(np.abs(got - expected).max(), np.abs(got + expected).max()) < 1e-8
        assert rows[0].explained == pytest.approx(values[-c] / np.trace(cov), rel=1e-9)
        for r in rows:
            assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x[r.vec_id], sums))
            assert r.identity_error < 1e-9


def test_covariance_is_exact_whatever_the_partitions(spark, monkeypatch):
    vectors = random_vectors(90, 7, seed=2)
    one = fit_whitening(table(spark, vectors).coalesce(1))
    monkeypatch.setattr(whitening, "ROWS", 4)
    many = fit_whitening(table(spark, vectors).repartition(9))
    assert one.sums == many.sums == exact(vectors)[1]
    assert (one.covariance == many.covariance).all() and (one.covariance == exact(vectors)[2]).all()


def test_sums_that_no_long_holds_stay_exact(spark):
    vectors = [[1e12, 1.0], [-1e12, 2.0], [3e12, 2.5], [5e11, 0.0]]
    found = fit_whitening(table(spark, vectors, SCHEMA.replace("float", "double")))
    assert (found.covariance == exact(vectors)[2]).all()
    rows = whitened_components(table(spark, vectors, SCHEMA.replace("float", "double"))).collect()
    assert {r.deviation for r in rows} == {None} and max(r.identity_error for r in rows) < 1e-9


def test_entries_beyond_a_long_are_held_at_the_largest(spark):
    found = fit_whitening(table(spark, [[1e300], [0.0]], SCHEMA.replace("float", "double")))
    assert found.sums == [LARGEST + 200_000]


def test_unusable_vectors_are_left_out(spark):
    good = random_vectors(20, 3)
    bad = [None, [None, 1.0, 2.0], [NAN, 1.0, 2.0], [1.0, INF, 2.0], [1.0, 2.0, -INF]]
    rows = whitened_components(table(spark, bad + good)).collect()
    assert {r.vec_id for r in rows} == set(range(5, 25)) and {r.n for r in rows} == {20}
    assert {r.component for r in rows} == {1, 2, 3}
    kept = table(spark, bad + good).filter(usable(queries.F.col("embedding"))).count()
    assert kept == 20


def test_shorter_vectors_end_in_zeros(spark):
    padded, short = [[0.5, 0.25], [0.75, 0.0], [0.0, 0.0]], [[0.5, 0.25], [0.75], []]
    a, b = fit_whitening(table(spark, padded)), fit_whitening(table(spark, short))
    assert a.sums == b.sums and (a.covariance == b.covariance).all()


def test_what_does_not_vary_has_no_length(spark):
    alike = whitened_components(table(spark, [[0.5, 0.25]] * 4)).collect()
    assert len(alike) == 8
    assert {(r.whitened, r.explained, r.deviation, r.identity_error) for r in alike} == {(0.0, 0.0, 0, 0.0)}
    flat = whitened_components(table(spark, [[float(i), 1.0] for i in range(5)])).collect()
    assert {r.whitened for r in flat if r.component == 2} == {0.0}
    assert next(r.explained for r in flat if r.component == 1) == pytest.approx(1)
    assert max(r.identity_error for r in flat) < 1e-9


@pytest.mark.parametrize("vectors", [[], [None, [NAN]], [[], []]])
def test_no_vectors_give_no_rows(spark, vectors):
    assert whitened_components(table(spark, vectors)).collect() == []


def test_repeated_keys_and_clashing_columns(spark):
    names = "vec_id bigint, embedding array<float>, vector string, n int, whitened int, i int, component int"
    vectors = random_vectors(10, 2)
    data = [(None if i % 2 else 1, v, "v", 1, 2, 3, 4) for i, v in enumerate(vectors)]
    rows = whitened_components(spark.createDataFrame(data, names)).collect()
    assert len(rows) == 20 and {r.vec_id for r in rows} == {None, 1}
    assert max(r.identity_error for r in rows) < 1e-9


@pytest.mark.parametrize("value", [0, 1, -1, 2**200 + 12345, -(2**199) - 7, 2**32, -(2**32)])
def test_digits_add_up(value):
    assert from_digits(to_digits(value)) == value
    assert from_digits([a + b for a, b in zip(to_digits(value), to_digits(-3 * value))]) == -2 * value


def test_query_of_the_whole_table(spark):
    found = queries.op12_whitening(spark, "/root/testdata/sf0.01")
    total = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").count()
    assert found.count() == 8 * total
    assert found.agg(queries.F.max("identity_error")).first()[0] < 1e-6
