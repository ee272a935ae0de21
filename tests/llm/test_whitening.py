import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from pickwise.llm import whitening
from pickwise.llm.queries import op12_whitening

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        # Names that an operator might want for itself.
        T.StructField("x", T.StringType()),
        T.StructField("component", T.StringType()),
        T.StructField("place", T.StringType()),
    ]
)


def table(spark, rows, doubles=False):
    schema = T.StructType(
        [T.StructField("embedding", T.ArrayType(T.DoubleType())) if f.name == "embedding" and doubles else f for f in SCHEMA]
    )
    return spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], schema)


def plain(rows, components=4):
    """The same by fractions: id, n, exact deviation, and the parts of the whitening."""
    usable = [
        (i, tuple(math.floor(256 * float(c)) for c in v))
        for i, v in rows
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    x = np.array(sorted({v for _, v in usable}), dtype=object)
    n, d = x.shape
    sums = [sum(column) for column in x.T]
    y = [[n * a - s for a, s in zip(row, sums)] for row in x]
    v = np.array(
        [[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(d)] for i in range(d)]
    )
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    out = {}
    for i, row in usable:
        deviation = sum((n * a - s) ** 2 for a, s in zip(row, sums))
        centred = np.array([float(Fraction(n * a - s, n)) for a, s in zip(row, sums)])
        out.setdefault(i, []).append((n, deviation, centred @ axes / np.sqrt(values)))
    return out, values / np.trace(v)


def compare(got, rows):
    expected, explained = plain(rows)
    assert len(got) == sum(map(len, expected.values())) * len(explained)
    signs = {}
    for r in got:
        n, deviation, w = expected[r.vec_id][0]
        assert (r.n, int(r.deviation)) == (n, deviation)
        k = r.component - 1
        if abs(w[k]) > 1e-6:
            sign = round(r.whitened / w[k])
            assert abs(sign) == 1 and signs.setdefault(k, sign) == sign
        assert abs(r.whitened) == pytest.approx(abs(w[k]), abs=1e-8)
        assert r.explained == pytest.approx(explained[k], rel=1e-9)
        assert r.identity_error < 1e-9


def test_query_against_fractions(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    compare(op12_whitening(spark, sf_dir).collect(), [(r[0], r[1]) for r in given][:10_000])


def test_nulls_repeats_and_long_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=5).astype(np.float32).tolist()) for i in range(300)]
    rows += [(7, rows[7][1])] * 200 + [(None, rows[8][1])]
    bad = [
        (900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0]), (903, [float("nan")] * 5),
        (904, [float("inf")] * 5), (905, [1.0] * 4), (906, [1e30] * 5),
    ]
    got = whitening.results(whitening.whiten(table(spark, rows + bad))).collect()
    compare(got, rows)
    assert sum(r.vec_id == 7 for r in got) == 201 * 4 and sum(r.vec_id is None for r in got) == 4


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=3) * 1e14).tolist()) for i in range(40)]
    compare(whitening.whiten(table(spark, rows, doubles=True)).collect(), rows)
    larger = [(i, [4e14 * i, 1.0 * i * i]) for i in range(40)]
    got = whitening.whiten(table(spark, larger, doubles=True)).collect()
    expected = {i: e[0][1] for i, e in plain(larger)[0].items()}
    assert {r.vec_id: r.deviation and int(r.deviation) for r in got} == {
        i: e if e < 10**38 else None for i, e in expected.items()
    }
    assert None in {r.deviation for r in got} and all(
        r.deviation is None for r in whitening.results(whitening.whiten(table(spark, larger, doubles=True))).collect()
    )


def test_empty_table_single_vector_and_flat_dimension(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None)])).collect() == []
    one = whitening.whiten(table(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [
        (1, 0, None, None, None)
    ] * 4
    flat = whitening.whiten(table(spark, [(k, [k / 7, 3.0, 1.0]) for k in range(9)])).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in flat)
    assert {r.explained for r in flat if r.component > 1} == {0.0}
    assert all(r.identity_error < 1e-9 for r in flat)


def test_sums_are_squares_only():
    """Covariances come from variances of sums; compared with products on random whole numbers."""
    rng = np.random.default_rng(1)
    x = rng.integers(-(10**12), 10**12, (50, 4))
    n, sums = len(x), [int(s) for s in x.astype(object).sum(0)]
    middle = np.array([(2 * s + n) // (2 * n) for s in sums])
    rest = [n * int(m) - s for m, s in zip(middle, sums)]
    got = whitening.covariance(n, rest, whitening.squared_sums(x - middle))
    y = x.astype(object) * n - np.array(sums, object)
    for i in range(4):
        for j in range(4):
            assert got[i, j] == float(Fraction(int((y[:, i] * y[:, j]).sum()), n**3))


def test_digits():
    for value in (0, 1, -1, 3**90, -(3**90)):
        assert sum(d << (32 * k) for k, d in enumerate(whitening._split(value))) == value
