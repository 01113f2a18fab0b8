import numpy as np
import pytest

from logtide.llm import whitening
from logtide.llm.whitening import whiten


def brute(rows, components=4):
    """By numpy on the whole table: {row: (n, deviation, |whitened|, explained)} for each kept row."""
    kept = [(k, v) for k, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(256 * float(c))) for c in v] for _, v in kept], object)
    fit = np.array(sorted(set(map(tuple, x))), object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = np.array(fit, float) - np.array(sums, float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for (k, _), row in zip(kept, x):
        deviation = sum(int(n * a - s) ** 2 for a, s in zip(row, sums))
        z = (np.array(row, float) - np.array(sums, float) / n) @ vectors[:, :components] / np.sqrt(values[:components])
        out += [(k, j + 1, n, deviation, z[j], values[j] / values.sum()) for j in range(min(components, len(sums)))]
    return out


def same(got, want):
    """Equal up to the sign of each component, which is one for all rows."""
    got = sorted(((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in got), key=str)
    want = sorted(want, key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    for j in {g[1] for g in got}:
        a, b = (np.array([r[4] for r in rows if r[1] == j]) for rows in (got, want))
        assert np.allclose(a, b, atol=1e-8) or np.allclose(a, -b, atol=1e-8)


@pytest.mark.parametrize("block", [(1024, 1024), (7, 3)])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(whitening, "ROWS_PER_BLOCK", block[0])
    monkeypatch.setattr(whitening, "COLUMNS_PER_BLOCK", block[1])
    monkeypatch.setattr(whitening, "BLOCKS_PER_TASK", 2)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 6)) @ rng.normal(size=(6, 6))
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(base)]
    rows += [(100 + k, rows[3][1]) for k in range(40)] + [(3, rows[3][1])]  # many copies of one vector
    rows += [(200, None), (201, [None] * 6), (202, [float("nan")] * 6), (203, [float("inf")] + [0.0] * 5)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<double>, component int").repartition(5)
    got = whiten(df).collect()
    same(got, brute(rows))
    assert all(r.identity_error < 1e-9 for r in got) and len({r.identity_error for r in got}) == 1
    copies = [r.whitened for r in got if r.component == 1 and r.vec_id >= 100]
    assert len(copies) == 40 and len(set(copies)) == 1


def test_the_query_equals_brute_force(spark):
    from logtide.llm.queries import QUERIES, table

    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in table(spark, folder, "embeddings").collect()]
    got = QUERIES["op11_whitening"](spark, folder).collect()
    same(got, brute(rows))
    assert max(r.identity_error for r in got) < 1e-9


def make(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_odd_tables(spark):
    assert whiten(make(spark, [])).collect() == [] and whiten(make(spark, [(1, None), (2, [None])])).collect() == []
    assert whiten(make(spark, [(1, []), (2, [])])).collect() == []
    got = whiten(make(spark, [(1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()  # one distinct vector: no variance
    assert sorted(map(tuple, got), key=str) == sorted(
        [(k, j, 1, 0, None, None, 0.0) for k in (1, None) for j in (1, 2)], key=str
    )
    line = whiten(make(spark, [(k, [float(k), 2.0 * k]) for k in range(9)])).collect()  # variance along one line only
    assert {r.component: round(r.explained, 9) for r in line} == {1: 1.0, 2: 0.0}
    assert all((r.whitened is None) == (r.component == 2) for r in line)


def test_shorter_vectors_end_in_zeros(spark):
    rows = [(1, [1.0]), (2, [1.0, 0.0]), (3, [2.0, 5.0]), (4, [0.5, -3.0])]
    got = whiten(make(spark, rows)).collect()
    same(got, brute([(k, v + [0.0] * (2 - len(v))) for k, v in rows]))


def test_deviations_beyond_a_long(spark):
    rows = [(1, [1e15, 1.0]), (2, [0.0, 2.0]), (3, [5e5, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in whiten(df).where("component = 1").collect()}
    want = {k: d if d < 1 << 63 else None for k, j, _, d, *_ in brute(rows) if j == 1}
    assert got == want
    assert all(d is None for d in {r.vec_id: r.deviation for r in whiten(spark.createDataFrame([(1, [1e300]), (2, [0.0])], df.schema)).collect()}.values())
