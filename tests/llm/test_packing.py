import itertools
import random

import numpy as np
import pytest

from logtide.llm.packing import best_boundaries, pack


def padding(lengths, counts, cuts):
    return sum((min(c for c in cuts if c >= n) - n) * k for n, k in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_are_the_best(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(1, 60), rng.randrange(1, 10)))
    counts = [rng.randrange(1, 50) for _ in lengths]
    for buckets in (1, 2, 3, 20):
        cuts, least = best_boundaries(np.array(lengths), np.array(counts), buckets)
        every = [
            (*inner, lengths[-1])
            for k in range(min(buckets, len(lengths)))
            for inner in itertools.combinations(lengths[:-1], k)
        ]
        assert least == min(padding(lengths, counts, c) for c in every) == padding(lengths, counts, cuts)
        assert len(cuts) <= buckets and cuts == sorted(set(cuts))
    assert best_boundaries(np.array([]), np.array([]), 4) == ([], 0)


def brute(rows, most, buckets, budget):
    pieces = []
    for k, text in rows:
        n = len((text or "").split())
        pieces += [(min(most, n - at), k, at // most) for at in range(0, n, most)] if n else [(0, k, 0)]
    sizes = sorted({p[0] for p in pieces if p[0]})
    counts = [sum(p[0] == s for p in pieces) for s in sizes]
    cuts, _ = best_boundaries(np.array(sizes), np.array(counts), buckets)
    out, done, low = set(), 0, 0
    for cut in cuts:
        own = sorted(p for p in pieces if low < p[0] <= cut)
        out |= {(k, i, i * most, n, cut, done + j // (budget // cut), cut - n) for j, (n, k, i) in enumerate(own)}
        done += -(-len(own) // (budget // cut))
        low = cut
    return out | {(k, 0, 0, 0, None, None, None) for n, k, _ in pieces if not n}


def test_batches_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(k, " ".join(["w"] * rng.choice([0, 1, 5, 5, 5, 9, 30, 75]))) for k in range(200)] + [(900, None), (901, " \n ")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, piece int").repartition(6)
    got = pack(df, max_tokens=20, buckets=3, budget=60).collect()
    assert set(map(tuple, got)) == brute(rows, 20, 3, 60) and len(got) == len(set(got))
    sizes = {}
    for r in got:
        sizes.setdefault(r.batch, []).append(r.bucket)
    assert all(len(set(b)) == 1 and (k is None or len(b) * b[0] <= 60) for k, b in sizes.items())


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, "a b", 7), (1, "a b", 7), (None, "c", -3), (2, "x", None)], "doc_id long, text string, n long")
    got = sorted(map(tuple, pack(df, 4, 2, 8, length_col="n").collect()), key=str)
    assert [r[:4] for r in got] == [(1, 0, 0, 4)] * 2 + [(1, 1, 4, 3)] * 2 + [(2, 0, 0, 0), (None, 0, 0, 0)]
    assert pack(df.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert tuple(pack(empty).first())[3:] == (0, None, None, None)
    with pytest.raises(ValueError):
        pack(df, max_tokens=10, budget=5)


def test_a_very_long_text(spark):
    df = spark.createDataFrame([(1, "w " * 300_000)], "doc_id long, text string")
    got = pack(df, max_tokens=1000).collect()
    assert len(got) == 300 and sum(r.n_tokens for r in got) == 300_000


def test_the_query_counts_tokens(spark):
    from pyspark.sql import functions as F

    from logtide.llm.queries import QUERIES, table
    from logtide.llm.tokens import count_tokens

    folder = "/root/testdata/sf0.001"
    made = QUERIES["op10_packing"](spark, folder).cache()
    want = {r.doc_id: r.n_tokens for r in count_tokens(table(spark, folder, "documents")).collect()}
    assert {r.doc_id: r.n for r in made.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()} == want
    assert made.agg(F.max("n_tokens")).first()[0] <= 2048
    assert made.where("batch IS NOT NULL").groupBy("batch").agg(F.sum("bucket").alias("n")).agg(F.max("n")).first()[0] <= 16384
