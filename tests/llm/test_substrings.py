import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from logtide.llm.superkmers import remove_repeats, super_kmers


def brute(rows, window):
    """Of each window the first (id, place); words of all later ones go."""
    words = [(k, (text or "").split()) for k, text in rows]
    first = {}
    for k, own in words:
        for i in range(len(own) - window + 1):
            key = tuple(own[i : i + window])
            first[key] = min(first.get(key, (k, i)), (k, i))
    out = {}
    for k, own in words:
        gone = set()
        for i in range(len(own) - window + 1):
            if first[tuple(own[i : i + window])] < (k, i):
                gone.update(range(i, i + window))
        kept = [w for i, w in enumerate(own) if i not in gone]
        out[k] = (len(own), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    passages = [[f"p{i}x{k}" for k in range(rng.choice([6, 20, 45]))] for i in range(5)]
    rows = []
    for k in range(n):
        own = []
        for _ in range(rng.randrange(5)):
            own += rng.choice([rng.choice(passages), [rng.choice(["a", "the", "word"])] * rng.randrange(30), [f"w{rng.randrange(50)}" for _ in range(20)]])
        rows.append((k, rng.choice([" ", "  ", "\n"]).join(own)))
    return rows + [(n, None), (n + 1, ""), (n + 2, "   ")]


@pytest.mark.parametrize("window", [5, 20])
def test_equal_to_brute_force(spark, window):
    rows = corpus(window)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r[0]: tuple(r[1:]) for r in remove_repeats(df, window, digest=True, bucket_bytes=2000).collect()}
    assert got == brute(rows, window)


def test_copies_within_one_task_and_over_many(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [(k, f"start{k} {passage} end{k}") for k in range(300)]
    for parts in (1, 30):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = {r.doc_id: r.n_removed for r in remove_repeats(df, 20, digest=True).collect()}
        assert got == {k: 60 * (k > 0) for k, _ in rows}


def test_text_is_cut_in_place(spark):
    passage = " ".join(f"w{k}" for k in range(25))
    rows = [(1, passage, "x"), (2, f"before,\n{passage}  after\tit", "y"), (3, passage, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = {r.doc_id: r for r in remove_repeats(df, 20).collect()}
    assert got[1].text == passage
    assert got[2].text == "before,\nafter\tit"
    assert got[3].text == "" and got[3].n_removed == 25


def test_ties_and_missing_ids(spark):
    text = " ".join(f"w{k}" for k in range(22))
    rows = [(5, text), (5, text), (None, text), (7, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_removed) for r in remove_repeats(df, 20, digest=True).collect()), key=str)
    assert got == [(5, 22), (5, 22), (7, 22), (None, 0)]
    alone = spark.createDataFrame(rows[:2], "doc_id long, text string")
    assert [r.n_removed for r in remove_repeats(alone, 20, digest=True).collect()] == [0, 0]
    assert remove_repeats(df.limit(0), 20, digest=True).count() == 0


def test_a_very_long_text(spark):
    text = " ".join(f"w{k % 50_000}" for k in range(100_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = remove_repeats(df, 20, digest=True).first()
    assert (row.n_words, row.n_removed) == (100_000, 50_000)


def test_super_kmers_cover_every_window_once():
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(9)}" for _ in range(rng.randrange(90))) for _ in range(20)]
    words, _, _, start, count, owner = super_kmers(pa.array(texts), 20)
    total = np.maximum(np.diff(words.first) - 19, 0)
    assert np.bincount(owner, weights=count, minlength=20).astype(int).tolist() == total.tolist()


@pytest.mark.parametrize("window", [5, 20])
def test_slices_of_few_words(window):
    rng = random.Random(2)
    for n in range(26):
        words = [f"w{rng.randrange(9)}" for _ in range(n)]
        for cut in sorted({n, n // 2, min(n, 3)}):
            texts = [words[:cut], words[cut:]]
            wanted = []
            for t, own in enumerate(texts):
                # a window of one group has that group as its minimiser
                value = [super_kmers(pa.array([" ".join(own[i : i + 3])]), 3)[2][0] for i in range(len(own) - 2)]
                wanted += [(t, i, min(value[i : i + window - 2])) for i in range(len(own) - window + 1)]
            found, _, least, start, count, owner = super_kmers(pa.array([" ".join(t) for t in texts]), window)
            got = [(o, s - found.first[o] + k, m) for m, s, c, o in zip(least, start, count, owner) for k in range(c)]
            assert got == wanted, (n, cut)


def test_tables_of_one_short_text(spark):
    for n in range(26):
        rows = [(1, " ".join(f"w{k}" for k in range(n)))]
        df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        assert {r[0]: tuple(r[1:]) for r in remove_repeats(df, 20, digest=True).collect()} == brute(rows, 20), n
