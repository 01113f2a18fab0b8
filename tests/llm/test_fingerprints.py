import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from logtide.llm.spotsigs import edited_neighbours, fingerprint, length_partition, likeness, near_matches, spot_sets


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    out = {}
    for i, (k, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        own, other, after = (set(x.tolist()) for x in spot_sets(pa.array([text, edited, following])))
        near = lambda a, b: len(a & b) / len(a | b) if a and b else float(a == b)
        out[k] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), near(own, other), near(own, after))
    return out


@pytest.mark.parametrize("bucket_bytes", [8 << 20, 300])
def test_neighbours_equal_brute_force(spark, bucket_bytes):
    rng = random.Random(2)
    vocabulary = ["the", "of", "und", "la"] + [f"wört{k}" for k in range(40)]
    rows = [(k * 3 - 50, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60)))) for k in range(90)]
    rows += [(1000, None), (1001, ""), (1002, "?!"), (None, "the very first of all")]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, near_next double").repartition(5)
    got = edited_neighbours(df, bucket_bytes=bucket_bytes).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got} == brute(rows)
    assert len(got) == len(rows)


def test_equal_texts_and_odd_tables(spark):
    rows = [(1, "the big dog of war and peace"), (1, "the big dog of war and peace"), (2, "the big dog of war and peace")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = edited_neighbours(df).collect()
    assert len(got) == 3 and len({r.fingerprint for r in got}) == 1 and all(r.near_next == 1 for r in got)
    one = edited_neighbours(df.limit(1)).first()
    assert (one.near_edited, one.near_next) == (pytest.approx(one.near_edited), 1.0)
    assert edited_neighbours(df.limit(0)).count() == 0
    assert edited_neighbours(df.limit(0)).columns == edited_neighbours(df).columns


def test_only_the_empty_text_has_no_spots():
    sets = spot_sets(pa.array(["", "?", "a", "x y", "the cat sat", "b " * 50_000]))
    assert [len(s) > 0 for s in sets] == [False, True, True, True, True, True]
    assert fingerprint(sets[0]) == ""


def test_anchors_and_chains():
    one, two = spot_sets(pa.array(["Say the quick (brown) fox of all", "The quick brown fox, and all of it!"]))
    assert len(np.intersect1d(one, two)) >= 1


def test_pruning_never_hides_a_likely_pair():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.uint32)) for _ in range(2))
        exact, pruned = likeness(a, b), likeness(a, b, 0.5)
        assert pruned == exact or exact < 0.5 and pruned == 0
    assert abs(length_partition(100, 0.8) - length_partition(80, 0.8)) <= 1


@pytest.mark.parametrize("least", [0.2, 0.5, 0.8, 1.0])
def test_matches_at_distant_ids_equal_brute_force(spark, least):
    rng = random.Random(3)
    vocabulary = ["the", "of", "und", "la"] + [f"wört{k}" for k in range(40)]
    rows = []
    for k in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(3, 70))]
        for copy in range(4):  # the same, with some words at the end replaced
            gone = rng.randrange(len(words) // 2 + 1) * (copy > 0)
            rows.append((copy * 1000 + k, " ".join(words[: len(words) - gone] + [rng.choice(vocabulary) for _ in range(rng.randrange(gone + 1))])))
    rows += [(9000, None), (9001, ""), (9002, "?!"), (None, rows[3][1]), (None, "quite alone"), (3, rows[3][1])]
    rng.shuffle(rows)
    sets = spot_sets(pa.array([t or "" for _, t in rows]))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if likeness(sets[i], sets[j]) >= least and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    ids = lambda g: [k for (k, _), h in zip(rows, group) if h == g and k is not None]
    want = [(k, len(s), min(ids(g), default=None)) for (k, _), s, g in zip(rows, sets, group)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, near_matches(df, least).collect()), key=str) == sorted(want, key=str)
    assert near_matches(df.limit(0), least).count() == 0
