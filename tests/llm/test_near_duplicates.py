import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from logtide.llm import hyperminhash as hm


def brute(texts, size, percent):
    sets = {}
    for k, text in texts:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
        sets[k] = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), find(k), find(k) == k) for k in sets}


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("size", [2, 5])
def test_components_equal_brute_force(spark, size):
    rng = random.Random(size)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([4, 12, 60, 300]))]
        texts += [edited(rng, base, rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.choice([1, 3, 15]))]
    texts += ["", None, "one", "ONE", "two words", "two  words\n", "   "]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: tuple(r[1:]) for r in hm.near_duplicates(df, size, 80).collect()}
    assert got == brute(rows, size, 80)


def test_a_large_group_of_near_copies_with_members_off_the_star(spark):
    """Links that go past the bucket's smallest member are found as well."""
    rng = random.Random(7)
    base = [f"w{k}" for k in range(120)]
    texts = [edited(rng, base, rng.choice([2, 5, 9])) for _ in range(150)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: tuple(r[1:]) for r in hm.near_duplicates(df, 2, 80).collect()}
    assert got == brute(rows, 2, 80)


def test_blocks_do_not_change_the_links(spark, monkeypatch):
    monkeypatch.setattr(hm, "BLOCK_ROWS", 16)
    test_a_large_group_of_near_copies_with_members_off_the_star(spark)


def test_stars_in_slices_keep_every_link(spark, monkeypatch):
    monkeypatch.setattr(hm, "STAR_ROWS", 7)
    test_a_large_group_of_near_copies_with_members_off_the_star(spark)
    rows = spark.createDataFrame([(b, 1, b % 3) for b in range(2, 40)], "b long, a long, slice int")
    centers = hm._centers(rows, spark.createDataFrame([(1, "x"), (2, "y")], "a long, ra string"))
    assert sorted(map(tuple, centers.collect())) == [(1, s, "x") for s in range(3)]


def test_links_past_the_star_join_names_of_components(spark, monkeypatch):
    """What confirmed stars have joined isn't joined again, link by link."""
    calls, keep = [], hm._components
    monkeypatch.setattr(hm, "_components", lambda links: calls.append(links) or keep(links))
    test_a_large_group_of_near_copies_with_members_off_the_star(spark)
    stars, _, last = calls
    known = {r._id: r.component for r in keep(stars).collect()}
    ends = {x for r in last.collect() for x in r}
    assert ends and all(known.get(x, x) == x for x in ends)


def test_odd_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert hm.near_duplicates(empty).count() == 0
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (None, "a b c d e f", "y"), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(map(tuple, hm.near_duplicates(df, 2).collect()), key=str)
    assert got == [(1, 5, 1, True), (1, 5, 1, True), (3, 0, 3, True), (None, 5, None, True)]


def test_a_very_long_text(spark):
    text = " ".join(f"w{k}" for k in range(400_000))
    df = spark.createDataFrame([(1, text), (2, text + " more")], "doc_id long, text string")
    assert [r.component_id for r in hm.near_duplicates(df, 2).collect()] == [1, 1]


def test_estimate_is_near_the_truth():
    rng = np.random.default_rng(3)
    for truth in (0.3, 0.6, 0.9):
        shared = int(4000 * truth)
        union = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2)
        extra = (4000 - shared) // 2
        one, two = np.sort(union[: shared + extra]), np.sort(np.r_[union[:shared], union[shared + extra :]])
        edges = np.arange(hm.REGISTERS, dtype=np.uint64) << np.uint64(64 - hm.REGISTER_BITS)
        smallest = np.array([s[np.searchsorted(s, edges)] for s in (one, two)])
        own, dense = hm.registers(smallest, np.ones_like(smallest, bool))
        got, _ = hm.estimate(own[:1], own[1:], np.array([len(one)]), np.array([len(two)]))
        assert abs(got[0] - truth) < 0.12
        assert (dense == own).all()


def test_empty_registers_borrow():
    smallest = np.zeros((1, hm.REGISTERS), np.uint64)
    filled = np.zeros((1, hm.REGISTERS), bool)
    smallest[0, 7], filled[0, 7] = 12345, True
    own, dense = hm.registers(smallest, filled)
    assert (own >= 0).sum() == 1 and (dense == own[0, 7]).all()


def test_shingles_of_few_words():
    sets = list(hm.shingle_sets(pa.array(["", "a", "a b", "a b a b", "A B"]), 2))
    assert [len(s) for s in sets] == [0, 1, 1, 2, 1]
    assert (sets[2] == sets[4]).all()
