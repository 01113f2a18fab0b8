import hashlib
import random

import numpy as np
import pytest

from logtide.llm import fmindex
from logtide.llm.fmindex import FMIndex, Wavelet, contamination, remove_passages, suffix_order


def words_of(text):
    keep = lambda c: c.isascii() and c.isalnum() or not c.isascii()
    return "".join((c.lower() if c.isascii() else c) if keep(c) else " " for c in text or "").split(" ")


def brute(docs, items, window):
    phrases = {}
    for name, text in items:
        own = [w for w in words_of(text) if w]
        if own:
            for i in range(max(1, len(own) - window + 1)):
                phrases.setdefault(tuple(own[i : i + window]), set()).add(name if name is None else str(name))
    out = {}
    for k, text in docs:
        own = [w for w in words_of(text) if w]
        hit, found = set(), set()
        for size in {len(p) for p in phrases}:
            for i in range(len(own) - size + 1):
                if names := phrases.get(tuple(own[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(f for f in found if f is not None)).encode()).hexdigest()
        out[k] = (len(own), len(hit), len(found), digest, bool(hit))
    return out


def data(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "the", "É", "x1", f"w{rng.randrange(40)}"])
    items = [(k, " ".join(word() for _ in range(rng.choice([0, 1, 3, 10, 25])))) for k in range(25)]
    items += [(99, None), (98, ""), (None, "a b the"), (3, items[5][1])]
    docs = []
    for k in range(80):
        parts = []
        for _ in range(rng.randrange(6)):
            parts.append(rng.choice([rng.choice(items)[1] or "", " ".join(f"z{rng.randrange(9)}" for _ in range(8)), word()]))
        docs.append((k, rng.choice([" ", "; ", "\n"]).join(parts).upper() if k % 3 else " ".join(parts)))
    return docs + [(100, None), (101, ""), (102, "...")], items


@pytest.mark.parametrize(("seed", "block"), [(1, 200_000), (2, 7)])
def test_equal_to_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(fmindex, "PHRASES", block)
    docs, items = data(seed)
    if block == 7:
        docs, items = docs[:20] + docs[-3:], items[:6] + items[-4:]
    got = contamination(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), 10
    )
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == brute(docs, items, 10)


def test_cutting_keeps_the_rest(spark):
    item = " ".join(f"q{k}" for k in range(12))
    docs = [(1, f"Keep this, {item.upper()}! and that.", "x"), (2, "clean  text", None), (3, item, "z"), (4, None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, n_hit string")
    got = {r.doc_id: r for r in remove_passages(df, spark.createDataFrame([("i", item)], "item_id string, text string")).collect()}
    assert got[1].text == "Keep this, and that."
    assert (got[2].text, got[2].n_hit) == ("clean  text", 0)
    assert (got[3].text, got[3].n_hit) == ("", 12)


def test_nothing_to_find(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs, none).first()[1:4] == (2, 0, 0)
    assert contamination(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_index_finds_every_place():
    rng = np.random.default_rng(1)
    sequence = rng.integers(1, 4, 300)
    sequence[[50, 51, 199, 299]] = 0
    index = FMIndex(sequence, 3)
    for size in (1, 2, 5):
        for _ in range(40):
            phrase = rng.integers(1, 4, size)
            low, high = index.search(phrase, np.array([0, size]))
            got = sorted(index.locate(np.arange(low[0], high[0])))
            assert got == [i for i in range(300 - size + 1) if (sequence[i : i + size] == phrase).all()]


def test_ranks_and_suffixes():
    rng = np.random.default_rng(2)
    symbols = rng.integers(0, 9, 200)
    tree = Wavelet(symbols, 8)
    at, of = rng.integers(0, 201, 50), rng.integers(0, 9, 50)
    assert tree.rank(of, at).tolist() == [int((symbols[:i] == s).sum()) for i, s in zip(at, of)]
    got, rank = tree.symbol_and_rank(np.arange(200))
    assert (got == symbols).all() and rank.tolist() == [int((symbols[:i] == symbols[i]).sum()) for i in range(200)]
    sequence = np.append(rng.integers(1, 3, 60), 0)
    order = suffix_order(sequence)
    assert order.tolist() == sorted(range(61), key=lambda i: sequence[i:].tolist())
