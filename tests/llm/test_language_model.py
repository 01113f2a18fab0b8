import math
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logtide.llm import langmodel
from logtide.llm.langmodel import language_scores
from logtide.llm.recurrent import OFF, GatedModel, lay_out

END = object()


def tokens(text):
    lower = (text or "").translate({k: k + 32 for k in range(65, 91)})
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), END]


def is_held(k):
    return k is not None and zlib.crc32(str(k).encode()) % 7 == 2


def brute(rows):
    count = Counter(w for k, t in rows if not is_held(k) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    out = []
    for k, text in rows:
        own = tokens(text)
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)
        out.append((k, is_held(k), len(own), sum(count[w] > 0 for w in own), n, base))
    return out


def same(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    want = sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-10, atol=1e-9)


def held():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2


def make(spark, rows):
    return spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, score int")


@pytest.mark.parametrize("counted", [262_144, 20])
def test_counts_and_base_equal_brute_force(spark, monkeypatch, counted):
    """With 20 counted words, most counts come through the join."""
    monkeypatch.setattr(langmodel, "COUNTED", counted)
    rng = random.Random(3)
    words = [f"Wörd{k}" if k % 3 else f"w{k}" for k in range(400)]
    rows = [(k, " ".join(rng.choice(words[: rng.choice([5, 50, 400])]) for _ in range(rng.choice([0, 1, 3, 60])))) for k in range(150)]
    rows += [(None, "no id"), (900, None), (901, ""), (902, " \n"), (903, "same"), (903, "same"), (904, "x " * 40_000)]
    got = language_scores(make(spark, rows).repartition(3), held()).collect()
    same(got, brute(rows))
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_query_beats_counts_on_held_out_texts(spark):
    from logtide.llm.queries import QUERIES, table

    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    got = QUERIES["op13_recurrent"](spark, folder).collect()
    same(got, brute(rows))
    unseen = [r for r in got if r.held_out]
    gain = sum(r.score - r.base_score for r in unseen) / sum(r.n_tokens for r in unseen)
    assert gain > 0.1  # log10 a token


def test_empty_tables_and_nothing_to_learn(spark):
    empty = language_scores(make(spark, []), held())
    assert empty.count() == 0 and empty.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = language_scores(make(spark, [(1, "a b"), (2, None)]), F.lit(True)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert all(math.isfinite(r.score) for r in got)


def model(seed=0, classes=3, members=4, size=5):
    rng = np.random.default_rng(seed)
    made = GatedModel.start(rng.integers(1, 20, classes * members), 9, classes, members, 2, size, seed)
    for v in made.p.values():
        if v.min() > OFF:
            v += rng.normal(scale=0.3, size=v.shape).astype(np.float32)
    return made


def plain(m, ids):
    """Log-probability of one text, a step at a time in doubles."""
    p = {k: v.astype(float) for k, v in m.p.items()}
    n, h, total = p["u"].shape[0], np.zeros(p["u"].shape[0]), 0.0
    lse = lambda x: x - np.log(np.exp(x).sum())
    for t in ids:
        kind = t // m.members
        total += lse(h @ p["wc"] + p["bc"])[kind]
        if kind < m.classes:
            total += lse(h @ p["wm"][kind] + p["bm"][kind])[t % m.members]
        g, a = p["embed"][t] @ p["wx"] + p["bx"], h @ p["u"]
        z, r = (1 / (1 + np.exp(-(g[k * n : k * n + n] + a[k * n : k * n + n]))) for k in (0, 1))
        h = h + z * (np.tanh(g[2 * n :] + r * a[2 * n :]) - h)
    return total


def texts(rng, m, count, longest):
    own = [[*(int(x) for x in rng.integers(0, 13, rng.integers(0, longest)) if x != m.end), m.end] for _ in range(count)]
    return np.array([i for t in own for i in t], np.int32), np.concatenate([[0], np.cumsum([len(t) for t in own])]), own


@pytest.mark.parametrize("lanes,batch", [(1, 1), (3, 40), (50, 16_384)])
def test_state_is_carried_across_windows(lanes, batch):
    m = model()
    ids, first, own = texts(np.random.default_rng(1), m, 20, 120)
    got = m.score(ids, first, least=lanes, most=lanes, batch=batch)
    assert np.allclose(got, [plain(m, t) for t in own], rtol=1e-4)
    assert len(m.score(ids[:0], np.zeros(1, np.int64))) == 0


def test_gradients_equal_differences():
    m = model(4)
    ids, first, own = texts(np.random.default_rng(2), m, 4, 9)
    before = {k: v.copy() for k, v in m.p.items()}
    past = {k: np.zeros_like(v) for k, v in m.p.items()}
    m.train(ids, first, past, rate=0.0, lanes=3, window=100)  # one window: the whole gradient
    for name, squares in past.items():
        flat = before[name].ravel()
        for k in np.random.default_rng(3).choice(flat.size, min(12, flat.size), replace=False):
            parts = []
            for step in (1e-3, -1e-3):
                moved = {n: v.astype(float).copy() for n, v in before.items()}
                moved[name].ravel()[k] += step
                parts.append(-sum(plain(GatedModel(3, 4, m.end, moved), t) for t in own) / len(ids))
            assert abs(abs(parts[0] - parts[1]) / 2e-3 - math.sqrt(squares.ravel()[k])) < 2e-3


def test_training_learns_a_pattern_across_windows():
    m = GatedModel.start(np.array([10, 10, 10]), 1, 2, 2, 2, 8)
    own = [[0, 0, 1, 1] * 30 + [2], [1, 0] * 60 + [2]] * 10
    ids, first = np.array([i for t in own for i in t], np.int32), np.concatenate([[0], np.cumsum([len(t) for t in own])])
    before = m.score(ids, first).sum()
    past = {k: np.full_like(v, 1e-6) for k, v in m.p.items()}
    for _ in range(40):
        m.train(ids, first, past, rate=0.1, lanes=20)
    assert m.score(ids, first).sum() > 0.3 * before


def test_lanes_hold_each_text_in_one_piece():
    first = np.array([0, 3, 3, 10, 11, 20])
    tokens_, owner = lay_out(np.arange(20, dtype=np.int32), first, 2)
    for t in range(5):
        lane = owner == t
        assert tokens_.T[lane.T].tolist() == list(range(first[t], first[t + 1])) and (lane.any(axis=0).sum() <= 1)
    assert (tokens_ >= 0).sum() == 20


def test_training_takes_one_exponential_for_each_output(monkeypatch):
    from logtide.llm import recurrent

    class Counted:
        taken = 0

        def __getattr__(self, name):
            return getattr(np, name)

        def exp(self, x, **more):
            Counted.taken += x.size
            return np.exp(x, **more)

    rng = np.random.default_rng(3)
    ids = rng.integers(0, 16, 900).astype(np.int32)
    first = np.arange(0, 901, 30)
    ids[first[1:] - 1] = 0
    model = recurrent.GatedModel.start(np.bincount(ids, minlength=16), 0, 4, 4, 0, 8)
    past = model.with_flat(np.full_like(model.flat(), 1e-6)).p
    monkeypatch.setattr(recurrent, "np", Counted())
    before = model.train(ids, first, past, 0.1, 8)
    assert Counted.taken <= len(ids) * (4 + 1 + 4)
    assert model.train(ids, first, past, 0.1, 8) > before


@pytest.mark.parametrize("lanes", [1, 3, 50])
def test_training_reads_whole_texts_whatever_the_lanes(lanes):
    """Without updates a pass tells what a plain reading tells, while lanes run dry one after another, and changes nothing."""
    m = model(2)
    ids, first, own = texts(np.random.default_rng(5), m, 12, 90)
    before = {k: v.copy() for k, v in m.p.items()}
    past = {k: np.zeros_like(v) for k, v in m.p.items()}
    assert math.isclose(m.train(ids, first, past, rate=0.0, lanes=lanes, window=4), sum(plain(m, t) for t in own), rel_tol=1e-4)
    assert all((m.p[k] == v).all() for k, v in before.items()) and all(v.any() for v in past.values())


def test_a_training_step_is_a_few_array_operations():
    """Gathers, masks and transposes are made for a window, not for each of its steps."""
    steps, window, calls = 3000, 100, 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "call"

    m = model()
    ids = np.random.default_rng(7).integers(0, 12, steps).astype(np.int32)
    past = {k: np.full_like(v, 1e-6) for k, v in m.p.items()}
    sys.setprofile(count)
    try:
        m.train(ids, np.array([0, steps]), past, rate=0.1, lanes=1, window=window)
    finally:
        sys.setprofile(None)
    assert calls < 2 * steps + 60 * steps / window
