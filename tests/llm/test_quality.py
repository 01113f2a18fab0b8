import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logtide.llm.linecrf import OWN, LineCRF, fit_quality, forward_backward, label_lines, line_features, score_quality


def brute(score, move):
    """Marginals and partition by all label sequences."""
    n = len(score)
    total, good = 0.0, np.zeros(n)
    for code in range(2**n):
        labels = [(code >> k) & 1 for k in range(n)]
        value = sum(score[k, y] for k, y in enumerate(labels)) + sum(move[a, b] for a, b in zip(labels, labels[1:]))
        total += np.exp(value)
        good += np.exp(value) * np.array(labels)
    return good / total, np.log(total)


def test_marginals_equal_all_sequences():
    rng = np.random.default_rng(1)
    first = np.array([0, 3, 3, 4, 10])
    score, move = rng.normal(size=(10, 2)), rng.normal(size=(2, 2))
    log_p, total, _, _ = forward_backward(score, first, move)
    for t in range(4):
        a, b = first[t], first[t + 1]
        if b > a:
            good, z = brute(score[a:b], move)
            assert np.allclose(np.exp(log_p[a:b, 1]), good) and np.isclose(total[t], z)


def test_features_of_lines_and_neighbours():
    x, size, first = line_features(pa.array(["one two\n\n  \nTHREE!! THREE!!", None, "", "a"]))
    assert first.tolist() == [0, 2, 2, 2, 3] and size.tolist() == [7, 15, 1]
    assert (x[0, OWN : 2 * OWN] == 0).all() and (x[0, 2 * OWN :] == x[1, :OWN]).all()
    assert (x[1, OWN : 2 * OWN] == x[0, :OWN]).all() and (x[2, OWN:] == 0).all()
    assert x[1, 3] == 1 and x[1, 12 + 1] > 0  # upper case; the word before again


def text(rng, good):
    lines = []
    for _ in range(rng.randrange(1, 9)):
        words = ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(3, 30))]
        lines.append(" ".join(words) + "." if good else " ".join(w + rng.choice(["%%%", "$$$", "&&"]) for w in words))
    return "\n".join(lines)


def test_learns_planted_quality(spark):
    rng = random.Random(1)
    rows = [(k, text(rng, k % 4 > 0), int(k % 4 > 0)) for k in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    model = fit_quality(docs, labels, F.crc32(F.col("doc_id").cast("string")) % 4 != 2, sample=200)
    got = {r.doc_id: r.score for r in score_quality(docs, model).collect()}
    assert all((got[k] >= 0.7) == bool(q) for k, _, q in rows)
    mixed = spark.createDataFrame([(1, text(random.Random(5), True) + "\n" + "x%%% y$$$ z&& " * 9)], "doc_id long, text string")
    lines = label_lines(mixed, model).orderBy("line").collect()
    assert [r.line for r in lines] == list(range(len(lines))) and lines[0].p_good > lines[-1].p_good


def test_odd_rows(spark):
    width = 3 * OWN
    model = LineCRF(np.zeros(width), np.ones(width), np.ones(width) * 0.1, 0.0, np.zeros((2, 2)))
    rows = [(1, None, "x"), (2, "", None), (2, "  \n ", None), (3, "word", "y"), (3, "word", "y"), (None, "a\n" * 50_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = score_quality(df, model).collect()
    assert len(got) == 6 and [r.score for r in got if not (r.text or "").strip()] == [0, 0, 0]
    assert all(0 <= r.score <= 1 for r in got) and max(r.n_lines for r in got) == 50_000
    assert len({r.score for r in got if r.text == "word"}) == 1
    assert score_quality(df.limit(0), model).count() == 0
    for label, score in ((1, 1), (0, 0), (None, 1)):  # one kind of label, or none
        labels = spark.createDataFrame([(3, label)], "doc_id long, quality int")
        got = score_quality(df.where("text = 'word'"), fit_quality(df, labels, F.lit(True))).collect()
        assert [r.score for r in got] == pytest.approx([score] * 2, abs=1e-6)


def test_held_out_accuracy_and_blindness(spark):
    from logtide.llm.queries import QUERIES, table

    folder = "/root/testdata/sf0.01"
    got = QUERIES["op1_linecrf"](spark, folder).join(table(spark, folder, "labels"), "doc_id").where("held_out")
    right = got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.97


def test_the_longest_text_of_a_fit_is_an_argument(spark):
    rng = random.Random(4)
    rows = [(k, text(rng, True), 1) for k in range(30)] + [(100 + k, "\n".join(text(rng, False) for _ in range(200)), 0) for k in range(10)]
    assert all(len(t) > 50_000 for _, t, q in rows if not q)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    bad = docs.where("doc_id >= 100")
    highest = lambda **more: max(r.score for r in score_quality(bad, fit_quality(docs, labels, F.lit(True), **more)).collect())
    assert highest() > 0.7  # only good texts are short enough
    assert highest(sample_chars=10_000_000) < 0.3


def test_text_ids_are_refused_and_repeated_ids_defined(spark):
    from logtide.llm.hyperminhash import near_duplicates
    from logtide.llm.spotsigs import edited_neighbours, near_matches
    from logtide.llm.superkmers import remove_repeats

    named = spark.createDataFrame([("a", "some text")], "doc_id string, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    for call in (near_duplicates, edited_neighbours, near_matches, remove_repeats, lambda d: fit_quality(d, labels, F.lit(True))):
        with pytest.raises(TypeError):
            call(named)
    rows = [(1, "A good line of words."), (1, "### 1 1 1 ###"), (2, "$$$ 9 9 9 $$$")]
    fits = [fit_quality(spark.createDataFrame(order, "doc_id long, text string"), labels, F.lit(True)) for order in (rows, rows[::-1])]
    assert np.array_equal(fits[0].weights, fits[1].weights)
