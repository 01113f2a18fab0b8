import random

import numpy as np
import pytest

from logtide.llm.tokens import Counter, count_tokens, vocabulary

PARTS = ["a", "é", " ", "  ", "\n", "1", "'s", "<|endoftext|>", " ", " ", "日本", "!", "\t", "\x1c", "\u0085", "\u00a0", "\u2003", "\u3000", "\u1680", "can't", " \n ", "word"]


@pytest.fixture(scope="module")
def count():
    return Counter(vocabulary("byte_bpe_50k.json"))


def whole(count, text):
    return len(count.tokenizer.encode(text, add_special_tokens=False))


@pytest.mark.parametrize("seed", range(4))
def test_pieces_and_splices_equal_the_library(count, seed):
    rng = random.Random(seed)
    for _ in range(250):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(80)))
        want = whole(count, text)
        assert count.counts([text]).tolist() == [want], text
        assert count.spliced(text, chunk=rng.choice([8, 13, 32]), overlap=rng.choice([1, 3, 9])) == want, text


def test_overlaps_widen_where_nothing_is_stable(count):
    for text in ("x" * 4000, "ab " * 3 + "y1" * 2000 + " tail", "\n" * 3000, "<|endoftext|>" * 300):
        assert count.spliced(text, chunk=100, overlap=4) == whole(count, text)


def test_a_full_memo_drops_its_least_used_half(count, monkeypatch):
    monkeypatch.setattr("logtide.llm.tokens.MEMO_ENTRIES", 10)
    texts = [f"word{k} other{k}" for k in range(50)]
    for at in range(0, 50, 5):
        assert count.counts(texts[at : at + 5]).tolist() == [whole(count, t) for t in texts[at : at + 5]]
        assert (np.diff(count.one.astype(object)) >= 0).all()


def test_many_texts_at_once(count):
    rng = random.Random(9)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(40))) for _ in range(300)] + ["", " ", "\u3000", "x" * 500, "a b " * 200]
    assert count.counts(texts, chunk=300).tolist() == [whole(count, t) for t in texts]
    assert count.counts([]).tolist() == []


def test_rows(spark, count):
    long = " ".join(f"token{k % 977}" for k in range(20_000))
    rows = [(1, "Hello wörld", 5), (1, "Hello wörld", 5), (2, None, 6), (3, "", 7), (None, long, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = sorted(map(tuple, count_tokens(df, limit=2).collect()), key=str)
    hello = whole(count, "Hello wörld")
    want = [(1, 12, hello, hello > 2)] * 2 + [(2, 0, 0, False), (3, 0, 0, False), (None, len(long), whole(count, long), True)]
    assert got == sorted(want, key=str)
    assert count_tokens(df.limit(0)).count() == 0


def test_query_equals_the_library(spark, count):
    from logtide.llm.queries import QUERIES, table

    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in QUERIES["op2_tokens"](spark, folder).collect()}
    rows = table(spark, folder, "documents").select("doc_id", "text").collect()
    assert got == {r.doc_id: (len((r.text or "").encode()), whole(count, r.text or "")) for r in rows}
