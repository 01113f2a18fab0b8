import hashlib
import random

import pytest

from logtide.llm.infill import Frames, digest, digests, infill, infill_plan, restore, store_frames, texts, transform


def brute(k, text):
    text = text or ""
    key = hashlib.sha256(f"1:{'' if k is None else k}".encode()).hexdigest()
    h = [int(key[8 * j : 8 * j + 8], 16) for j in range(4)]
    n = len(text)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (k, n, "plain", None, None, sha(text), sha(text)), text
    p, m, s = text[:low], text[low:high], text[high:]
    spm = h[3] % 100 < 20
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return (k, n, "spm" if spm else "psm", low, high - low, sha(out), sha(text)), out


def documents(seed, count):
    rng = random.Random(seed)
    alphabet = "aé漢😀 \n<PSM>\x00"
    rows = [(k, "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 2, 5, 40, 300])))) for k in range(count)]
    rows += [(-5, "<P"), (-6, "a<S>b"), (-7, "<"), (7, "again"), (7, "again"), (None, "no id at all"), (-8, None), (-9, "<S<P<M")]
    return rows + [(-20, "long 漢字 text " * 20_000)]


@pytest.mark.parametrize("units", [1, 2, 7, 16_384])
def test_outputs_and_digests_equal_brute_force(spark, units):
    rows = documents(units, 120)
    if units < 7:
        rows = rows[:-1]  # a frame for each character of a long text only takes long
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, form int").repartition(4)
    made = infill(infill_plan(store_frames(df, frame_units=units)))
    want = [brute(*r) for r in rows]
    assert sorted(map(tuple, digests(made).collect()), key=str) == sorted((w for w, _ in want), key=str)
    assert sorted(map(tuple, texts(made).collect()), key=str) == sorted(((w[0], out) for w, out in want), key=str)
    assert {w[2] for w, _ in want} == {"plain", "psm", "spm"}


def test_ranges_move_whole_frames():
    text = "".join(chr(97 + k % 26) for k in range(100))
    source = Frames.of(text, 10)
    made = transform(source, "psm", 25, 60)
    assert sum(b in source.blobs for b in made.blobs) == 9  # only the frame with the first cut is made anew
    assert "".join(made.read()) == f"<P>{text[:25]}<S>{text[60:]}<M>{text[25:60]}"
    for form, low, high in [("psm", 0, 0), ("psm", 100, 100), ("spm", 0, 100), ("spm", 33, 34), ("plain", 3, 4)]:
        assert "".join(restore(transform(source, form, low, high), form)) == text
    assert ["".join(source.read(a, b)) for a, b in [(0, 0), (5, 15), (10, 20), (99, 100), (100, 100)]] == [
        text[a:b] for a, b in [(0, 0), (5, 15), (10, 20), (99, 100), (100, 100)]
    ]
    assert Frames.of("ab<S>c", 3).find("<S>") == 2 and Frames.of("ab<", 1).find("<S>") == -1
    assert digest(Frames.of("", 10).read()) == hashlib.sha256(b"").hexdigest()


def test_empty_table_and_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, frames int")
    got = digests(infill(infill_plan(store_frames(df))))
    assert got.count() == 0 and got.columns == [
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256",
    ]
    ids = spark.createDataFrame([("x", "some text"), ("y", None)], "doc_id string, text string")
    assert sorted(map(tuple, digests(infill(infill_plan(store_frames(ids)))).collect())) == sorted(brute(k, t)[0] for k, t in [("x", "some text"), ("y", None)])
