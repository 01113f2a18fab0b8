import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from logtide.llm.tokens import Counter, vocabulary

import test_benchmark_passages as passages
import test_near_duplicates as near
import test_packing as packing
import test_substrings as substrings

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage gets and returns."""
    out, docs = {}, cp.table(spark, FOLDER, "documents")
    for name, stage in cp.STAGES:
        made = cp.materialize(stage(spark, docs, FOLDER))
        out[name] = (docs, made)
        docs = made
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns(steps):
    for name, (before, after) in steps.items():
        if name != "packing":
            assert after.schema == before.schema
            assert after.where(F.col("n_chars") != F.length("text")).count() == before.where(F.col("n_chars") != F.length("text")).count()


def test_quality_keeps_good_texts(spark, steps):
    before, after = steps["quality classifier"]
    labels = cp.table(spark, FOLDER, "labels")
    kept = after.select("doc_id", F.lit(1).alias("kept"))
    seen = before.join(labels, "doc_id").join(kept, "doc_id", "left").groupBy("quality").agg(F.avg(F.coalesce("kept", F.lit(0)))).collect()
    share = dict(map(tuple, seen))
    assert share[1] > 0.95 and share.get(0, 0) < 0.1


def test_one_of_each_near_duplicate_group(steps):
    before, after = steps["MinHash near-dedup"]
    want = near.brute(texts(before), 5, 80)
    assert {k for k, _ in texts(after)} == {k for k, v in want.items() if v[2]}


def test_repeated_passages_go(steps):
    before, after = steps["substring dedup"]
    want = substrings.brute(texts(before), 20)
    left = dict(texts(after))
    for k, text in texts(before):
        if want[k][1] == 0:
            assert left[k] == text
        else:
            assert len(left.get(k, "").split()) == want[k][0] - want[k][1]


def test_benchmark_passages_go(spark, steps):
    before, after = steps["benchmark decontamination"]
    items = [(r.item_id, r.text) for r in cp.table(spark, FOLDER, "benchmark").collect()]
    want, left = passages.brute(texts(before), items, 10), dict(texts(after))
    for k, text in texts(before):
        if want[k][1] == 0:
            assert left[k] == text
        else:
            own = [w for w in passages.words_of(left.get(k, "")) if w]
            assert len(own) == want[k][0] - want[k][1]


def test_packing_takes_all(steps):
    before, after = steps["packing"]
    count = Counter(vocabulary("byte_bpe_50k.json")).tokenizer
    sizes = [(k, len(count.encode(text, add_special_tokens=False))) for k, text in texts(before)]
    # `packing.brute` counts words: as many of them as the text has tokens
    assert set(map(tuple, after.collect())) == packing.brute([(k, "w " * n) for k, n in sizes], 2048, 12, 16384)


def test_no_batch_is_above_its_budget_of_tokens(steps):
    _, after = steps["packing"]
    assert after.groupBy("batch").agg(F.sum("bucket").alias("n"), F.max("bucket").alias("most")).where("n > 16384 OR most > 2048").count() == 0


def test_run_is_the_stages(spark, steps):
    assert sorted(map(tuple, cp.run(spark, FOLDER).collect())) == sorted(map(tuple, steps["packing"][1].collect()))


def test_odd_rows_in_every_stage(spark):
    good = " ".join(f"word{k}" for k in range(60))
    rows = [(1, good, None, "s", 5), (2, good, "en", None, None), (2, good, "en", None, None), (None, None, None, None, None), (4, "", "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for df in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in cp.STAGES:
            made = stage(spark, df, FOLDER)
            assert made.count() <= df.count() and (name == "packing" or made.columns == df.columns)
