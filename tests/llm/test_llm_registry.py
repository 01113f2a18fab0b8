import re

import pytest

import corpus_pipeline
from check import connect, rows_of
from logtide.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    result = connect(FOLDER).execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(result.fetchall(), columns)


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_entry_registers_them():
    import __spark_entry__ as contract

    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "MinHash near-dedup", "substring dedup", "benchmark decontamination", "packing",
    ]
