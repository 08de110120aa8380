"""Pipeline stages on odd rows: nulls, empty and long texts, repeats, clashing names, empty tables."""

import pytest

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.conftest import by_id

STAGES = dict(corpus_pipeline.STAGES)
LONG = " ".join(f"word{k}" for k in range(20_000))
WHOLE = "a calm text about rivers and the boats that cross them"
ROWS = [(1, None), (2, ""), (3, WHOLE), (3, WHOLE), (None, LONG), (5, "short"), (6, WHOLE.upper())]
ALL = sorted([(i,) for i, _ in ROWS], key=str)
KEPT = {"toxicity": ALL, "near_duplicates": sorted([(1,), (3,), (3,), (None,), (5,)], key=str), "decontamination": ALL}


@pytest.mark.parametrize("name", sorted(KEPT))
def test_odd_rows(spark, docs, name):
    df = docs(*ROWS)
    out = STAGES[name](spark, df, SMALL)
    assert out.columns == df.columns and by_id(out, "doc_id") == KEPT[name]


def test_odd_rows_are_mixed_and_sharded(spark, docs):
    df = docs(*ROWS)
    out = STAGES["mixing"](spark, df, SMALL)
    assert out.columns == df.columns and {(1,), (2,)} <= set(by_id(out, "doc_id"))
    rows = STAGES["sharding"](spark, df.drop("shard"), SMALL)
    assert by_id(rows, "doc_id") == ALL and all(0 <= r.shard < corpus_pipeline.SHARDS for r in rows.collect())


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_table(spark, docs, name):
    df = docs("a").where("false").drop("shard")
    assert STAGES[name](spark, df, SMALL).count() == 0
