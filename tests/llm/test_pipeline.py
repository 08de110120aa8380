"""Queries against their SQL, and the pipeline against its stages' brute-force rules."""

from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from millrace.llm.catalogue import QUERIES, SQL
from tests.compare import difference, duck
from tests.conftest import SMALL
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_similar import brute_sets


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), duck(SMALL), SQL[name]) is None


def test_every_operator_has_its_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= contract.queries().keys() and SQL.keys() <= contract.oracle_sql().keys()


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage makes of the small table."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SMALL), name)
        out.append((docs.columns, docs.collect()))
    return out


def test_stages_filter_as_said(spark, stages):
    columns = list(stages[0][0].asDict())
    assert all(c == columns for c, _ in stages[1:-1]) and stages[-1][0] == [*columns, "shard"]
    before, clean, one, free, mixed, sharded = stages[0], *(rows for _, rows in stages[1:])
    toxic = {r.doc_id for r in QUERIES["op7_toxicity"](spark, SMALL).where("predicted = 1").collect()}
    assert {r.doc_id for r in clean} == {r.doc_id for r in before} - toxic
    top, _ = brute_sets([r.text for r in clean])
    least = {}
    for r, k in zip(clean, top, strict=True):
        least[k] = min(least.get(k, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in one) == sorted(least.values())
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    quick = lambda t: hits(t, items)[1] > 0
    assert {r.doc_id for r in free} == {r.doc_id for r in one if not quick(r.text)}
    times = Counter(r.doc_id for r in mixed)
    assert set(times) <= {r.doc_id for r in free} and max(times.values()) <= 2
    size = lambda rows: sum(len(r.text.split()) for r in rows)
    assert size(mixed) == pytest.approx(1.5 * size(free), rel=0.02)
    assert Counter(r.doc_id for r in sharded) == times and {r.shard for r in sharded} <= set(range(corpus_pipeline.SHARDS))
    held = Counter()
    for r in sharded:
        held[r.shard] += len(r.text.encode()) + 1
    assert max(held.values()) <= max(1.3 * sum(held.values()) / 16, max(2 * len(r.text.encode()) + 2 for r in sharded))


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == stages[-1][0]
    assert Counter((r.doc_id, r.shard) for r in got.collect()) == Counter((r.doc_id, r.shard) for r in stages[-1][1])
