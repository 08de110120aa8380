"""Raw documents to balanced, sharded training data, one operator a stage.

Each stage works on all that the one before it kept.  Its result is written as Parquet and read
again as the next one's documents, so a lost executor never sets back more than a stage.

Odd rows: null and empty texts are not toxic, are one group of near copies (the least id stays), hold no benchmark
window and are taken once by the mix.  Rows without an id are rows like others; one names its group only if none of the group has an id.
Rows that repeat id and text stay together until the mix, which takes each on its own.  Whole texts count, however long.  Other
columns are kept, whatever their names, but ``shard`` is the last stage's own.  An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, mixing, sharding, simhash, toxicity
from millrace.llm.shared import shared_folder, table, written

SHARDS = 16
# Near copies: word shingles and their Jaccard similarity.
SHINGLE = 5
SIMILARITY = 0.8


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine learned from ``labels`` does not find toxic."""
    return toxicity.clean_rows(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each near-duplicate group: SimHash links, checked exactly, and the similar pairs beyond their radius."""
    return simhash.one_of_each_group(docs, shingle=SHINGLE, similarity=SIMILARITY)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard; the first version of the slot map is stored beside them."""
    slot_map = sharding.balanced(sharding.slot_loads(sharding.slotted(docs)), SHARDS)
    sharding.store(spark, slot_map, f"{shared_folder(spark)}/slot_map")
    return sharding.with_shard(docs, slot_map)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

# Fingerprints, a learned machine and a Newton solution cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
