"""Virtual slots, their versioned map, places in shards."""

import zlib
from collections import Counter, defaultdict

import pytest

from millrace.llm import sharding
from millrace.llm.catalogue import QUERIES
from tests.conftest import SMALL
from tests.llm.conftest import by_id

COLUMNS = ("doc_id", "size", "text_crc32", "shard", "position")


@pytest.fixture(scope="module")
def rows():
    return [(k, "é" * (k * 37 % 400)) for k in range(300)] + [(300, None), (301, ""), (None, "no id"), (None, "none here"), (7, "again"), (7, "again"), (302, "x" * 200_000)]


def test_places_are_gapless_and_sizes_even(docs, rows):
    found = by_id(sharding.place(docs(*rows), 5), *COLUMNS)
    assert len(found) == len(rows)
    texts = defaultdict(list)
    for k, t in rows:
        texts[k].append((t or "").encode())
    assert Counter((k, s, c) for k, s, c, *_ in found) == Counter((k, len(t) + 1, zlib.crc32(t)) for k, ts in texts.items() for t in ts)
    places, held = defaultdict(list), Counter()
    for _, size, _, shard, place in found:
        places[shard].append(place)
        held[shard] += size
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    # one text is larger than all the others together: the other shards share what is left
    rest = [held[s] for s in range(5) if held[s] < 200_000]
    assert len(rest) == 4 and max(rest) - min(rest) < 900


def test_same_rows_same_places(docs, rows):
    one, two = (by_id(sharding.place(docs(*r, parts=p), 3), *COLUMNS) for r, p in ((rows, 2), (rows[::-1], 5)))
    assert one == two


def test_growing_moves_slots_only_and_balances():
    loads = [(s, 100 + s % 7, 1) for s in range(1000)]
    first = sharding.balanced(loads, 8, 1000)
    grown = sharding.rebalanced(first, loads, 9)
    assert grown.version == first.version + 1
    moved = [s for s in range(1000) if first.shard_of[s] != grown.shard_of[s]]
    assert {grown.shard_of[s] for s in moved} == {8} and len(moved) < 1000 / 8
    held = Counter()
    for slot, size, _ in loads:
        held[grown.shard_of[slot]] += size
    assert max(held.values()) < 1.03 * sum(held.values()) / 9
    shrunk = sharding.rebalanced(grown, loads, 8)
    assert set(shrunk.shard_of) == set(range(8))


def test_map_versions_are_stored(spark, tmp_path):
    first = sharding.balanced([(0, 5, 1), (3, 9, 1)], 2, 16)
    second = sharding.rebalanced(first, [(0, 5, 1), (3, 9, 1)], 3)
    for one in (first, second):
        sharding.store(spark, one, str(tmp_path / "map"))
    assert sharding.load(spark, str(tmp_path / "map")) == second
    assert sharding.load(spark, str(tmp_path / "map"), 1) == first


def test_shard_column_and_empty_table(docs, rows):
    df = docs(*rows).drop("shard")
    slot_map = sharding.balanced(sharding.slot_loads(sharding.slotted(df)), 5)
    placed = sharding.place(df, 5, slot_map=slot_map)
    assert by_id(sharding.with_shard(df, slot_map), "doc_id", "shard") == by_id(placed, "doc_id", "shard")
    assert sharding.place(df.where("false"), 4).count() == 0


def test_query_reads_both_versions_of_its_map(spark):
    rows = QUERIES["op4_sharding"](spark, SMALL).collect()
    assert {(r.map_version, r.next_version) for r in rows} == {(1, 2)}
    assert {r.next_shard for r in rows} == set(range(17)) and {r.shard for r in rows} == set(range(16))
    moved = {r.next_shard for r in rows if r.next_shard != r.shard}
    by_slot = Counter(r.virtual_slot for r in {(r.virtual_slot, r.shard, r.next_shard): r for r in rows}.values())
    assert 16 in moved and max(by_slot.values()) == 1
    assert sum(r.next_shard != r.shard for r in rows) < len(rows) / 4
