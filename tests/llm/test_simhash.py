"""Fingerprints and groups against a brute-force version."""

import random

import numpy as np
import pytest
import xxhash

from millrace.llm import components, simhash
from tests.llm.conftest import by_id


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k:k + 4]) for k in range(len(words) - 3)] if len(words) >= 4 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(prints, radius=4):
    """Least key reachable from each of the fingerprints."""
    top = {p: p for p in prints}
    moved = True
    while moved:
        moved = False
        for a in prints:
            least = min(top[b] for b in prints if (a ^ b).bit_count() <= radius)
            if least < top[a]:
                top[a], moved = least, True
    return top


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    base = [" ".join(rng.choices(words, k=rng.randint(5, 400))) for _ in range(25)]
    near = []
    for text in base[:12]:
        for _ in range(6):
            own = text.split()
            own[rng.randrange(len(own))] = "changed"
            near.append(" ".join(own))
    return [*base, *base[:5], *near, "", None, "  \t ", "ONE two", "one TWO", "É é", "a b c d", "\x0bx\x1fy\x0c", "long " * 30_000]


def test_groups_match_brute_force(docs, texts):
    found = {r.doc_id: r for r in simhash.near_duplicates(docs(*texts)).collect()}
    prints = {k: brute_fingerprint(t) for k, t in enumerate(texts)}
    assert {k: r.fp % (1 << 64) for k, r in found.items()} == prints
    top = brute_groups(sorted(set(prints.values())))
    least = {}
    for k, p in prints.items():
        least[top[p]] = min(least.get(top[p], k), k)
    assert {k: r.component_id for k, r in found.items()} == {k: least[top[p]] for k, p in prints.items()}
    empty = texts.index("")
    assert {found[k].component_id for k in (empty, empty + 1, empty + 2)} == {empty}


def sets_of(pairs, keys):
    forest = components.Forest()
    for a, b in pairs:
        forest.union(a, b)
    return {k: forest.root(k) for k in keys}


@pytest.mark.parametrize("in_task", [1, 3, 10_000])
@pytest.mark.parametrize("blocks", [5, 6, 8])
def test_links_keep_every_group(spark, in_task, blocks):
    """Chains, clusters and lone fingerprints; crowded keys go by common neighbours."""
    if in_task == 1 and blocks != 6:
        pytest.skip("one crowded case is enough")
    rng = random.Random(blocks)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for p in prints[:12]:
        at = p
        for _ in range(5):
            for b in rng.sample(range(64), rng.randint(1, 5)):
                at ^= 1 << b
            prints.append(at)
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = [tuple(r) for r in simhash.near_links(df, blocks=blocks, in_task=in_task).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in links)
    every = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    assert sets_of(links, signed) == sets_of(every, signed)
    assert len(links) <= len(every) * 15


def test_components_of_a_long_chain(spark):
    n = 400
    chain = spark.createDataFrame([(k, k + 1) for k in range(n)] + [(1000, 1001), (1001, 1000), (5, 5)], "a long, b long").repartition(5)
    found = dict(components.components(chain).collect())
    assert {found[k] for k in range(n + 1)} == {0} and found[1001] == found[1000] == 1000


def test_references_are_far_apart():
    apart = np.bitwise_count(simhash.REFERENCES[:, None] ^ simhash.REFERENCES[None, :])
    assert (apart[~np.eye(len(apart), dtype=bool)] == 32).all() and len(apart) >= 16


def test_nulls_repeats_and_empty_table(docs):
    text = "one two three four five"
    df = docs((4, text), (4, text), (None, text), (9, text), (None, "alone at last my friend"), (2, None))  # one group of four rows
    assert by_id(simhash.near_duplicates(df), "doc_id", "component_id") == sorted(
        [(4, 4), (4, 4), (None, 4), (9, 4), (None, None), (2, 2)], key=str)
    kept = simhash.one_of_each_group(df)
    assert kept.columns == df.columns
    assert by_id(kept, "doc_id", "text") == sorted([(4, text), (4, text), (None, "alone at last my friend"), (2, None)], key=str)
    assert simhash.near_duplicates(docs("a").where("false")).count() == 0


def test_radius_must_be_even(spark):
    with pytest.raises(ValueError):
        simhash.near_links(spark.createDataFrame([(1,)], "fp long"), radius=3)
