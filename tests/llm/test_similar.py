"""Groups by exact shingle similarity against brute force over all pairs."""

import random

import pytest

import numpy as np
import pyarrow as pa

from millrace.llm import shared, simhash, similar
from tests.llm.conftest import by_id


def brute_sets(texts, shingle=5, similarity=0.8):
    """Least row of each row's group."""
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[k:k + shingle]) for k in range(max(1, len(words) - shingle + 1))} if words else set())
    top = list(range(len(sets)))
    pairs = [(a, b) for b in range(len(sets)) for a in range(b)
             if sets[a] == sets[b] or len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9 and sets[a] and sets[b]]
    moved = True
    while moved:
        moved = False
        for a, b in pairs:
            if top[a] != top[b]:
                top[a] = top[b] = min(top[a], top[b])
                moved = True
    return top, len([p for p in pairs if sets[p[0]] != sets[p[1]]])


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = [f"w{k}" for k in range(2000)]
    common = " ".join(rng.choices(words, k=30))  # a passage many texts hold
    base = [" ".join(rng.choices(words, k=rng.randint(5, 300))) + (" " + common if k % 3 == 0 else "") for k in range(40)]
    near = []
    for text in base:
        for _ in range(4):  # near the edge: some are similar enough, some are not
            own = text.split()
            for _ in range(rng.randint(1, max(1, len(own) // 30))):
                own[rng.randrange(len(own))] = rng.choice(words)
            near.append(" ".join(own))
    chain = [" ".join(words[k:k + 60]) for k in range(0, 60, 5)]  # each is like the next only
    return [*base, *near, *chain, *base[:4], base[0].upper(), "", None, " \t ", "a b", "A  b", "a b c d e"]


def test_all_similar_pairs_are_found(docs, texts):
    top, pairs = brute_sets(texts)
    assert pairs > 50
    found = simhash.near_duplicates(docs(*texts), shingle=5, similarity=0.8)
    assert by_id(found, "doc_id", "component_id") == sorted(enumerate(top), key=str)


def test_one_edit_is_one_group(docs):
    """Copies that the four-bit fingerprints of op1 leave apart."""
    rng = random.Random(5)
    words = [rng.choice("abcdefgh") + str(rng.randrange(500)) for _ in range(120)]
    edits = [" ".join([*words[:at], "edited", *words[at + 1:]]) for at in (20, 60, 100)]
    df = docs(" ".join(words), *edits)
    assert by_id(simhash.one_of_each_group(df, shingle=5, similarity=0.8), "doc_id") == [(0,)]
    assert simhash.one_of_each_group(df).count() > 1


def test_nulls_and_empty_table(docs):
    text = "one two three four five six"
    df = docs((4, text), (None, text), (9, text.upper()), (2, None), (3, ""))
    kept = simhash.one_of_each_group(df, shingle=5, similarity=0.8)
    assert by_id(kept, "doc_id") == [(2,), (4,)]
    assert simhash.near_duplicates(docs("a").where("false"), shingle=5, similarity=0.8).count() == 0


def test_sketches_bound_the_common_hashes():
    """Never below the truth, whatever the sizes; below the threshold for sets a little less similar than it."""
    rng = np.random.default_rng(6)
    random_set = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    for n, m in ((1, 1), (10, 400), (500, 500), (500, 620), (3000, 3500), (0, 5), (0, 0)):
        both = random_set(max(n, m) // 2)
        one, two = (np.unique(np.concatenate([both[:k // 2], random_set(k - k // 2)])) for k in (n, m))
        common = len(np.intersect1d(one, two))
        assert common <= similar.most_common(similar.sketch_of(one), similar.sketch_of(two), len(one) + len(two)) <= (len(one) + len(two)) // 2
    for n in (150, 2000, 20_000):
        both = random_set(int(0.86 * n))  # similarity 0.75
        one, two = (np.unique(np.concatenate([both, random_set(n - len(both))])) for _ in range(2))
        assert similar.most_common(similar.sketch_of(one), similar.sketch_of(two), 2 * n) < similar.least_common(2 * n, 0.8)
    crowded = np.arange(5000, dtype=np.uint64) << np.uint64(40)  # all in one bucket
    assert similar.most_common(similar.sketch_of(crowded), similar.sketch_of(crowded), 10_000) == 5000


def test_folding_is_the_sketch_of_fewer_buckets():
    hashes = np.unique(np.random.default_rng(2).integers(0, 1 << 63, 9000, dtype=np.uint64))
    short = np.bincount((hashes % similar.LEAST_BITS).astype(np.int64), minlength=similar.LEAST_BITS) & 1
    assert similar.folded(similar.sketch_of(hashes), similar.LEAST_BITS // 8).tobytes() == np.packbits(short.astype(np.uint8), bitorder="little").tobytes()


@pytest.mark.parametrize("crowd", (1, 3, 7))
def test_blocks_of_crowded_shingles_lose_nothing(docs, texts, crowd, monkeypatch):
    """Every run is dealt into blocks, and the groups stay those of brute force."""
    dealt = similar._blocks
    monkeypatch.setattr(similar, "_blocks", lambda rows, _: dealt(rows, crowd))
    top, _ = brute_sets(texts)
    found = simhash.near_duplicates(docs(*texts), shingle=5, similarity=0.8)
    assert by_id(found, "doc_id", "component_id") == sorted(enumerate(top), key=str)


def test_fingerprints_link_first(docs, texts, monkeypatch):
    """The links of the SimHash fingerprints are checked before any other, and none that holds is left to the shingles."""
    asked = []
    verified = similar._verified

    def told(pairs, rows, named, shingle, similarity, name):
        found = verified(pairs, rows, named, shingle, similarity, name)
        asked.append((name, {tuple(r) for r in found.collect()}, {r.fp: r.bits for r in named.where("n > 0").collect()}))
        return found

    monkeypatch.setattr(similar, "_verified", told)
    simhash.near_duplicates(docs(*texts, "b a", "a b c d"), shingle=5, similarity=0.8).count()
    assert [name for name, _, _ in asked] == ["fingerprint_links", "near_links", "far_links"]
    first, others, bits = asked[0][1], asked[1][1] | asked[2][1], asked[0][2]
    near = {(a, b) for a in bits for b in bits if a > b and ((bits[a] ^ bits[b]) & (2**64 - 1)).bit_count() <= simhash.RADIUS}
    assert first and first <= near and not first & others
    shingles = {similar.set_key(s): s for s in (similar.shingle_set((t or "").encode(), 5) for t in texts)}
    assert bits == {k: simhash.fingerprint(t, 5) - (1 << 64) * (simhash.fingerprint(t, 5) >> 63) for t in [
        (t or "").encode() for t in [*texts, "b a", "a b c d"]] if (k := similar.set_key(similar.shingle_set(t, 5))) in bits}
    holds = {(a, b) for a, b in near if a in shingles and b in shingles
             and len(np.intersect1d(shingles[a], shingles[b])) >= 0.8 * len(np.union1d(shingles[a], shingles[b]))}
    # the links are a forest, so fewer than the pairs
    assert first <= holds and len(first) >= len(holds) / 2


def test_steps_take_batches_in_slices(docs, monkeypatch):
    """What a worker makes of a batch does not grow with the batch, and no row is lost."""
    steps, df = [], docs("a b c d e f")
    kept = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, *kind: steps.append(run) or kept(self, run, *kind))
    similar.set_prints(df, "doc_id", "text", 5)
    n = 3 * shared.SLICE + 1
    batch = pa.RecordBatch.from_arrays([
        pa.array(range(n)), pa.array(range(n)), pa.array([b"some words of text number %d" % k for k in range(n)])], ["id", "mark", "text"])
    out = list(steps[0](iter([batch, batch.slice(0, 0)])))
    assert [b.num_rows for b in out] == [shared.SLICE] * 3 + [1]
    assert [k for b in out for k in b.column(0).to_pylist()] == list(range(n))
    named = [similar.set_key(similar.shingle_set(t.as_py(), 5)) for t in batch.column(2)]
    assert [k for b in out for k in b.column(2).to_pylist()] == named
