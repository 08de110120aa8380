"""Trees and proofs against a plain recursion over the whole table."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle
from tests.llm.conftest import by_id


def H(*parts):
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def leaf_of(values):
    parts = []
    for v in values:
        raw = None if v is None else str(v).encode()
        parts.append(b"-" if raw is None else str(len(raw)).encode() + b":" + raw)
    return H(*parts)


def climb(nodes, at):
    """Siblings by level as (before, after) of the node at ``at``, and the root."""
    path = []
    while len(nodes) > 1:
        low = at - at % 3
        path.append((nodes[low:at], nodes[at + 1:low + 3]))
        nodes = [H(*nodes[k:k + 3]) for k in range(0, len(nodes), 3)]
        at //= 3
    return path, nodes[0]


def brute(rows):
    """Sorted result rows of (doc_id, source, lang, n_chars, text) rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    leaves = {g: [leaf_of(r) for r in groups[g]] for g in order}
    subroots = [climb(leaves[g], 0)[1] for g in order]
    out = []
    for place, g in enumerate(order):
        for k, r in enumerate(groups[g]):
            below, subroot = climb(leaves[g], k)
            above, root = climb(subroots, place)
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            node = leaf_of((*r[:4], text))
            for before, after in below + above:
                node = H(*before, node, *after)
            proof = H(*(s for before, after in below + above for s in before + after))
            out.append((r[0], leaves[g][k].decode(), subroot.decode(), root.decode(), proof.decode(), node.decode(), node == root))
    return sorted(out, key=str)


def result(docs, **options):
    found = merkle.manifest(docs, tampered=merkle.stripped_of_newlines(), **options)
    return by_id(found, "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def plain(docs):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]


@pytest.mark.parametrize("block", [1, 2, 6])
def test_proofs_equal_recursion(docs, block):
    rng = random.Random(3)
    rows = [(k, f"line {k}\nnext {rng.random()}", rng.choice([None, "", "é", "b", "hot", "hot", "hot"])) for k in range(90)]
    df = docs(*rows, (500, "alone", "only"), (501, "z\n" * 5000, "zz"))
    assert result(df, block=block) == brute(plain(df))


def test_odd_rows(docs):
    """Nulls in every column, empty and long texts, repeated ids and rows."""
    df = docs((None, None, None), (None, "x\ny", "s"), (4, "same\n"), (4, "same\n"), (4, "other"), (6, ""), (7, "a\n" * 100_000), (8, None, "t"))
    df = df.withColumn("lang", F.when(F.col("doc_id") != 6, F.col("lang"))).withColumn("n_chars", F.col("doc_id"))
    assert result(df) == brute(plain(df))


def test_one_row_and_none(docs):
    df = docs((2, "a\nb"))
    (row,) = result(df)
    assert row[1] == row[2] == row[3] and row[4] == hashlib.sha256(b"").hexdigest()
    assert result(df) == brute(plain(df))
    empty = merkle.manifest(df.where("false"), tampered=merkle.stripped_of_newlines())
    assert empty.count() == 0 and empty.columns[0] == "doc_id"


def test_untampered_rows_all_verify(docs):
    found = merkle.manifest(docs(*(f"t{k}\n" for k in range(40))))
    assert found.where("NOT verified OR folded_root <> root").count() == 0


def test_a_hot_group_is_in_many_tasks(docs):
    """No task of the sorted table holds a group's rows."""
    df = docs(*((k, "x", "hot") for k in range(400)), parts=8).selectExpr("doc_id AS id", "source AS part_of", "xxhash64(doc_id) AS leaf")
    placed = merkle.numbered(df.repartition(8), "part_of", ["id"], "sorted")
    assert sorted(r.place for r in placed.collect()) == list(range(400)) and {(r.n, r.tree) for r in placed.collect()} == {(400, 0)}
