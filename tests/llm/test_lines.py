"""Line dedup and repeated units: bitmaps, edges of partitions, defined cases."""

import hashlib
import random

import numpy as np
import pytest

from millrace.llm import lines
from tests.llm.conftest import by_id


def brute(rows):
    key = lambda line: line.encode().strip().lower().decode()
    first = {}
    for ident, text in rows:
        for line in (text or "").split("\n"):
            first[key(line)] = min(first.get(key(line), ident), ident)
    out = []
    for ident, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if len(key(x)) < 10 or first[key(x)] == ident]
        out.append((ident, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "n_lines", "n_dropped", "kept_sha256")


@pytest.mark.parametrize("parts", ["1", "7"])
def test_matches_brute_force_with_a_line_in_all(spark, docs, parts):
    rng = random.Random(1)
    pool = ["a line that very many documents hold", "Éléphant déjà vu", "short", "", "   padded LINE with space\t", "padded line with space", "ééééééééé", "éééééééééé"]
    rows = [(k, "\n".join([pool[0]] * rng.randint(0, 3) + rng.choices(pool, k=rng.randint(0, 6)) + [f"only in document {k}"])) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "x" * 50_000 + "\n" + pool[0])]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert by_id(lines.kept_text_digests(docs(*rows)), *COLUMNS) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_bitmaps_round_trip():
    for n, gone in ((1, [0]), (9, [8]), (20, [0, 3, 19]), (20, [7])):
        bits = lines.kept_lines(lines._bitmap(gone), n)
        assert list(np.flatnonzero(~bits)) == gone and len(bits) == n
    assert lines.apply_bitmap(b"a\nb\nc", lines._bitmap([1])) == (b"a\nc", 3, 1)
    assert lines.apply_bitmap(b"", None) == (b"", 1, 0)


def test_no_id_repeats_and_empty_table(docs):
    line = "this line is long enough"
    df = docs((None, line), (1, line), (1, line), (2, line + "\nmore of it here"))
    assert by_id(lines.kept_text_digests(df), "doc_id", "n_dropped") == sorted([(None, 0), (1, 0), (1, 0), (2, 1)], key=str)
    assert lines.kept_text_digests(df.where("false")).count() == 0
