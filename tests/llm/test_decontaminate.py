"""Hits, items and character spans against a brute-force version."""

import random
import re

import pytest

from millrace.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def brute(text, items, window=10):
    places = [(m.start(), m.end()) for m in WORD.finditer(lower(text))]
    words = [lower(text)[a:b] for a, b in places]
    hit, ids = set(), set()
    for ident, item in items:
        own = WORD.findall(lower(item))
        n = min(window, len(own))
        for k in range(len(own) - n + 1 if own else 0):
            for i in range(len(words) - n + 1):
                if words[i:i + n] == own[k:k + n]:
                    hit.update(range(i, i + n))
                    ids.add(str(ident))
    return len(words), len(hit), sorted(ids), {c for k in hit for c in range(*places[k])}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = ["été", "Paris", "x1", "the", "Ünï", "of", "日本", "a"]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([1, 3, 9, 10, 11, 25])))) for k in range(12)]
    items += [(20, None), (21, ""), (22, "?!"), (None, "no id but seven words in here"), (30, items[4][1]), (31, "the-of  THE.of\nthe,of the!of the(of")]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(30)]
    texts += ["»" + items[5][1].upper().replace(" ", " -- ") + "« tail", "thethe ofof", None, "", " \n", "no id, but SEVEN words in: here", "w " * 30_000 + items[5][1]]
    return items, texts


@pytest.mark.parametrize("most", [1, 1 << 20])
def test_matches_brute_force(spark, docs, rows, most):
    items, texts = rows
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {r.doc_id: r for r in decontaminate.contamination(docs(*texts), bench, most_bytes=most).collect()}
    for k, text in enumerate(texts):
        n, hit, ids, chars = brute(text if k < len(texts) - 1 else items[5][1], [i for i in items if i[0] is not None])
        if k == texts.index("no id, but SEVEN words in: here"):
            assert found[k].item_ids == [] and found[k].n_hit == 7
            continue
        if k == len(texts) - 1:
            assert found[k].n_words == 30_000 + n and found[k].n_hit == hit and found[k].item_ids == ids
            continue
        assert (found[k].n_words, found[k].n_hit, found[k].item_ids) == (n, hit, ids), k
        marked = {c for s in found[k].spans for c in range(s.start, s.end)}
        assert chars <= marked and not any(WORD.match(lower(text)[c]) for c in marked - chars)


def test_clean_rows_and_empty_tables(spark, docs, rows):
    items, texts = rows
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs(*texts)
    kept = decontaminate.clean_rows(df, bench)
    assert kept.columns == df.columns
    hit = {r.doc_id for r in decontaminate.contamination(df, bench).where("n_hit > 0").collect()}
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - hit
    assert decontaminate.contamination(df, bench.where("false")).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(df.where("false"), bench).count() == 0
