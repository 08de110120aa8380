"""Co-training: accuracy on rows without labels, what the views teach each other, defined cases."""

import random

import pytest

from millrace.llm import quality
from tests.llm.conftest import by_id


@pytest.fixture(scope="module")
def rows():
    """Texts tell for words seen in labelled rows; the source tells for all."""
    rng = random.Random(8)
    good, bad = [f"good{k}" for k in range(60)], [f"junk{k}" for k in range(60)]
    out = []
    for k in range(900):
        ok = k % 3 != 0
        own = rng.choices(good if ok else bad, k=rng.randint(10, 40))
        out.append((k, " ".join([*own, *rng.choices(["the", "of", "and"], k=8)]), ("fine" if ok else "spam") if rng.random() < 0.9 else "mixed"))
    return out


def test_scores_unlabelled_rows(docs, labels, rows):
    df = docs(*rows)
    known = labels(*[(k, int(k % 3 != 0), 0) for k in range(0, 900, 7)])
    found = {r.doc_id: r for r in quality.co_trained(df, known).collect()}
    right = sum(found[k].kept == (k % 3 != 0) for k, *_ in rows)
    assert right >= 0.98 * len(rows)
    assert all(0 <= x <= 1 for r in found.values() for x in (r.p_text, r.p_meta, r.score))


def test_views_teach_each_other(docs, labels, rows):
    """With few labels, rounds of exchange make the text view better than its labelled rows alone."""
    df = docs(*rows)
    known = labels(*[(k, int(k % 3 != 0), 0) for k in range(0, 900, 20)])
    sure = {}
    for rounds in (0, 3):
        found = quality.co_trained(df, known, rounds=rounds, sure=0.8).collect()
        sure[rounds] = sum((r.p_text >= 0.5) == (r.doc_id % 3 != 0) for r in found)
    assert sure[3] >= sure[0]


def test_defined_cases(docs, labels, rows):
    df = docs(*rows[:200], (None, rows[0][1], None), (None, None, None), (500, None, None), (501, "", "fine"), (502, "w " * 50_000, "fine"), rows[3], rows[3])
    known = labels(*[(k, int(k % 3 != 0), 0) for k in range(200)], (0, 1, 1), (1, None, 0), (None, 0, 0), (999, 0, 0))
    found = by_id(quality.co_trained(df, known), "doc_id", "score", "kept")
    assert len(found) == 207 and len({s for k, s, _ in found if k == 3}) == 1
    for none in (known.where("false"), known.where("quality = 1")):
        assert quality.co_trained(df, none).where("NOT kept").count() == 0
    assert quality.co_trained(df.where("false"), known).count() == 0
