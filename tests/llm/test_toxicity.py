"""Held-out accuracy, gapped insults, defined cases."""

import random
import zlib

import numpy as np
import pytest

from millrace.llm import toxicity
from tests.llm.conftest import by_id

BAD = ["grumblefink", "dorkwad", "sneezleborg", "plonkersnit"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    part = ["ran", "to", "mi", "lek", "sor", "van", "den", "ul", "ach", "e"]
    vocabulary = ["".join(rng.choices(part, k=rng.randint(1, 4))) for _ in range(300)]
    out = []
    for k in range(700):
        words = rng.choices(vocabulary, k=rng.randint(5, 60))
        toxic = k % 4 == 0
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", ".", ",", "s"]))
        out.append((k, " ".join(words), int(toxic)))
    return out


@pytest.fixture
def model(docs, labels, rows):
    return toxicity.train(docs(*[r[:2] for r in rows]), labels(*[(k, 1, t) for k, _, t in rows]))


def test_kernel_is_normal_and_bounded():
    words = ["idiot", "id-iot", "idxiot", "weather", "ab", "", "q" * 100]
    marks = toxicity.Landmarks(["idiot", "trash", "scoundrel"])
    like = marks.likeness([b"".join(toxicity.words_of(w.encode())).decode() for w in words])
    assert like.max() <= 1.0001 and like.min() >= 0 and like[0, 0] == pytest.approx(1) and like[1, 0] == pytest.approx(1)
    assert like[2, 0] > 0.5 > like[3, 0] and not like[4:6].any()
    assert np.array_equal(marks.likeness(["idiot", "weather"], 0.45)[0], like[0])
    assert toxicity.words_of("Éñ-1x »Q« a b c\td é".encode())[:1] == [b"enx"] and len(toxicity.pieces("a" * 100)) > 6
    assert toxicity.words_of(b"so, i d. i o t")[-1] == b"idiot"


def test_held_out_accuracy(docs, labels, rows):
    found = toxicity.scored(docs(*[r[:2] for r in rows]), labels(*[(k, 1, t) for k, _, t in rows])).collect()
    truth = {k: t for k, _, t in rows}
    test = [r for r in found if r.held_out]
    assert {r.doc_id for r in test} == {k for k in truth if zlib.crc32(str(k).encode()) % 5 == 0}
    right = sum(r.predicted == truth[r.doc_id] for r in test)
    assert right >= 0.97 * len(test) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_held_out_labels_change_nothing(docs, labels, rows):
    df = docs(*[r[:2] for r in rows[:300]])
    flip = lambda k, t: 1 - t if zlib.crc32(str(k).encode()) % 5 == 0 else t
    one = toxicity.scored(df, labels(*[(k, 1, t) for k, _, t in rows[:300]]))
    all_toxic = lambda k, t: 1 if zlib.crc32(str(k).encode()) % 5 == 0 else t
    for change in (flip, all_toxic):
        two = toxicity.scored(df, labels(*[(k, 0, change(k, t)) for k, _, t in rows[:300]]))
        assert by_id(one, "doc_id", "score", "predicted") == by_id(two, "doc_id", "score", "predicted")


def test_gapped_insults_and_defined_cases(docs, model):
    clean = "ran to milek soran van denul ach"
    texts = [
        f"{clean} d-o-r-k-w-a-d and grumbxlefink {clean}", f"{clean} s n e e z l e b o r g plonkeersnit", f"{clean} GRUMBLEFINK! Dorkwad? {clean}",
        clean, None, "", " ", "x" * 100_000, f"{clean} " * 5_000 + " grumblefink dorkwad sneezleborg", "日本 語",
    ]
    df = docs(*texts, (None, texts[0]), (3, clean), (3, clean))
    score = df.select("doc_id", model.score(df.text).alias("score"))
    got = {}
    for k, s in by_id(score, "doc_id", "score"):
        got.setdefault(k, []).append(s)
    assert all(got[k][0] > 0.5 for k in (0, 1, 2, 8)) and got[None][0] == got[0][0]
    assert all(s < 0.5 for k in (3, 4, 5, 6, 7, 9) for s in got[k]) and got[4] == got[5] == got[6] and len(set(got[3])) == 1


def test_empty_tables_and_one_sided_labels(docs, labels, rows):
    df = docs(*[r[:2] for r in rows[:20]])
    for known in (labels((0, 1, 1)).where("false"), labels((1, 1, 0), (2, None, None)), labels((0, 1, 1), (4, 1, 1))):
        assert {r.predicted for r in toxicity.scored(df, known).collect()} == {0}
    assert toxicity.scored(df.where("false"), labels((0, 1, 1), (1, 1, 0))).count() == 0
    kept = toxicity.clean_rows(df, labels((1, 1, 0)))
    assert kept.columns == df.columns and kept.count() == 20


def test_gapped_and_inserted_letters_stay_near():
    rng = random.Random(9)
    words = ["trash", "idiot", "moron", "stupid", "scoundrel"]
    marks = toxicity.Landmarks(words)
    assert marks.likeness(["tkwrash"])[0, 0] > toxicity.NEAR
    share = {}
    for many in (1, 2):
        near = 0
        for _ in range(400):
            k = rng.randrange(len(words))
            own = list(words[k])
            for _ in range(many):
                own.insert(rng.randrange(1, len(own)), rng.choice("abcdefghijklmnopqrstuvwxyz"))
            near += marks.likeness(["".join(own)])[0, k] > toxicity.NEAR
        share[many] = near / 400
    assert share[1] > 0.9 and share[2] > 0.5


@pytest.mark.parametrize("text", [
    "so i d i o t", "so i - d - i - o - t", "so i.d. i .o. t", "so i \u00b7 d \u00b7 i \u00b7 o \u00b7 t", "so i \u2013 d \u2013 i \u2013 o \u2013 t",
    "so \u00ed \u00b7 d \u00b7 \u00ee \u00b7 o \u00b7 t", "so i 1 d 2 i 3 o 4 t", "so (i) (d) (i) (o) (t)"])
def test_spaced_insults_are_one_word(text):
    assert b"idiot" in toxicity.words_of(text.encode())
    assert b"\xd0\xb4\xd1\x83\xd1\x80\xd0\xb0" in toxicity.words_of("\u0434 \u0443 \u0440 \u0430".encode())


def test_a_reader_holds_few_words_at_once(rows, monkeypatch):
    """Known words must not let a whole batch of texts be held as words."""
    read = []
    words_of = toxicity.words_of
    monkeypatch.setattr(toxicity, "words_of", lambda text: read.append(len(found := words_of(text))) or found)
    first = next(toxicity.Reader(toxicity.Landmarks(BAD)).describe([b"grumblefink said it " * 100] * 2_000))
    assert first[-1] > 0 and sum(read) <= toxicity.HELD + 300
    texts = [t.encode() for _, t, _ in rows]
    whole = list(toxicity.Reader(toxicity.Landmarks(BAD)).describe(texts))
    monkeypatch.setattr(toxicity, "HELD", 20)
    assert np.allclose(whole, list(toxicity.Reader(toxicity.Landmarks(BAD)).describe(texts)))
