"""Repeated passages against a plain search, and planted passages that start and end inside lines."""

import random
import re

import pytest

from millrace.llm import substrings
from tests.llm.conftest import by_id


def brute(rows, min_words=25):
    """``{id: (spans in characters, units removed)}`` of (id, text) rows in order of id."""
    seen, out = set(), {}
    for ident, text in sorted(rows):
        runs, run = [], []
        for m in re.finditer(r"[^.!?,;:\n]+", text or ""):
            key = tuple(w for w in re.split(r"[ \t\n\v\f\r]+", "".join(c.lower() if c.isascii() else c for c in m.group())) if w)
            if not key:
                continue
            if key in seen:
                run.append((m.start(), m.end(), len(key)))
            else:
                runs.append(run)
                run = []
            seen.add(key)
        spans, gone = [], 0
        for run in [*runs, run]:
            if sum(n for *_, n in run) >= min_words:
                end = run[-1][1]
                spans.append((run[0][0], end + (end < len(text))))
                gone += len(run)
        out[ident] = (spans, gone)
    return out


def check(df, rows, **options):
    texts, want = dict(rows), brute(rows, options.get("min_words", 25))
    found = {r.doc_id: r for r in substrings.deduplicated(df, **options).collect()}
    assert len(found) == len(rows)
    for k, (spans, gone) in want.items():
        got, text = found[k], texts[k] or ""
        assert [(s.start, s.end) for s in got.removed] == spans and got.n_removed == gone, k
        kept, at = "", 0
        for low, high in spans:
            kept, at = kept + text[at:low], high
        assert got.kept_text == kept + text[at:]
    return want


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = [f"w{k}é" if k % 7 == 0 else f"W{k}" for k in range(400)]

    def text(n):
        out = []
        for _ in range(n):
            out.append(" ".join(rng.choices(words, k=rng.randint(2, 14))) + rng.choice([". ", ", ", "\n", "! ", "; ", ".\n\n"]))
        return "".join(out)

    passages = [text(9) for _ in range(5)]
    made = []
    for k in range(60):
        parts = [text(rng.randint(1, 6))]
        if k % 2:  # inside lines, in other white space and case
            parts += ["before " + rng.choice(passages).replace(" ", "  ").upper() + " after", text(3)]
        if k % 5 == 0:
            parts.append("for more information, see below. ")
        made.append((k, "".join(parts)))
    return made


@pytest.mark.parametrize("least", [1, 25])
def test_equals_plain_search(docs, rows, least):
    want = check(docs(*rows), rows, min_words=least)
    if least == 25:
        assert sum(bool(s) for s, _ in want.values()) >= 20 and not any(s for k, (s, _) in want.items() if k % 2 == 0)


def test_common_phrases_stay(docs):
    rows = [(k, f"something only number {k} says here, for more information, see below.") for k in range(50)]
    assert not any(s for s, _ in check(docs(*rows), rows).values())


def test_odd_rows(docs):
    long = " ".join(f"x{k}" for k in range(40_000))
    line = " ".join(f"w{k}" for k in range(30))
    check(docs((0, None), (1, ""), (2, " \n.,\n"), (3, long), (4, long + "."), (5, line + "\n" + line)), [(0, None), (1, ""), (2, " \n.,\n"), (3, long), (4, long + "."), (5, line + "\n" + line)])
    df = docs((None, line), (3, line), (3, line))
    assert by_id(substrings.deduplicated(df), "doc_id", "n_removed") == sorted([(None, 0), (3, 0), (3, 0)], key=str)
    assert substrings.deduplicated(df.where("false")).count() == 0


def test_lines_and_paragraphs_are_units_too(docs):
    block = "first line, of a block\nsecond line of. a block"
    df = docs(f"intro\n\n{block}\n\nmiddle", f"{block}\n \nother", f"{block}\nmore")
    for unit, want in (("paragraph", [0, 1, 0]), ("line", [0, 2, 2])):
        found = {r.doc_id: r for r in substrings.deduplicated(df, unit=unit, min_words=5).collect()}
        assert [found[k].n_removed for k in range(3)] == want
    assert found[1].removed[0].start == 0 and found[1].removed[0].end == len(block) + 1
