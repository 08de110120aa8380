"""Statistics against brute force, and what the list learns."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import rules
from tests.llm.conftest import by_id

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORDS.findall(text)
    grams = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
    covered = {k + d for k in range(len(words) - 4) if grams[tuple(words[k:k + 5])] > 1 for d in range(5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), failed


def text_of(rng, bad):
    words = rng.choices(["alpha", "beta", "gamma", "delta", "Epsilon", "é", "zeta"], k=rng.randint(12, 80))
    if bad:
        words = [w + rng.choice("#%|") for w in words]
    return " ".join(words) if rng.random() < 0.5 else "\n".join(" ".join(words[k:k + 7]) for k in range(0, len(words), 7))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    out = [text_of(rng, k % 4 == 0) for k in range(120)]
    out += [None, "", " \n\t ", "one two three four five", "a b c d e a b c d e", "a a a a a a a", "x " * 20_000, "l\nl\n\nl", "w\x1fv\x0bu"]
    return out + [" ".join(rng.choices("ab", k=40)) for _ in range(10)]


def test_statistics_match_brute_force(docs, texts):
    stats = rules.statistics(docs(*texts)).withColumn("base_failed", rules.base_failed(F.col("n_words"), F.col("n_repeat_words")))
    found = {r[0]: tuple(r[1:]) for r in stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()}
    assert found == {k: brute(t) for k, t in enumerate(texts)}


def test_list_is_learned_and_applied_in_order(docs, labels, texts):
    known = labels(*[(k, int(k % 4 != 0), None) for k in range(100)], (0, 0, 0), (200, 1, 1), (5, None, None), (None, 0, 0))
    judged, found = rules.judged(docs(*texts), known)
    assert found.rules and all(1 <= len(r) <= 4 for r in found.rules) and "symbol_share" in str(found)
    kept = {r.doc_id: r.kept for r in judged.collect()}
    for k, text in enumerate(texts):
        assert kept[k] == (not brute(text)[-1] and (k >= 120 or k % 4 != 0)), k


@pytest.mark.parametrize("rows", [[], [(1, 1, 0)], [(4, 0, 0)]])
def test_without_both_labels_only_base_rules_hold(docs, labels, texts, rows):
    judged, found = rules.judged(docs(*texts), labels(*rows) if rows else labels((1, 1, 1)).where("false"))
    assert found.rules == () and str(found) == "keep all"
    assert by_id(judged.where("kept = base_failed"), "doc_id") == []


def test_main_path_has_no_python(docs, labels, texts, capsys):
    judged, _ = rules.judged(docs(*texts), labels((1, 1, 1), (4, 0, 0)))
    judged.explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)
    assert rules.judged(docs("a").where("false"), labels((1, 1, 1)))[0].count() == 0
