"""Words, search scores and names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"

def blank(column: Column | str) -> Column:
    """True for null and for the empty string."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit("")) == ""


def tokenize(text: Column | str, words: Iterable[str] = ()) -> Column:
    """Lower-cased words of a text, in order, as an array.

    Without ``words`` a word is a run of letters and digits.  With ``words`` the
    runs are cut further: at each place the longest listed word is taken, else a
    run of Latin letters and digits, else a single character.
    """
    text = F.lower(F.col(text) if isinstance(text, str) else text)
    listed = {w.lower() for w in words if w}
    pattern = f"{_longest_of(listed)}|[a-z0-9]+|[\\p{{L}}\\p{{N}}]" if listed else WORD
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _longest_of(listed: set[str]) -> str:
    """Regular expression for the longest listed word at a place, whatever their number.

    The words share their beginnings as a tree.  A node's branches are a balanced tree of ranges of
    characters, so a place is decided in about as many tests as the logarithm of the branches.
    """
    tree: dict = {}
    for word in listed:
        node = tree
        for c in word:
            node = node.setdefault(c, {})
        node[""] = {}

    def char(c: str) -> str:
        return c if c.isascii() and c.isalnum() else f"\\x{{{ord(c):x}}}"

    def either(branches: list[tuple[str, str]]) -> str:
        if len(branches) <= 4:
            return "|".join(expression for _, expression in branches)
        half = len(branches) // 2
        return "|".join(
            f"(?=[{char(part[0][0])}-{char(part[-1][0])}])(?:{either(part)})" for part in (branches[:half], branches[half:]))

    def below(node: dict) -> str:
        out = ""
        while len(node) == 1 and "" not in node:  # no choice: no group
            (c, node), = node.items()
            out += char(c)
        branches = [(c, char(c) + below(child)) for c, child in sorted(node.items()) if c]
        if not branches:
            return out
        # what is longer is tried first; where a word ends, nothing more is right too
        return f"{out}(?:{either(branches)}){'?' if '' in node else ''}"

    return below(tree)


def match_score(text: Column | str, query: str) -> Column:
    """How many words of the text are words of the query (0 = no match)."""
    wanted = F.array_distinct(tokenize(F.lit(query)))
    return F.size(F.filter(tokenize(text), lambda w: F.array_contains(wanted, w)))


def camel_case(name: str) -> str:
    """``lower_underscore`` to ``lowerCamel``."""
    head, *rest = name.lower().split("_")
    return head + "".join(part.capitalize() for part in rest)
