"""Dictionaries as one Aho-Corasick automaton, run over whole Arrow batches.

The plan names a broadcast dictionary and stays the same size for any number of terms; a text is read once, whatever the
dictionary holds. Each Python worker builds the automaton of a dictionary once.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, SparkSession, functions as F

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


class Terms:
    """A dictionary of (term, name) pairs, known by its digest so that workers build it once."""

    def __init__(self, pairs: list[tuple[str, str]]):
        self.pairs = pairs
        self.digest = hashlib.sha256(repr(pairs).encode()).hexdigest()

    def __hash__(self) -> int:
        return hash(self.digest)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Terms) and self.digest == other.digest


@lru_cache(maxsize=4)
def built(terms: Terms) -> ahocorasick.Automaton | None:
    """The automaton of all terms but the empty one; each ends in its length and the names it stands for."""
    names: dict[str, set[str]] = {}
    for term, name in terms.pairs:
        if term:
            names.setdefault(term, set()).add(name)
    if not names:
        return None
    found = ahocorasick.Automaton()
    for term, meant in names.items():
        found.add_word(term, (len(term), frozenset(meant)))
    found.make_automaton()
    return found


def names_in(text: str | None, terms: Terms) -> list[str]:
    """Sorted distinct names of the terms inside a text; an empty term is in every text."""
    if text is None:
        return []
    automaton = built(terms)
    found = {name for term, name in terms.pairs if not term}
    if automaton is not None:
        for meant in {hit[1] for _, hit in automaton.iter(text)}:
            found |= meant
    return sorted(found)


def set_apart(text: str, terms: Terms) -> str:
    """text with a space on both sides of each term, A-Z and a-z alike: from the left, the longest term at each place."""
    automaton = built(terms)
    if automaton is None:
        return text
    longest: dict[int, int] = {}
    for end, (length, _) in automaton.iter(text.translate(_LOWER)):
        start = end + 1 - length
        longest[start] = max(length, longest.get(start, 0))
    out, at = [], 0
    for start in sorted(longest):
        if start >= at:
            out += [text[at:start], " ", text[start : start + longest[start]], " "]
            at = start + longest[start]
    return "".join([*out, text[at:]]) if out else text


def _dictionary(pairs: list[tuple[str, str]]):
    return SparkSession.active().sparkContext.broadcast(Terms(pairs))


def automaton_mentions(low: Column, pairs: list[tuple[str, str]]) -> Column:
    """Sorted distinct names whose term occurs in the text, which is lower-cased already; [] for NULL."""
    shared = _dictionary(pairs)

    @F.arrow_udf("array<string>")
    def mentions(batch: pa.Array) -> pa.Array:
        return pa.array([names_in(text, shared.value) for text in batch.to_pylist()], pa.list_(pa.string()))

    # Declared non-deterministic so that filters are not pushed below it with a second copy of the search.
    return mentions.asNondeterministic()(low)


def terms_to_set_apart(words: list[str]) -> Terms:
    return Terms([(w.translate(_LOWER), "") for w in sorted(set(words))])
