"""Cleaning of texts before they are scored: whole Arrow batches, one pass of an automaton per rule.

The patterns are written for RE2, which Arrow runs: white space is spelled out, and A-Z and a-z are the only letters taken
alike.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession, functions as F

from threadloom.functions.automaton import Terms, set_apart, terms_to_set_apart
from threadloom.functions.batches import joined, parts_of

SPACE = r"\t-\r \p{Z}"
SPACE_BUT_BLANK = r"\t-\r\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
BYTES = 8_000_000  # of text cleaned together: whole texts, as many as fit


def _letter(c: str) -> str:
    if not c.isascii() or c.isdigit() or c in " _":
        return c
    return f"[{c.lower()}{c.upper()}]" if c.isalpha() else "\\" + c


def any_of(words: list[str]) -> str:
    """Pattern of the longest of the words at a place."""
    return "|".join("".join(map(_letter, w)) for w in sorted(set(words) - {""}, key=lambda w: (-len(w), w)))


def clean(texts: pa.Array, pattern: str = "", terms: Terms | None = None) -> pa.Array:
    out = texts.fill_null("")
    out = pc.replace_substring_regex(out, r"(?s)```.*?```", " CODE_BLOCK ")
    out = pc.replace_substring_regex(out, r"`.*?`", " CODE_SNIPPET ")
    out = pc.replace_substring_regex(out, rf"(?:http|www)[^{SPACE}]+", " URL ")
    out = pc.replace_substring_regex(out, r"<.*?>", "")
    if terms is not None:
        out = pa.array([set_apart(text, terms) for text in out.to_pylist()], pa.string())
    elif pattern:
        out = pc.replace_substring_regex(out, pattern, r" \0 ")
    out = pc.replace_substring_regex(out, rf"[^\p{{L}}\p{{N}}_{SPACE}!?.,;:()]+", " ")
    out = pc.replace_substring(out, ":)", " positive_emoji ")
    out = pc.replace_substring(out, ":(", " negative_emoji ")
    # Single blanks, which are most of the white space, stay as they are.
    out = pc.replace_substring_regex(out, rf"[{SPACE_BUT_BLANK}][{SPACE}]*| [{SPACE}]+", " ")
    return pc.utf8_trim(out, " ")


def cleaner(single_words: list[str] | None, plan_terms: int) -> Callable[[pa.Array], pa.Array]:
    """`clean` for tasks, with up to plan_terms words set apart by a pattern; more are one automaton in a broadcast variable."""
    words = [w for w in single_words or [] if w]
    shared = SparkSession.active().sparkContext.broadcast(terms_to_set_apart(words)) if len(words) > plan_terms else None
    pattern = "" if shared is not None else any_of(words)
    return lambda texts: clean(texts, pattern, None if shared is None else shared.value)


def cleaned(text: Column, single_words: list[str] | None, plan_terms: int) -> Column:
    run = cleaner(single_words, plan_terms)

    @F.arrow_udf("string")
    def cleaned_batch(batch: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False)
        return joined([run(batch.slice(start, n)) for start, n in parts_of(sizes, BYTES)], pa.string())

    # Declared non-deterministic so that filters are not pushed below it with a second copy of the cleaning.
    return cleaned_batch.asNondeterministic()(text)
