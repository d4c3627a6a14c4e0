"""Fuzzy dictionary mentions: the best partial match of each term inside a text.

The score of a term is the best of 200 * common / (len(term) + len(window)) over all windows of the text that are as
long as the term, or shorter where they touch the start or end of the text; `common` is the length of the longest
common subsequence. When the text is the shorter one the roles swap. Spark cuts the texts into Arrow batches; one
batch is scored as a single array of code points, so the work per batch is a few array passes for each term.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from threadloom.functions.batches import joined, parts_of

GAP = 0x110000  # above every code point: the filler between texts matches nothing
CHUNK = 200_000  # code points scored together: whole texts, as many as fit, and a single longer one by itself


def common_length(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def partial_score(term: str, text: str) -> float:
    """The same score for one pair, written plainly; used when the text is not longer than the term."""
    best = 0.0
    pairs = [(term, text), (text, term)] if len(term) == len(text) else [sorted((term, text), key=len)]
    for short, long in pairs:
        size = len(short)
        for start in range(1 - size, len(long)):
            window = long[max(start, 0) : start + size]
            best = max(best, 200.0 * common_length(short, window) / (size + len(window)))
    return best


def _common_by_rows(term: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Longest common subsequence of the term with every row of windows, all rows at once."""
    row = np.zeros((len(term) + 1, len(windows)), dtype=np.int16)
    for column in range(windows.shape[1]):
        diagonal = row[0]
        for i, letter in enumerate(term, 1):
            above = row[i].copy()
            row[i] = np.where(windows[:, column] == letter, diagonal + 1, np.maximum(above, row[i - 1]))
            diagonal = above
    return row[len(term)]


def _common_with_windows(places: np.ndarray, codes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The same for terms of up to 64 letters and the windows that begin at `at`, with one word of bits per window.

    places[code] has a bit for each place of that letter in the term. A bit of `still` is 0 where the term's prefix up to
    there has one letter more in common with the window than the prefix before it; one addition per letter moves all
    prefixes on.
    """
    still = np.full(len(at), np.iinfo(np.uint64).max, dtype=np.uint64)
    for column in range(size):
        met = still & places[codes[at + column]]
        still = (still + met) | (still - met)
    within = np.uint64((1 << size) - 1)
    return np.bitwise_count(~still & within).astype(np.int64)


def kept_pairs(size: int, cutoff: float) -> int:
    """Fewest neighbouring letter pairs of a term of `size` letters that a window as long as it has in common with it.

    A window at the cutoff lacks so many letters of the term and has as many others; a lacking one breaks two pairs of the
    term, one put in between breaks one.
    """
    lacking = size - math.ceil(cutoff * size / 100.0 - 1e-9)
    return size - 1 - 3 * lacking


class _Chunk:
    """Texts as one array of letter codes with gaps between them, and where each pair of neighbouring letters stands."""

    def __init__(self, texts: list[str], terms: list[str]):
        longest = max(map(len, terms))
        gap = np.full(longest, GAP, dtype=np.uint32)
        parts = [gap]
        for text in texts:
            parts += [np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), gap]
        self.flat = np.concatenate(parts)
        self.lengths = np.array(list(map(len, texts)))
        self.ends = np.cumsum(self.lengths + longest)
        self.starts = self.ends - self.lengths
        # Counts wrap around at the type's size; the difference over a window no longer than that is exact all the same.
        self.small = np.uint8 if longest < 256 else np.uint32
        self.alphabet = sorted(set("".join(terms)))
        self.code_of = {c: i + 1 for i, c in enumerate(self.alphabet)}
        points = np.array([ord(c) for c in self.alphabet], dtype=np.uint32)
        nearest = np.minimum(np.searchsorted(points, self.flat), len(points) - 1)
        self.codes = np.where(points[nearest] == self.flat, nearest + 1, 0)  # 0: a letter of no term
        self.letters_before = self.counted(self.flat != GAP)
        self._seen: dict[str, np.ndarray] = {}
        self._clipped: dict[int, np.ndarray] = {}
        self._index_pairs(terms)

    def counted(self, hits: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hits) + 1, dtype=self.small)
        np.cumsum(hits.view(np.uint8), dtype=self.small, out=out[1:])
        return out

    def seen(self, letter: str) -> np.ndarray:
        if letter not in self._seen:
            self._seen[letter] = self.counted(self.codes == self.code_of[letter])
        return self._seen[letter]

    def _index_pairs(self, terms: list[str]) -> None:
        """Positions of the pairs that some term has, those of one pair together."""
        width = len(self.alphabet) + 1
        wanted = np.unique([self.code_of[x] * width + self.code_of[y] for t in terms for x, y in zip(t, t[1:])]).astype(np.int64)
        numbers = np.zeros(width * width, dtype=np.int32)
        numbers[wanted] = np.arange(1, len(wanted) + 1)
        here = numbers[self.codes[:-1] * width + self.codes[1:]]
        at = np.flatnonzero(here)
        order = np.argsort(here[at], kind="stable")
        self.pair_positions = at[order]
        self.pair_bounds = np.searchsorted(here[at][order], np.arange(1, len(wanted) + 2))
        self.pair_number = {int(p): i for i, p in enumerate(wanted)}
        self.width = width

    def near_pairs(self, term: str, least: int) -> np.ndarray:
        """Starts of the windows with at least `least` places that begin a pair of the term."""
        size = len(term)
        pairs = {self.code_of[x] * self.width + self.code_of[y] for x, y in zip(term, term[1:])}
        parts = [self.pair_positions[self.pair_bounds[i] : self.pair_bounds[i + 1]] for i in (self.pair_number[p] for p in pairs)]
        at = np.sort(np.concatenate(parts))
        if len(at) < least:
            return at[:0]
        first, last = at[: len(at) - least + 1], at[least - 1 :]
        close = last - first <= size - 2
        first, last = first[close], last[close]
        # All windows that hold both, but those that hold an earlier first one too: each once.
        after = np.concatenate([[-1], first[:-1]])
        starts = (last - (size - 2))[:, None] + np.arange(size - 1)
        return starts[(starts <= first[:, None]) & (starts > after[:, None])]

    def near_letters(self, term: str, needed: np.ndarray, window_size: np.ndarray) -> np.ndarray:
        """Starts of the windows that share enough letters, in any order."""
        size = len(term)
        shared = np.zeros(len(window_size), dtype=self.small)
        for letter in set(term):
            before = self.seen(letter)
            shared += np.minimum(before[size:] - before[:-size], self.small(term.count(letter)))
        return np.flatnonzero((shared >= needed[window_size]) & (window_size > 0))

    def clipped(self, size: int) -> np.ndarray:
        """Starts of the windows that touch a text and reach over its start or end."""
        if size not in self._clipped:
            steps = np.arange(1, size)
            at = np.concatenate([(self.starts[:, None] - steps).ravel(), (self.ends[:, None] - steps).ravel()])
            at = at[(at >= 0) & (at < len(self.flat) - size + 1)]
            inside = self.letters_before[at + size] != self.letters_before[at]
            self._clipped[size] = at[inside]
        return self._clipped[size]


def _score_chunk(texts: list[str], terms: list[str], cutoff: float) -> np.ndarray:
    """Scores of shape (texts, terms); 0 where the score is below the cutoff."""
    chunk = _Chunk(texts, terms)
    flat, lengths = chunk.flat, chunk.lengths
    scores = np.zeros((len(texts), len(terms)))
    for t, term in enumerate(terms):
        size = len(term)
        letters = np.array([ord(c) for c in term], dtype=np.uint32)
        window_size = chunk.letters_before[size:] - chunk.letters_before[:-size]
        needed = np.ceil(cutoff * (size + np.arange(size + 1)) / 200.0 - 1e-9).astype(chunk.small)
        least = kept_pairs(size, cutoff)
        if least > 0:
            near = chunk.near_pairs(term, least)
            at = np.concatenate([near[(near >= 0) & (near < len(window_size))], chunk.clipped(size)])
        else:  # too few letters, or too low a cutoff, for pairs to tell
            at = chunk.near_letters(term, needed, window_size)
        if len(at):
            if size <= 64:
                places = np.zeros(len(chunk.alphabet) + 1, dtype=np.uint64)
                for i, letter in enumerate(term):
                    places[chunk.code_of[letter]] |= np.uint64(1 << i)
                common = _common_with_windows(places, chunk.codes, at, size)
            else:
                common = _common_by_rows(letters, np.lib.stride_tricks.sliding_window_view(flat, size)[at])
            found = 200.0 * common / (size + window_size[at].astype(np.int64))
            # Gaps are as long as the longest term, so a window touches one text: the first to end after its start.
            owner = np.searchsorted(chunk.ends, at, side="right")
            np.maximum.at(scores[:, t], owner, np.where(found >= cutoff, found, 0.0))
        for i in np.flatnonzero((lengths > 0) & (lengths <= size)):
            score = partial_score(term, texts[i])
            scores[i, t] = score if score >= cutoff else 0.0
    return scores


def _chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, texts[start:]


def best_in_dictionaries(texts: Iterable[str | None], dictionaries: list[list[str]], cutoff: float = 80.0, limit: int | None = 5) -> list[list[list[int]]]:
    """For each dictionary and text the positions of its best terms, by score and then by dictionary order.

    The texts are laid out and indexed once for all dictionaries.
    """
    whole = ["" if t is None else t for t in texts]
    every = list(dict.fromkeys(term for terms in dictionaries for term in terms))
    place = {term: i for i, term in enumerate(every)}
    out: list[list[list[int]]] = [[] for _ in dictionaries]
    for _, chunk in _chunks(whole):
        scores = _score_chunk(chunk, every, cutoff) if every else np.zeros((len(chunk), 0))
        for found, terms in zip(out, dictionaries):
            own = scores[:, [place[t] for t in terms]]
            order = np.argsort(-own, axis=1, kind="stable")
            for text, row, ranked in zip(chunk, own, order):
                hits = [int(i) for i in ranked if row[i] > 0] if text else []
                found.append(hits if limit is None else hits[:limit])
    return out


def best_terms(texts: Iterable[str | None], terms: list[str], cutoff: float = 80.0, limit: int | None = 5) -> list[list[int]]:
    """For each text the positions of its best terms, by score and then by dictionary order."""
    return best_in_dictionaries(texts, [terms], cutoff, limit)[0]


def fuzzy_dictionaries(
    text: Column, dictionaries: dict[str, list[tuple[str, str]]], cutoff: float = 80.0, limit: int | None = 5
) -> Column:
    """A struct with one field per dictionary: sorted distinct names of its `limit` best terms scoring at least `cutoff`
    against the lower-cased text, all in one pass.

    A dictionary is (term, name) pairs in order, and has passed a size check. The limit applies to terms, before they are
    mapped to names; None keeps every term.
    """
    keys = [[term for term, _ in pairs] for pairs in dictionaries.values()]
    names = [[name for _, name in pairs] for pairs in dictionaries.values()]
    fields = list(dictionaries)

    kind = pa.struct([(f, pa.list_(pa.string())) for f in fields])

    @F.arrow_udf(", ".join(f"`{f}` array<string>" for f in fields))
    def mentions(batch: pa.Array) -> pa.Array:
        # Only the texts of one part are Python strings at a time, however many rows or long texts the batch has.
        sizes = pc.fill_null(pc.utf8_length(batch), 0).to_numpy(zero_copy_only=False)
        parts = []
        for start, n in parts_of(sizes, CHUNK):
            found = best_in_dictionaries(batch.slice(start, n).to_pylist(), keys, cutoff, limit)
            columns = [pa.array([sorted({own[i] for i in hits}) for hits in rows], pa.list_(pa.string())) for own, rows in zip(names, found)]
            parts.append(pa.StructArray.from_arrays(columns, fields=list(kind)))
        return joined(parts, kind)

    # Declared non-deterministic so that the optimizer does not run it a second time inside a pushed-down filter.
    return mentions.asNondeterministic()(F.lower(text))


def fuzzy_mentions(
    text: Column, terms: list[tuple[str, str]], cutoff: float = 80.0, limit: int | None = 5
) -> Column:
    """fuzzy_dictionaries with one dictionary: its names."""
    return fuzzy_dictionaries(text, {"names": terms}, cutoff, limit)["names"]
