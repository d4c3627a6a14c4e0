"""Sums of the lexicon scores of a text's words, for the texts of an Arrow batch at once.

The same rules as the column expressions of `lexicon`: words are the rows of flat arrays, the words in front of one are those
arrays shifted, and the sums of a text are added word after word. What depends on a word alone (its case, its place in the
scoring table) is found once for each distinct word of a part. Texts are cleaned in the same call, so a text crosses to Python
once and only its sums come back.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from threadloom.functions import rules as R
from threadloom.functions.batches import joined, parts_of
from threadloom.functions.cleaning import BYTES, cleaner

MARKS = "!?.,;:()_"  # taken off both ends of a word
CHARACTERS = 2_000_000  # of text scored together: whole texts, as many as fit
SUMS = pa.struct(
    [(c, pa.float64()) for c in ("sum", "pos", "neg")] + [("neu", pa.int32())] + [(c, pa.float64()) for c in ("polarity", "subjectivity")]
    + [("questions", pa.int32()), ("exclamations", pa.int32()), ("empty", pa.bool_())]
)
# Unicode 16 gave two old letters capitals; Spark knows them, Python does not yet. Its new letters are blanked by the cleaning.
NEW_CAPITALS = str.maketrans("\u019b\u0264", "\ua7dc\ua7cb")
SPECIAL = ["so", "this", "never", "least", "at", "very", "but", *R.NO_SCORE_BEFORE]


class Scores:
    """Columns of a scoring table as arrays with one more entry, of a word that is not in the table."""

    def __init__(self, table: pa.Table):
        self.terms = table.column("term").combine_chunks()
        self.has: dict[str, np.ndarray] = {}
        self.value: dict[str, np.ndarray] = {}
        for name in R.SCORING_COLUMNS:
            column = table.column(name).combine_chunks().cast(pa.float64())
            self.has[name] = np.append(column.is_valid().to_numpy(zero_copy_only=False), False)
            self.value[name] = np.append(column.fill_null(0.0).to_numpy(zero_copy_only=False), 0.0)
        self.intensities = bool((self.has["intensity"] & self.has["polarity"]).any())
        spaced = np.flatnonzero((self.has["booster"] | self.has["idiom"])[:-1] & pc.match_substring(self.terms, " ").fill_null(False).to_numpy(zero_copy_only=False))
        split = {int(k): self.terms[int(k)].as_py().split(" ") for k in spaced}
        number = {w: j for j, w in enumerate(sorted({w for words in split.values() for w in words}))}
        self.parts = pa.array(list(number), pa.string())
        # By number of words, the phrases as sorted numbers made of those of their words, and their places in the table.
        self.phrases: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in (2, 3) if split else ():
            keys = sorted((self._key([number[w] for w in words]), k) for k, words in split.items() if len(words) == n)
            self.phrases[n] = tuple(np.array([x[j] for x in keys], dtype=np.int64) for j in (0, 1))

    def _key(self, numbers):
        key = numbers[0]
        for number in numbers[1:]:
            key = key * len(self.parts) + number
        return key

    def phrase_places(self, n: int, part: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Place in the table of the phrase of n words that begins at each word; part: numbers of the words, or -1."""
        out = np.full(len(part), len(self.terms))
        keys, at = self.phrases[n]
        starts = max(len(part) - n + 1, 0)
        ahead = [part[k : k + starts] for k in range(n)]
        whole = np.flatnonzero(np.logical_and.reduce([a >= 0 for a in ahead]) & (row[:starts] == row[n - 1 :]))
        if len(whole) and len(keys):
            asked = self._key([a[whole].astype(np.int64) for a in ahead])
            near = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            out[whole] = np.where(keys[near] == asked, at[near], len(self.terms))
        return out

    def places(self, words: pa.Array) -> np.ndarray:
        return pc.index_in(words, value_set=self.terms).fill_null(len(self.terms)).to_numpy(zero_copy_only=False)


def _above(x: np.ndarray) -> np.ndarray:
    """x > 0 as Spark has it, for which NaN is the largest number."""
    return ~(x <= 0)


def _upper(text: str) -> str:
    out = text.upper()
    return out.translate(NEW_CAPITALS) if "\u019b" in out or "\u0264" in out else out


def _in_case(words: pa.Array, arrow: Callable[[pa.Array], pa.Array], python: Callable[[str], str]) -> pa.Array:
    """Words, none of which has a blank, in one case. Beyond ASCII the mapping is Python's, which has the special cases
    that Spark's has and Arrow's has not; such words are turned as one string."""
    out = arrow(words)
    wide = pc.invert(pc.string_is_ascii(words))
    if not pc.any(wide).as_py():
        return out
    lists = pa.ListArray.from_arrays([0, pc.sum(wide).as_py()], words.filter(wide))
    text = python(pc.binary_join(lists, " ")[0].as_py())
    return pc.replace_with_mask(out, wide, pc.split_pattern(pa.array([text]), " ").flatten())


def _marks(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Exclamation marks among the marks before and after each word."""
    left = pc.utf8_ltrim(words, MARKS)
    count = lambda x: pc.count_substring(x, "!").to_numpy(zero_copy_only=False)
    return count(words) - count(left), count(left) - count(pc.utf8_rtrim(left, MARKS))


def _assessed(words: pa.Array, low: pa.Array, token: np.ndarray, of: np.ndarray, scores: Scores) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, polarity, subjectivity and whether that is known, of each known word with the modifiers in front of it.

    token: numbers of the words as they stand, of the texts in `of`. Here all marks around words are apart from them.
    """
    low = pc.utf8_trim(low, MARKS)
    kept = pc.greater(pc.utf8_length(low), 1).to_numpy(zero_copy_only=False)[token]
    code, row, at = token[kept], of[kept], scores.places(low)
    has, value = ({c: x[at] for c, x in of.items()} for of in (scores.has, scores.value))
    negates = pc.is_in(low, value_set=pa.array(R.POLARITY_NEGATIONS)).to_numpy(zero_copy_only=False)[code]
    long = pc.greater(pc.utf8_length(low), R.SHORT).to_numpy(zero_copy_only=False)[code]
    known = has["polarity"][code]
    k = np.flatnonzero(known)
    if not len(k):
        return row[k], np.zeros(0), np.zeros(0), np.zeros(0, dtype=bool)
    ended = long & ~known & ~negates  # words beyond which nothing reaches
    n_ended, n_long, n_negated = np.cumsum(ended), np.cumsum(long & ~known), np.cumsum(negates & ~known)
    after = lambda x, first: np.append(first, x[:-1])
    same = after(row[k], -1) == row[k]
    last = after(k, 0)
    modifies = has["intensity"][code[k]]
    adverb = modifies & pc.ends_with(low, R.ADVERB).to_numpy(zero_copy_only=False)[code[k]]
    by, by_adverb = same & after(modifies, False), same & after(adverb, False)
    open_ended = n_ended[k] == n_ended[last]
    merged = by & np.where(by_adverb, open_ended, n_long[k] == n_long[last])
    prior = np.maximum(k - 1, 0)
    taken = by_adverb & open_ended & ~known[prior]
    negated = (k > 0) & (row[prior] == row[k]) & negates[prior] & ~taken
    stops = np.flatnonzero(known | ended)
    beyond = np.append(stops, len(code))[np.searchsorted(stops, k, side="right")]
    beyond = np.minimum(beyond, np.searchsorted(row, row[k], side="right"))
    own_negation = adverb & (n_negated[beyond - 1] > n_negated[k])

    own = np.where(modifies, value["intensity"][code[k]], 1.0)
    factor = np.where(negated, np.where(own == 0, 0.0, 1.0 / np.where(own == 0, 1.0, own)), own)
    times = after(factor, 1.0)
    p, s = (np.where(merged, np.clip(value[c][code[k]] * times, -1.0, 1.0), value[c][code[k]]) for c in ("polarity", "subjectivity"))
    before, behind = (x[token] for x in _marks(words))
    n_marks, place = np.cumsum(before + behind), np.flatnonzero(kept)[k]
    final = ~np.append(same[1:], False)
    following = np.append(place[1:], 0)
    text_end = np.searchsorted(of, row[k], side="right") - 1
    marks = np.where(final, n_marks[text_end], n_marks[following] - behind[following]) - n_marks[place] + behind[place]
    p = np.where(marks > 0, np.clip(p * np.power(R.POLARITY_EXCLAIMED, marks.astype(np.float64)), -1.0, 1.0), p)

    group = np.cumsum(~merged) - 1
    turned = np.bincount(group, weights=negated | own_negation) > 0
    p = np.where(turned[group], p * R.POLARITY_NEGATED, p)
    whole = np.flatnonzero(~np.append(merged[1:], False))
    return row[k[whole]], p[whole], s[whole], has["subjectivity"][code[k[whole]]]


def sums_of(clean: pa.Array, scores: Scores) -> pa.Array:
    """Struct of sum, pos, neg, neu, polarity, subjectivity and counted marks of each cleaned text."""
    rows = len(clean)
    split = pc.split_pattern(clean, " ")
    coded = split.flatten().dictionary_encode()
    token, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    kept = pc.greater(pc.utf8_length(words), 1).to_numpy(zero_copy_only=False)[token]
    of = np.repeat(np.arange(rows), split.value_lengths().to_numpy(zero_copy_only=False))
    row, code = of[kept], token[kept]

    low, high = _in_case(words, pc.ascii_lower, str.lower), _in_case(words, pc.ascii_upper, _upper)
    capital = pc.and_(pc.equal(words, high), pc.not_equal(words, low)).to_numpy(zero_copy_only=False)
    short = pc.less_equal(pc.utf8_length(pc.utf8_trim(words, MARKS)), 2)
    low = pc.if_else(short, low, pc.utf8_trim(low, MARKS))
    at = scores.places(low)
    special = pc.index_in(low, value_set=pa.array(SPECIAL)).fill_null(-1).to_numpy(zero_copy_only=False)
    is_word = lambda *names: np.isin(special, [SPECIAL.index(n) for n in names])
    has, value = ({c: x[at] for c, x in of.items()} for of in (scores.has, scores.value))

    sizes = np.bincount(row, minlength=rows)
    starts = np.cumsum(sizes) - sizes
    n_capitals = np.bincount(row[capital[code]], minlength=rows)
    mixed = (n_capitals > 0) & (n_capitals < sizes)
    first_but = np.full(rows, -1)
    buts = np.flatnonzero(is_word("but")[code])[::-1]
    first_but[row[buts]] = buts - starts[row[buts]]

    first, second = (is_word(w)[code] for w in R.NO_SCORE_BEFORE)
    part = np.append(first[:-1] & second[1:] & (row[:-1] == row[1:]), np.zeros(min(len(code), 1), dtype=bool))
    i = np.flatnonzero((has["valence"] & ~has["booster"])[code] & ~part)
    place = i - starts[row[i]]
    loud = mixed[row[i]]

    def capital_step(before: np.ndarray, there: np.ndarray, score: np.ndarray) -> np.ndarray:
        return np.where(loud & there & capital[before], np.where(_above(score), R.CAPITALS_STEP, -R.CAPITALS_STEP), 0.0)

    score = value["valence"][code[i]]
    score = score + capital_step(code[i], np.ones(len(i), dtype=bool), score)
    so, never, least, at_or_very = is_word("so", "this"), is_word("never"), is_word("least"), is_word("at", "very")
    so_between = np.zeros(len(i), dtype=bool)
    for distance, damping in enumerate(R.DISTANCE_DAMPING, 1):
        there = place >= distance
        before = code[np.where(there, i - distance, 0)]
        free = there & ~has["valence"][before]
        booster = value["booster"][before]
        boost = (np.where(score < 0, -booster, booster) + capital_step(before, there, score)) * damping
        shifted = score + np.where(free & has["booster"][before], boost, 0.0)
        negated = free & (value["negation"][before] != 0)
        score = np.where(negated, shifted * R.NEGATION_FACTOR, shifted)
        if distance in R.NEVER_SO:
            score = np.where(free & never[before] & so_between, shifted * R.NEVER_SO[distance], score)
        so_between |= there & so[before]
    if scores.phrases:
        part = pc.index_in(low, value_set=scores.parts).fill_null(-1).to_numpy(zero_copy_only=False)[code]
        begun = {n: scores.phrase_places(n, part, row) for n in scores.phrases}
        far = (place >= R.PHRASE_DISTANCE) & ~has["valence"][code[np.where(place >= R.PHRASE_DISTANCE, i - R.PHRASE_DISTANCE, 0)]]
        meant = lambda spot: begun[spot[0]][np.maximum(i - spot[1], 0)]
        left = far
        for spot in R.IDIOM_PLACES:
            said = left & scores.has["idiom"][meant(spot)]
            score = np.where(said, scores.value["idiom"][meant(spot)], score)
            left = left & ~said
        for spot in R.BOOSTER_PLACES:
            score = score + np.where(far, scores.value["booster"][meant(spot)], 0.0)
    one, two = (code[np.where(place >= back, i - back, 0)] for back in (1, 2))
    alone = (place >= 1) & least[one] & ~has["valence"][one] & ~((place >= 2) & at_or_very[two])
    score = score * np.where(alone, R.NEGATION_FACTOR, 1.0)
    but = first_but[row[i]]
    score = score * np.where((but >= 0) & (place < but), R.BUT_BEFORE, np.where((but >= 0) & (place > but), R.BUT_AFTER, 1.0))

    def total(x: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=x, minlength=rows)

    if scores.intensities:
        rated, polarity, subjectivity, certain = _assessed(words, low, token, of, scores)
    else:
        known = np.flatnonzero(has["polarity"][code])
        rated, polarity, subjectivity, certain = row[known], *(value[c][code[known]] for c in ("polarity", "subjectivity")), has["subjectivity"][code[known]]
    # One unknown subjectivity among the known words makes the mean unknown, which counts as 0.
    unknown = np.bincount(rated[~certain], minlength=rows) > 0
    share = np.maximum(np.bincount(rated, minlength=rows), 1)
    columns = [
        total(score, row[i]),
        total(np.where(_above(score), score + 1, 0.0), row[i]),
        total(np.where(score < 0, 1 - score, 0.0), row[i]),
        (sizes - np.bincount(row[i][score != 0], minlength=rows)).astype(np.int32),
        total(polarity, rated) / share,
        np.where(unknown, 0.0, total(subjectivity, rated) / share),
        pc.count_substring(clean, "?"),
        pc.count_substring(clean, "!"),
        pc.equal(clean, ""),
    ]
    return pa.StructArray.from_arrays([pa.array(c, f.type) if isinstance(c, np.ndarray) else c.cast(f.type) for c, f in zip(columns, SUMS)], fields=list(SUMS))


def word_sums(text: Column, single_words: list[str] | None, table: pa.Table, plan_terms: int) -> Column:
    """sums_of as a column over texts that are not cleaned yet."""
    scores = Scores(table)
    clean = cleaner(single_words, plan_terms)

    @F.arrow_udf("sum double, pos double, neg double, neu int, polarity double, subjectivity double, questions int, exclamations int, empty boolean")
    def sums(texts: pa.Array) -> pa.Array:
        parts = []
        for first, n in parts_of(_bytes(texts), BYTES):
            cleaned = clean(texts.slice(first, n))
            parts += [sums_of(cleaned.slice(start, size), scores) for start, size in parts_of(_bytes(cleaned), CHARACTERS)]
        return joined(parts, SUMS)

    # Declared non-deterministic so that filters are not pushed below it with a second copy of the scoring.
    return sums.asNondeterministic()(text)


def _bytes(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
