"""Text and scalar functions as Column expressions, inside the JVM but for dictionaries and the cleaning before scores."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from threadloom.functions.automaton import automaton_mentions
from threadloom.functions.binding import let
from threadloom.functions.cleaning import cleaned

# English stop words without apostrophes and longer than two letters (shorter tokens are dropped).
STOP_WORDS = """
myself our ours ourselves you your yours yourself yourselves him his himself she her hers herself its itself they
them their theirs themselves what which who whom this that these those are was were been being have has had having
does did doing the and but because until while for with about against between into through during before after
above below from down out off over under again further then once here there when where why how all any both each
few more most other some such nor not only own same than too very can will just don should now ain aren couldn
didn doesn hadn hasn haven isn mightn mustn needn shan shouldn wasn weren won wouldn
""".split()

# Words the tokeniser splits in two, and the part that is left after stop words and short tokens go.
SPLIT_WORDS = {"gimme": "gim", "gonna": "gon", "gotta": "got", "lemme": "lem", "wanna": "wan"}
SPLIT_AND_DROPPED = ["cannot"]

# White space as the reference language sees it: ASCII plus the Unicode separators.
SPACE = r"\s\p{Z}"


def full_text(title: Column, text: Column) -> Column:
    """Title and body joined by a space, the title alone when there is no body."""
    return F.when(F.coalesce(text, F.lit("")) != "", F.concat_ws(" ", title, text)).otherwise(title)


def strip_markup(text: Column) -> Column:
    """Lower-case letters and white space only: tags and links removed, all else turned into spaces."""
    out = F.lower(text)
    out = F.regexp_replace(out, r"(?d)<.*?>", "")
    out = F.regexp_replace(out, rf"http[^{SPACE}]+|www[^{SPACE}]+", "")
    return F.regexp_replace(out, rf"[^a-zA-Z{SPACE}]", " ")


def tokenise(clean: Column, stop_words: list[str] | None = None) -> Column:
    """Words of strip_markup's result, without stop words and words of one or two letters."""
    stop = list(STOP_WORDS if stop_words is None else stop_words) + SPLIT_AND_DROPPED
    words = F.filter(
        F.split(F.coalesce(clean, F.lit("")), rf"[{SPACE}]+"),
        lambda word: (F.length(word) > 2) & ~word.isin(stop),
    )
    def shorten(token: Column) -> Column:
        branches = None
        for word, part in SPLIT_WORDS.items():
            branches = F.when(token == word, part) if branches is None else branches.when(token == word, part)
        return branches.otherwise(token)

    return F.transform(words, shorten)


def ngrams(tokens: Column, n: int = 2) -> Column:
    """Every run of n tokens joined by a space; empty when there are fewer than n."""

    def runs(words: Column) -> Column:
        starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0)))
        return F.transform(
            starts, lambda first, i: F.concat_ws(" ", first, *[F.get(words, i + k) for k in range(1, n)])
        )

    return let(tokens, runs)


def top_counted(terms: Column, k: int = 10) -> Column:
    """The k most frequent entries of an array; ties go to the entry seen first.

    Works inside the row: sort (term, position), find where each run of equal terms starts, and read the counts off
    the distances between starts. No entry leaves its row, so long or hot documents cost no shuffle.
    """
    placed = F.sort_array(F.transform(terms, lambda term, i: F.struct(term.alias("term"), i.alias("pos"))))

    def run_starts(cells: Column) -> Column:
        marked = F.transform(
            cells, lambda cell, i: F.when((i == 0) | (F.get(cells, i - 1)["term"] != cell["term"]), i)
        )
        return F.filter(marked, lambda i: i.isNotNull())

    def ranked(cells: Column, starts: Column) -> Column:
        counted = F.transform(
            starts,
            lambda at, j: F.struct(
                (at - F.coalesce(F.get(starts, j + 1), F.size(cells))).alias("minus_count"),
                F.get(cells, at)["pos"].alias("pos"),
                F.get(cells, at)["term"].alias("term"),
            ),
        )
        return F.transform(F.slice(F.sort_array(counted), 1, k), lambda cell: cell["term"])

    return let(placed, lambda cells: let(run_starts(cells), lambda starts: ranked(cells, starts)))


def is_question(title: Column) -> Column:
    return F.coalesce(F.contains(title, F.lit("?")), F.lit(False))


def null_if_empty(items: Column) -> Column:
    return let(items, lambda x: F.when(F.size(x) > 0, x))


# Up to this many terms are expressions of the plan; more are one automaton, to the same results.
PLAN_TERMS = 50


def exact_mentions(text: Column, terms: list[tuple[str, str]], plan_terms: int = PLAN_TERMS) -> Column:
    """Distinct canonical names, sorted, whose term occurs in the lower-cased text.

    `terms` is a dictionary of (lower-cased term, name) pairs that has passed a size check.
    """
    if not terms:
        return F.array().cast("array<string>")
    if len(terms) > plan_terms:
        return automaton_mentions(F.lower(text), terms)
    found = let(
        F.lower(text), lambda low: F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(n)) for t, n in terms])
    )
    return F.sort_array(F.array_distinct(F.array_compact(found)))


def clean_for_sentiment(text: Column, single_words: list[str] | None = None, plan_terms: int = PLAN_TERMS) -> Column:
    """Text made ready for scoring: code and links replaced by marks, tags dropped, dictionary words set apart,
    punctuation other than !?.,;:() blanked, smileys spelled out, spaces squeezed."""
    return cleaned(text, single_words, plan_terms)


def sentences(text: Column) -> Column:
    """Split after . ! or ? followed by white space."""
    # White space is looked for first and what stands before it only there: half the time of a pattern that looks behind everywhere.
    return F.split(text, rf"[{SPACE}](?<=[.!?][{SPACE}])[{SPACE}]*")


def context_of(text: Column, name: Column) -> Column:
    """The sentences that contain the name, whatever its case, joined by a space; '' when there is none."""
    kept = let(
        F.lower(name), lambda needle: F.filter(sentences(text), lambda s: F.contains(F.lower(s), needle))
    )
    return F.array_join(kept, " ")


def polarity_class(score: Column) -> Column:
    return F.when(score > 0.05, "positive").when(score < -0.05, "negative").otherwise("neutral")


# Five bands from very negative to very positive, their labels in display order, and the lower bound of
# each but the first (inclusive).
SENTIMENT_BANDS = ["Rất tiêu cực", "Tiêu cực", "Trung tính", "Tích cực", "Rất tích cực"]
SENTIMENT_BOUNDS = [-0.5, -0.1, 0.1, 0.5]


def sentiment_band_order(score: Column) -> Column:
    """1 to 5 from the most negative band to the most positive; NULL for a NULL score."""
    return F.when(score.isNotNull(), 1 + sum((score >= bound).cast("int") for bound in SENTIMENT_BOUNDS))


def sentiment_band(score: Column) -> Column:
    return F.get(F.array(*map(F.lit, SENTIMENT_BANDS)), sentiment_band_order(score) - 1)


def preview(text: Column, length: int = 200) -> Column:
    return F.when(F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))).otherwise(text)


def permalink_url(permalink: Column, site: str = "https://www.reddit.com") -> Column:
    return F.when(permalink != "", F.concat(F.lit(site), permalink))


# Units a period may have.
TIME_UNITS = ["day", "week", "month", "quarter"]


def period_start(unit: str, ts: Column, units: list[str] = TIME_UNITS) -> Column:
    """First day of the period; an unknown unit counts as week. Weeks start on Monday."""
    return F.date_trunc(unit if unit in units else "week", ts).cast("date")


def period_label(unit: str, day: Column) -> Column:
    """day/month, week-of-year/year (weeks start on Sunday, days before the first are week 00) or month/year."""
    if unit == "day":
        return F.date_format(day, "dd/MM")
    if unit == "month":
        return F.date_format(day, "MM/yyyy")
    week = F.floor((F.dayofyear(day) + 6 - (F.dayofweek(day) - 1)) / 7).cast("int")
    return F.concat(F.lpad(week.cast("string"), 2, "0"), F.date_format(day, "/yyyy"))


# Display name of each unit.
UNIT_LABELS = {"day": "Ngày", "week": "Tuần", "month": "Tháng", "quarter": "Quý"}
OTHER_UNIT_LABEL = "Thời gian"


def unit_label(unit: str) -> str:
    return UNIT_LABELS.get(unit, OTHER_UNIT_LABEL)


def activity_unit(days: int) -> str:
    """Grain of the activity chart for a span of days."""
    return "day" if days <= 14 else "week" if days <= 90 else "month"
