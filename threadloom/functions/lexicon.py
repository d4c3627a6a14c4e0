"""Lexicon sentiment. Rules after Hutto & Gilbert (2014); the word scores are an input table.

A scoring table has one row per lower-cased term: valence, booster, negation, polarity, subjectivity, idiom (NULL where
the term has no such role). Terms of two and three words are phrases: boosters, or idioms that have a score of their own;
no other role of theirs counts. Words with an intensity modify the known word after them: where a table has some, polarities
are those of known words with their modifiers and negations (De Smedt and Daelemans 2012), else those of the words. A table of bounded size travels with the tasks, which clean whole Arrow batches and score their words
at once (`word_sums`). A larger one is joined to the tokens by `lookup_tokens`, and everything after that is column expressions.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.functions.binding import let
from threadloom.functions.lookup import lookup_tokens, small_table
from threadloom.functions.rules import (
    ADVERB, BOOSTER_PLACES, BUT_AFTER, BUT_BEFORE, CAPITALS_STEP, DISTANCE_DAMPING, EXCLAMATION_MAX, EXCLAMATION_STEP, IDIOM_PLACES,
    NEGATION_FACTOR, NEVER_SO, NORMALISER, NO_SCORE_BEFORE, PHRASE_DISTANCE, POLARITY_EXCLAIMED, POLARITY_NEGATED,
    POLARITY_NEGATIONS, POLARITY_SHARE, QUESTION_MANY, QUESTION_MAX, QUESTION_STEP, SCORING_COLUMNS, SHORT, VADER_SHARE,
)
from threadloom.functions.text import PLAN_TERMS, clean_for_sentiment, ngrams
from threadloom.functions.wordsums import word_sums
from threadloom.sizing import BROADCAST_ROWS

# Words that strengthen and words that weaken the word after them.
BOOST = 0.293
STRENGTHEN = """
absolutely amazingly awfully completely considerably decidedly deeply effing enormously entirely especially
exceptionally extremely fabulously flipping flippin fricking frickin frigging friggin fully fucking greatly hella
highly hugely incredibly intensely majorly more most particularly purely quite really remarkably so substantially
thoroughly totally tremendously uber unbelievably unusually utterly very
""".split()
WEAKEN = """
almost barely hardly kinda kindof less little marginally occasionally partly scarcely slightly somewhat sorta sortof
""".split() + ["just enough", "kind of", "sort of"]

# Idioms and their scores.
IDIOMS = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "yeah right": -2.0, "cut the mustard": 2.0, "kiss of death": -1.5,
    "hand to mouth": -2.0,
}

# Negating words. The cleaned text has no apostrophes, so the forms without one are the ones that occur.
NEGATE = """
aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt neither neednt never
none nope nor not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent without wont wouldnt rarely seldom despite
""".split()

# Default scores of technical terms. Terms of two words never equal a single token.
TECH_VALENCES = {
    "hadoop": 0.0, "spark": 0.0, "postgresql": 0.0, "mysql": 0.0, "data warehouse": 0.0, "etl": 0.0, "pipeline": 0.0,
    "bug": -2.0, "crash": -2.5, "error": -1.5, "efficient": 2.0, "scalable": 1.5, "fast": 1.8, "slow": -1.5,
    "robust": 1.5, "outdated": -1.2, "deprecated": -1.0, "buggy": -2.5, "intuitive": 1.5, "complex": -0.5,
    "simple": 1.0, "powerful": 2.0, "weak": -1.5, "stable": 1.8, "unstable": -2.0, "expensive": -1.0, "cheap": 0.5,
    "free": 1.0, "open source": 1.0, "proprietary": -0.5, "learning curve": -0.5, "documentation": 0.5,
    "community": 1.0, "support": 1.0, "performance": 0.5, "memory leak": -2.0, "resource intensive": -1.0,
    "lightweight": 1.2, "bloated": -1.5, "best practice": 1.5, "framework": 0.0, "library": 0.0, "tool": 0.0,
}


def default_modifiers(spark: SparkSession) -> DataFrame:
    """(term, booster, negation, idiom) of the fixed lists."""
    rows = [(w, BOOST, None, None) for w in STRENGTHEN] + [(w, -BOOST, None, None) for w in WEAKEN]
    rows += [(w, None, True, None) for w in NEGATE] + [(w, None, None, score) for w, score in IDIOMS.items()]
    return spark.createDataFrame(rows, "term string, booster double, negation boolean, idiom double")


def scoring_table(
    valences: DataFrame, polarities: DataFrame | None = None, modifiers: DataFrame | None = None
) -> DataFrame:
    """Bring the three word lists to one row per lower-cased term."""
    spark = valences.sparkSession
    parts = [valences.select("term", "valence"), modifiers if modifiers is not None else default_modifiers(spark)]
    if polarities is not None:
        parts.append(polarities.select("term", *[c for c in ("polarity", "subjectivity", "intensity") if c in polarities.columns]))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    for name in SCORING_COLUMNS:
        if name not in merged.columns:
            merged = merged.withColumn(name, F.lit(None).cast("double"))
    return merged.groupBy(F.lower("term").alias("term")).agg(*[F.max(c).alias(c) for c in SCORING_COLUMNS])


def words_of(clean: Column) -> Column:
    """Tokens longer than one character, without punctuation around them unless two or fewer characters remain."""
    raw = F.filter(F.split(clean, " "), lambda w: F.length(w) > 1)

    def strip(word: Column) -> Column:
        bare = F.regexp_replace(word, r"^[!?.,;:()_]+|[!?.,;:()_]+$", "")
        return F.when(F.length(bare) <= 2, word).otherwise(bare)

    return F.transform(raw, strip)


def _is_upper(word: Column) -> Column:
    return (word == F.upper(word)) & (word != F.lower(word))


def _word_score(words: Column, found: Column, i: Column, mixed_case: Column, phrases: dict[int, Column]) -> Column:
    """Valence of the word at position i after capitals, boosters, negations and phrases in front of it, or of its idiom.

    phrases: by number of words, what the table has for the phrase that begins at each word.
    """

    def lower_at(distance: int) -> Column:
        return F.lower(F.get(words, i - distance))

    def capital_step(distance: int, score: Column) -> Column:
        step = F.when(score > 0, CAPITALS_STEP).otherwise(-CAPITALS_STEP)
        return F.when(mixed_case & _is_upper(F.get(words, i - distance)), step).otherwise(0.0)

    def effect(distance: int, damping: float) -> Callable[[Column], Column]:
        """Score before to score after the word at this distance has had its effect."""
        return lambda score: after_modifier(distance, damping, score)

    def after_modifier(distance: int, damping: float, score: Column) -> Column:
        before = F.get(found, i - distance)
        # A word in front counts as a modifier only when it has no valence of its own.
        free = (i >= distance) & before["valence"].isNull()
        step = F.when(score < 0, -before["booster"]).otherwise(before["booster"])
        boost = F.when(free, (step + capital_step(distance, score)) * damping)

        def negate(shifted: Column) -> Column:
            negated = F.when(free & F.coalesce(before["negation"], F.lit(False)), shifted * NEGATION_FACTOR)
            if distance in NEVER_SO:
                between = F.array(*[lower_at(d) for d in range(1, distance)])
                so = F.arrays_overlap(between, F.array(F.lit("so"), F.lit("this")))
                never = F.coalesce(free & (lower_at(distance) == "never") & so, F.lit(False))
                return F.when(never, shifted * NEVER_SO[distance]).otherwise(negated.otherwise(shifted))
            return negated.otherwise(shifted)

        return let(score + F.coalesce(boost, F.lit(0.0)), negate)

    valence = F.get(found, i)["valence"]
    score = valence + capital_step(0, valence)
    for distance, damping in enumerate(DISTANCE_DAMPING, 1):
        score = let(score, effect(distance, damping))
    if phrases:
        role = lambda place, name: F.get(phrases[place[0]], i - place[1])[name]
        far = (i >= PHRASE_DISTANCE) & F.get(found, i - PHRASE_DISTANCE)["valence"].isNull()
        idiom = F.when(far, F.coalesce(*[role(place, "idiom") for place in IDIOM_PLACES]))
        score = F.coalesce(idiom, score)
        for place in BOOSTER_PLACES:
            score = score + F.coalesce(F.when(far, role(place, "booster")), F.lit(0.0))

    least = (i >= 1) & (lower_at(1) == "least") & F.get(found, i - 1)["valence"].isNull()
    allowed = ~F.coalesce(lower_at(2).isin("at", "very"), F.lit(False))
    return score * F.when(least & allowed, NEGATION_FACTOR).otherwise(1.0)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _count(words: Column, test) -> Column:
    return F.size(F.filter(words, test))


def _word_scores(words: Column, found: Column, phrases: dict[int, Column]) -> Column:
    """Scores of the words that have one. 'but' halves what stands before it and raises what comes after by half."""
    upper = _count(words, _is_upper)
    first, second = NO_SCORE_BEFORE
    bound = F.struct(
        words.alias("words"),
        found.alias("found"),
        ((upper > 0) & (upper < F.size(words))).alias("mixed"),
        (F.array_position(F.transform(words, lambda x: F.lower(x)), "but").cast("int") - 1).alias("but"),
        *[cells.alias(f"phrases_{n}") for n, cells in phrases.items()],
    )

    def scores(v: Column) -> Column:
        # A word that is itself a booster, or part of one, has no score of its own.
        part = lambda i: (F.lower(F.get(v["words"], i)) == first) & F.coalesce(F.lower(F.get(v["words"], i + 1)) == second, F.lit(False))
        positions = F.filter(
            F.transform(
                v["found"], lambda cell, i: F.when(cell["valence"].isNotNull() & cell["booster"].isNull() & ~part(i), i)
            ),
            lambda i: i.isNotNull(),
        )
        but = v["but"]
        meant = {n: v[f"phrases_{n}"] for n in phrases}

        def weighted(i: Column) -> Column:
            weight = F.when((but >= 0) & (i < but), BUT_BEFORE).when((but >= 0) & (i > but), BUT_AFTER).otherwise(1.0)
            return _word_score(v["words"], v["found"], i, v["mixed"], meant) * weight

        return F.transform(positions, weighted)

    return let(bound, scores)


def _occurrences(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _emphasis(questions: Column, exclamations: Column) -> Column:
    asked = F.when(questions <= 1, 0.0).when(questions <= QUESTION_MAX, questions * QUESTION_STEP)
    return F.least(exclamations, F.lit(EXCLAMATION_MAX)) * EXCLAMATION_STEP + asked.otherwise(QUESTION_MANY)


def _shares(v: Column) -> Column:
    """Struct of compound, pos, neg and neu from the sums in v."""
    s, e, p, n = v["sum"], v["emphasis"], v["pos"], v["neg"]
    parts = F.struct(
        F.when(s > 0, s + e).when(s < 0, s - e).otherwise(s).alias("total"),
        (p + F.when(p > n, e).otherwise(0.0)).alias("pos"),
        (n + F.when(n > p, e).otherwise(0.0)).alias("neg"),
        v["neu"].alias("neu"),
        v["empty"].alias("empty"),
    )

    def finish(x: Column) -> Column:
        whole = x["pos"] + x["neg"] + x["neu"]
        share = lambda part: F.coalesce(F.round(F.try_divide(part, whole), 3), F.lit(0.0))
        t = x["total"]
        return F.struct(
            F.when(x["empty"], 0.0).otherwise(F.round(t / F.sqrt(t * t + NORMALISER), 4)).alias("compound"),
            share(x["pos"]).alias("pos"),
            share(x["neg"]).alias("neg"),
            F.when(x["empty"], 1.0).otherwise(share(x["neu"])).alias("neu"),
        )

    return let(parts, finish)


def _bare(token: Column) -> Column:
    return F.regexp_replace(token, r"^[!?.,;:()_]+|[!?.,;:()_]+$", "")


def _bare_words(clean: Column) -> Column:
    """Lower-cased tokens without the marks around them, of more than one character."""
    return F.filter(F.transform(F.split(clean, " "), lambda w: F.lower(_bare(w))), lambda w: F.length(w) > 1)


def _assessed(clean: Column, words: Column, found: Column) -> Column:
    """Struct of polarity and subjectivity: means over the known words of a text, each with the modifiers in front of it.
    words: _bare_words, found: what the table has for them.

    One pass over the words and marks in their order. The state: a modifier that still reaches on, whether it is an adverb, a
    negation just seen, the last assessment, and sums of those before it.
    """
    most_one = lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))
    start = F.struct(
        F.lit(0).alias("at"), *[F.lit(False).alias(c) for c in ("modified", "adverb", "negation", "any", "negated")],
        *[F.lit(x).alias(c) for c, x in (("p", 0.0), ("s", 0.0), ("factor", 1.0), ("sum_p", 0.0), ("sum_s", 0.0))], F.lit(0).alias("n"),
    )
    names = ["at", "modified", "adverb", "negation", "any", "negated", "p", "s", "factor", "sum_p", "sum_s", "n"]
    changed = lambda a, **new: F.struct(*[new.get(c, a[c]).alias(c) for c in names])

    def exclaimed(a: Column, marks: Column) -> Column:
        raised = most_one(a["p"] * F.pow(F.lit(POLARITY_EXCLAIMED), marks))
        return changed(a, p=F.when(a["any"] & (marks > 0), raised).otherwise(a["p"]))

    def closed(a: Column) -> Column:
        p = F.when(a["negated"], a["p"] * POLARITY_NEGATED).otherwise(a["p"])
        done = changed(a, sum_p=a["sum_p"] + p, sum_s=a["sum_s"] + a["s"], n=a["n"] + 1)
        return F.when(a["any"], done).otherwise(a)

    def known(a: Column, cell: Column, low: Column) -> Column:
        own = F.coalesce(cell["intensity"], F.lit(1.0))
        times = F.when(a["modified"], a["factor"]).otherwise(1.0)
        new = lambda c: F.when(a["modified"], most_one(cell[c] * times)).otherwise(cell[c])
        return let(F.when(a["modified"], a).otherwise(closed(a)), lambda b: changed(
            b, at=a["at"] + 1, modified=cell["intensity"].isNotNull(), adverb=F.endswith(low, F.lit(ADVERB)), negation=low.isin(*POLARITY_NEGATIONS),
            any=F.lit(True), negated=(a["modified"] & a["negated"]) | a["negation"], p=new("polarity"), s=new("subjectivity"),
            factor=F.when(a["negation"], F.coalesce(F.try_divide(F.lit(1.0), own), F.lit(0.0))).otherwise(own),
        ))

    def unknown(a: Column, low: Column) -> Column:
        negates = low.isin(*POLARITY_NEGATIONS)
        taken = negates & a["modified"] & a["adverb"]
        return changed(
            a, at=a["at"] + 1, negated=a["negated"] | taken, negation=negates & ~taken, modified=a["modified"] & (taken | (F.length(low) <= SHORT))
        )

    def word(a: Column, token: Column) -> Column:
        cell, low = F.get(found, a["at"]), F.get(words, a["at"])
        step = let(low, lambda x: F.when(cell["polarity"].isNotNull(), known(a, cell, x)).otherwise(unknown(a, x)))
        return F.when(F.length(F.lower(_bare(token))) > 1, step).otherwise(a)

    def token(a: Column, x: Column) -> Column:
        ahead = F.regexp_replace(x, r"^[!?.,;:()_]+", "")
        bare = F.regexp_replace(ahead, r"[!?.,;:()_]+$", "")
        before, after = _occurrences(x, "!") - _occurrences(ahead, "!"), _occurrences(ahead, "!") - _occurrences(bare, "!")
        return let(let(exclaimed(a, before), lambda b: word(b, x)), lambda b: exclaimed(b, after))

    mean = lambda a, total: F.coalesce(F.try_divide(a[total], a["n"]), F.lit(0.0))
    end = lambda a: let(closed(a), lambda b: F.struct(mean(b, "sum_p").alias("polarity"), mean(b, "sum_s").alias("subjectivity")))
    return F.aggregate(F.split(clean, " "), start, token, end)


def score_words(
    df: DataFrame, clean: str, words: str, found: str, phrases: dict[int, Column] | None = None, rated: Column | None = None
) -> DataFrame:
    """Add compound, pos, neg, neu, polarity and subjectivity; the input columns stay. rated: struct of the last two."""
    text, w, f = F.col(clean), F.col(words), F.col(found)

    def sums(scores: Column) -> Column:
        # Words without a score, or with a score of zero, are neutral.
        neutral = F.size(w) - _count(scores, lambda x: x != 0)
        return F.struct(
            _sum(scores).alias("sum"),
            _sum(F.transform(scores, lambda x: F.when(x > 0, x + 1).otherwise(0.0))).alias("pos"),
            _sum(F.transform(scores, lambda x: F.when(x < 0, 1 - x).otherwise(0.0))).alias("neg"),
            neutral.alias("neu"),
            _emphasis(_occurrences(text, "?"), _occurrences(text, "!")).alias("emphasis"),
            (text == "").alias("empty"),
        )

    known = F.filter(f, lambda cell: cell["polarity"].isNotNull())
    mean = lambda cells, name: F.coalesce(
        F.try_divide(_sum(F.transform(cells, lambda cell: cell[name])), F.size(cells)), F.lit(0.0)
    )
    means = let(
        known,
        lambda cells: F.struct(
            mean(cells, "polarity").alias("polarity"), mean(cells, "subjectivity").alias("subjectivity")
        ),
    )
    scored = df.select(
        "*", let(let(_word_scores(w, f, phrases or {}), sums), _shares).alias("_scored"), (means if rated is None else rated).alias("_rated")
    )
    return scored.select(*df.columns, "_scored.*", "_rated.*")


def ensemble(compound: Column, polarity: Column) -> Column:
    mixed = VADER_SHARE * F.coalesce(compound, F.lit(0.0)) + POLARITY_SHARE * F.coalesce(polarity, F.lit(0.0))
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), mixed))


def score_text(
    df: DataFrame, key: str, text: str, scoring: DataFrame, single_words: list[str] | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add compound, pos, neg, neu, polarity, subjectivity and ensemble_score of a text column.

    `key` identifies a row; NULL and empty texts score 0 with neu = 1. Scoring tables of more than max_rows rows are
    joined, to the same results. Columns that a scoring table lacks are roles that no term of it has.
    """
    scoring = scoring.withColumns({c: F.lit(None).cast("double") for c in SCORING_COLUMNS if c not in scoring.columns})
    small = small_table(scoring, "term", max_rows)
    if small is None:
        scored = _score_joined(df.withColumn("_clean", clean_for_sentiment(F.col(text), single_words)), key, scoring, max_rows)
    else:
        scored = _score_small(df, text, single_words, small)
    return scored.select(
        *df.columns,
        *["compound", "pos", "neg", "neu", "polarity", "subjectivity"],
        ensemble(F.col("compound"), F.col("polarity")).alias("ensemble_score"),
    )


def _score_small(df: DataFrame, text: str, single_words: list[str] | None, scoring: pa.Table) -> DataFrame:
    summed = df.withColumn("_sums", word_sums(F.col(text), single_words, scoring, PLAN_TERMS))
    sums = F.col("_sums")
    parts = F.struct(
        *[sums[c].alias(c) for c in ("sum", "pos", "neg", "neu", "empty")],
        _emphasis(sums["questions"], sums["exclamations"]).alias("emphasis"),
    )
    scored = summed.withColumn("_scored", let(parts, _shares))
    return scored.select(*df.columns, "_scored.*", "_sums.polarity", "_sums.subjectivity")


def _score_joined(cleaned: DataFrame, key: str, scoring: DataFrame, max_rows: int) -> DataFrame:
    # All joined, also where a part of the table is small: Spark does not take a Python call out of a plan above such a join.
    words = cleaned.withColumn("_words", words_of(F.col("_clean")))
    words = words.withColumn("_lower", F.transform("_words", lambda w: F.lower(w)))
    found = lookup_tokens(words, key, "_lower", scoring, "term", "_found", max_rows)
    rated = None
    if not scoring.where(F.col("intensity").isNotNull() & F.col("polarity").isNotNull()).isEmpty():
        found = found.withColumn("_bare", _bare_words(F.col("_clean")))
        found = lookup_tokens(found, key, "_bare", scoring, "term", "_bare_found", 0)
        rated = _assessed(F.col("_clean"), F.col("_bare"), F.col("_bare_found"))
    meant = scoring.where(F.contains("term", F.lit(" ")) & (F.col("booster").isNotNull() | F.col("idiom").isNotNull()))
    if meant.isEmpty():
        return score_words(found, "_clean", "_words", "_found", rated=rated)
    runs = F.concat(*[ngrams(F.col("_lower"), n) for n in (2, 3)])
    found = lookup_tokens(found.withColumn("_runs", runs), key, "_runs", meant, "term", "_meant", 0)
    two, three = (F.greatest(F.size("_lower") - less, F.lit(0)) for less in (1, 2))
    phrases = {2: F.slice("_meant", F.lit(1), two), 3: F.slice("_meant", two + 1, three)}
    return score_words(found, "_clean", "_words", "_found", phrases, rated)
