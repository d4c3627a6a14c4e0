import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from threadloom.functions import fuzzy, lexicon as L, text as X
from threadloom.functions.lookup import lookup_tokens
from threadloom.operators import features as F1, sentiment as S


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()[0]


def lit(value):
    return F.lit(value)


@pytest.mark.parametrize(
    "title, text, expected", [("a", "b", "a b"), ("a", "", "a"), ("a", None, "a"), (None, "b", "b"), (None, None, None)]
)
def test_full_text(spark, title, text, expected):
    found = one(spark, X.full_text(lit(title).cast("string"), lit(text).cast("string")))
    assert found == expected


def test_markup_links_and_digits_go(spark):
    assert one(spark, X.strip_markup(lit("A<b>B</b> http://x.y/z?q=1 C3 www.q.r d"))) == "ab  c   d"


def test_tag_does_not_cross_lines(spark):
    assert one(spark, X.strip_markup(lit("a<b\nc>d"))) == "a b\nc d"


def test_tokens_without_stop_words_and_short_words(spark):
    clean = lit("the gonna cannot pipeline is ok  wanna data")
    assert one(spark, X.tokenise(clean)) == ["gon", "pipeline", "wan", "data"]
    assert one(spark, X.tokenise(lit(None).cast("string"))) == []


@pytest.mark.parametrize("tokens, n, expected", [(["a", "b", "c"], 2, ["a b", "b c"]), (["a"], 2, []), (["a", "b"], 3, []), ([], 2, [])])
def test_ngrams(spark, tokens, n, expected):
    array = F.array(*map(lit, tokens)) if tokens else F.array().cast("array<string>")
    assert one(spark, X.ngrams(array, n)) == expected


def test_top_counted_equals_counter(spark):
    generator = random.Random(3)
    data = [(i, [generator.choice("abcdefgh") for _ in range(generator.randint(0, 40))]) for i in range(60)]
    df = spark.createDataFrame(data, "id int, items array<string>")
    found = dict(rows(df.select("id", X.top_counted(F.col("items"), 3).alias("top"))))
    assert found == {i: [t for t, _ in Counter(items).most_common(3)] for i, items in data}


def test_topics_count_pairs_before_triples(spark):
    df = spark.createDataFrame([(1, ["aaa", "bbb", "aaa", "bbb"])], "id int, tokens array<string>")
    assert F1.doc_topics(df).first()["topics"] == ["aaa bbb", "bbb aaa", "aaa bbb aaa", "bbb aaa bbb"]


def test_expensive_columns_survive_a_pushed_filter(spark):
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(6000))
    df = spark.createDataFrame([(1, text)], "id int, text string")
    found = F1.doc_topics(F1.with_tokens(df, "id", "text")).where(F.size("topics") > 0)
    assert found.count() == 1


@pytest.mark.parametrize("title, expected", [("why?", True), ("why", False), (None, False)])
def test_is_question(spark, title, expected):
    assert one(spark, X.is_question(lit(title).cast("string"))) is expected


def test_clean_for_sentiment(spark):
    text = "Use `x` and ```a\nb``` at http://a.b <b>now</b>: Spark2go :) :-) :( #1!"
    assert one(spark, X.clean_for_sentiment(lit(text), ["spark"])) == (
        "Use CODE_SNIPPET and CODE_BLOCK at URL now: Spark 2go positive_emoji : ) negative_emoji 1!"
    )


def test_sentences_and_context(spark):
    text = "Spark is fast. I like flink!  Nothing here? SPARK again."
    assert one(spark, X.sentences(lit(text))) == ["Spark is fast.", "I like flink!", "Nothing here?", "SPARK again."]
    assert one(spark, X.context_of(lit(text), lit("Spark"))) == "Spark is fast. SPARK again."
    assert one(spark, X.context_of(lit(text), lit("hive"))) == ""


def test_exact_mentions_map_to_names(spark):
    terms = [("spark", "spark"), ("pyspark", "spark"), ("hive", "hive")]
    assert one(spark, X.exact_mentions(lit("PySpark beats sparkling archives"), terms)) == ["hive", "spark"]


@pytest.mark.parametrize("score, kind", [(0.05, "neutral"), (0.051, "positive"), (-0.05, "neutral"), (-0.051, "negative")])
def test_polarity_class(spark, score, kind):
    assert one(spark, X.polarity_class(lit(score))) == kind


@pytest.mark.parametrize("score, band", [(-0.51, 1), (-0.5, 2), (-0.1, 3), (0.1, 4), (0.5, 5), (None, None)])
def test_sentiment_bands(spark, score, band):
    assert one(spark, X.sentiment_band_order(lit(score).cast("double"))) == band
    label = one(spark, X.sentiment_band(lit(score).cast("double")))
    assert label == (X.SENTIMENT_BANDS[band - 1] if band else None)


def test_preview_and_link(spark):
    assert one(spark, X.preview(lit("x" * 201), 200)) == "x" * 200 + "..."
    assert one(spark, X.preview(lit("x" * 200), 200)) == "x" * 200
    assert one(spark, X.permalink_url(lit(""))) is None
    assert one(spark, X.permalink_url(lit("/r/a"))).endswith("/r/a")


def awkward_texts():
    generator = random.Random(8)
    parts = ["ab", "abc", "bcd", "c", "İ", "A", "AB", "\n", " ", "😀", "ß", "x"]
    return ["".join(generator.choice(parts) for _ in range(generator.randint(0, 12))) for _ in range(300)] + ["", None, "ab" * 20_000]


def test_automaton_and_plan_find_the_same_names(spark):
    terms = [("ab", "one"), ("abc", "one"), ("bcd", "two"), ("b", "three"), ("😀", "four"), ("ss", "five"), ("ab", "six")]
    df = spark.createDataFrame([(t,) for t in awkward_texts()], "text string")
    for pairs in (terms, [*terms, ("", "always")], [("", "always")]):
        both = df.select(X.exact_mentions(F.col("text"), pairs).alias("a"), X.exact_mentions(F.col("text"), pairs, 0).alias("b")).collect()
        # A NULL text has no names either way.
        assert [r.a for r in both] == [r.b for r in both]


def test_automaton_and_pattern_set_the_same_words_apart(spark):
    words = ["ab", "ABC", "bcd", "c", "ß", "bx"]
    df = spark.createDataFrame([(t,) for t in awkward_texts()], "text string")
    both = df.select(X.clean_for_sentiment(F.col("text"), words).alias("a"), X.clean_for_sentiment(F.col("text"), words, 0).alias("b")).collect()
    assert [r.a for r in both] == [r.b for r in both]


def test_large_dictionaries_keep_the_plan_small(spark):
    df = spark.createDataFrame([("we use term77777 and term5 here",)], "text string")

    def plan(n):
        found = df.select(X.exact_mentions(F.col("text"), [(f"term{i} ", f"n{i}") for i in range(n)]).alias("x"))
        return found, found._jdf.queryExecution().toString()

    (large, text), (_, small) = plan(100_000), plan(60)
    assert large.first().x == ["n5", "n77777"]
    assert abs(len(text) - len(small)) < 200


def test_fuzzy_equals_brute_force():
    generator = random.Random(5)
    terms = ["flink", "hive", "apache hive", "data model", "pig", "postgresql"]
    texts = []
    for _ in range(150):
        base = "".join(generator.choice("abdefghiklmnopqr st") for _ in range(generator.choice([0, 1, 4, 9, 40])))
        cut = generator.choice(terms)[: generator.randint(2, 11)]
        at = generator.choice([0, len(base), len(base) // 2])
        texts.append(base[:at] + cut + base[at:] if generator.random() < 0.7 else base)
    for cutoff in (60.0, 80.0):
        expected = []
        for text in texts:
            scores = [fuzzy.partial_score(t, text) if text else 0.0 for t in terms]
            hits = [i for i in range(len(terms)) if scores[i] >= cutoff]
            expected.append(sorted(hits, key=lambda i: (-scores[i], i))[:5])
        assert fuzzy.best_terms(pd.Series(texts), terms, cutoff) == expected


def test_fuzzy_filters_lose_no_window():
    generator = random.Random(6)
    for _ in range(40):
        terms = list({"".join(generator.choice("abcde") for _ in range(generator.randint(1, 12))) for _ in range(6)})
        texts = ["".join(generator.choice("abcdef ") for _ in range(generator.choice([0, 1, 3, 8, 30]))) for _ in range(8)]
        texts += [t[: len(t) // 2] + generator.choice(terms)[1:] + t[len(t) // 2 :] for t in texts]
        for cutoff in (50.0, 80.0, 90.0, 100.0):
            want = []
            for text in texts:
                scores = [fuzzy.partial_score(t, text) if text else 0.0 for t in terms]
                want.append(sorted((i for i in range(len(terms)) if scores[i] >= cutoff), key=lambda i: (-scores[i], i)))
            assert fuzzy.best_terms(pd.Series(texts), terms, cutoff, None) == want
            both = fuzzy.best_in_dictionaries(pd.Series(texts), [terms[:2], [], terms], cutoff, None)
            assert both == [fuzzy.best_terms(pd.Series(texts), terms[:2], cutoff, None), [[] for _ in texts], want]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("we use blink here", ["flink"]),  # four of five letters
        ("we use hivx here", []),  # three of four letters are not enough
        ("pi", ["pig"]),  # shorter than the term: 2 * 2 / 4 counts the clipped window
        ("apache spark", ["spark"]),
        ("", []),
        (None, []),
    ],
)
def test_fuzzy_cases(spark, text, expected):
    terms = [("flink", "flink"), ("hive", "hive"), ("pig", "pig"), ("apache spark", "spark")]
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(fuzzy.fuzzy_mentions(F.col("text"), terms)).first()[0] == expected


def test_fuzzy_limit_comes_before_names(spark):
    terms = [(t, "many") for t in ("aaa", "bbb", "ccc", "ddd", "eee")] + [("fff", "last")]
    df = spark.createDataFrame([("aaa bbb ccc ddd eee fff",)], "text string")
    assert df.select(fuzzy.fuzzy_mentions(F.col("text"), terms)).first()[0] == ["many"]
    assert df.select(fuzzy.fuzzy_mentions(F.col("text"), terms, limit=None)).first()[0] == ["last", "many"]


def test_lookup_paths_agree(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, None), (4, ["z"])], "id int, t array<string>")
    table = spark.createDataFrame([("a", "A"), ("c", "C")], "form string, lemma string")
    small = lookup_tokens(df, "id", "t", table, "form", "o")
    joined = lookup_tokens(df, "id", "t", table, "form", "o", max_rows=1)
    assert rows(small, "id", "o") == rows(joined, "id", "o")


@pytest.fixture(scope="module")
def scoring(spark):
    words = {"good": 1.9, "great": 3.1, "bad": -2.5}
    polarity = spark.createDataFrame([("good", 0.7, 0.6), ("book", 0.1, 0.2)], "term string, polarity double, subjectivity double")
    return L.scoring_table(spark.createDataFrame(list(words.items()), "term string, valence double"), polarity)


# Compound scores published with the rules, or worked out by hand from them.
CASES = {
    "The book was good.": 0.4404,
    "not good": -0.3412,
    "very good": 0.4927,
    "never so good": 0.6474,
    "at least good": 0.4404,
    "least good": -0.3412,
    "good but bad": -0.5859,
    "plain words": 0.0,
    "": 0.0,
}


def test_compound(spark, scoring):
    df = spark.createDataFrame([(t,) for t in CASES], "text string")
    found = dict(rows(L.score_text(df, "text", "text", scoring), "text", "compound"))
    assert found == CASES


def test_empty_text_is_neutral_and_scores_are_bounded(spark, scoring):
    texts = ["", None, "good " * 200 + "!!!!", "bad " * 200]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = {r["id"]: r for r in L.score_text(df, "id", "text", scoring).collect()}
    assert (found[0]["neu"], found[0]["ensemble_score"], found[1]["neu"]) == (1.0, 0.0, 1.0)
    assert all(-1 <= r["ensemble_score"] <= 1 for r in found.values())
    assert found[2]["compound"] > 0.99 and found[3]["compound"] < -0.99


def test_polarity_is_the_mean_over_known_words(spark, scoring):
    df = spark.createDataFrame([(1, "good book")], "id int, text string")
    row = L.score_text(df, "id", "text", scoring).first()
    assert row["polarity"] == pytest.approx(0.4) and row["subjectivity"] == pytest.approx(0.4)


def test_sentiment_per_name(spark, scoring):
    df = spark.createDataFrame([("p", "Spark is good. Hive is bad. Nice day."), ("q", "nothing")], "post_id string, full_text string")
    terms = [("spark", "spark"), ("hive", "hive")]
    found = S.tech_sentiments(df, terms, scoring)
    scores = {r["tech_name"]: r for r in found.collect()}
    assert scores["spark"]["context"] == "Spark is good." and scores["spark"]["score"] > 0
    assert scores["hive"]["score"] < 0
    means = dict(rows(S.mean_tech_sentiment(df, found)))
    assert means["q"] == 0.0


@pytest.mark.parametrize("n", [2, 3, 4, 5, 17])
def test_thirds(spark, n):
    import hashlib

    data = [("t", f"p{i}", i * 0.1, f"2024-01-0{1 + i % 3} 00:00:0{i % 2}") for i in range(n)]
    df = spark.createDataFrame(data, "tech_name string, post_id string, score double, d string").withColumn(
        "created_date", F.to_timestamp("d")
    )
    found = S.tech_sentiment_thirds(df).collect()
    if n < 3:
        assert found == []
        return
    order = sorted(data, key=lambda r: (r[3], hashlib.md5(r[1].encode()).hexdigest(), r[1]))
    scores, k = [r[2] for r in order], n // 3
    mean = lambda part: pytest.approx(sum(part) / len(part))
    assert tuple(found[0])[1:] == (mean(scores[:k]), mean(scores[k : 2 * k]), mean(scores[2 * k :]))
