"""Work on whole Arrow batches against the column expressions of the same rules."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from threadloom.functions import fuzzy, lexicon as L, wordsums
from threadloom.operators import sentiment as S

WORDS = "good BAD Great very so this never least at not but spark Spark's slow. (fine) don't été ÜBER :) x !? ... a. b.c".split()


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    return ["", None, " ", "never so good", "never this bad very least good"] + [
        draw.choice(" \t").join(draw.choice(WORDS) for _ in range(draw.randint(0, 40))) + draw.choice(["", "!", "!!!!!", "??", "????"])
        for _ in range(400)
    ]


def scoring(spark):
    cells = [
        ("good", 1.9, None, None, 0.7, 0.6), ("bad", -2.5, None, None, -0.7, None), ("great", 3.1, None, None, 0.8, 0.75),
        ("slow", -1.5, 0.1, None, None, None), ("very", None, 0.293, None, 0.2, 0.3), ("fine", 0.8, None, None, 0.4, 0.5),
        ("not", None, None, True, None, None), ("at", None, -0.293, True, None, None), ("été", 0.0, None, None, -0.1, 0.2),
    ]
    return spark.createDataFrame(cells, "term string, valence double, booster double, negation boolean, polarity double, subjectivity double")


def test_batch_scores_equal_joined_ones(spark, texts, monkeypatch):
    monkeypatch.setattr(wordsums, "CHARACTERS", 500)
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    small = rows(L.score_text(df, "id", "text", scoring(spark), ["spark"]))
    assert small == rows(L.score_text(df, "id", "text", scoring(spark), ["spark"], max_rows=0))
    assert len({r[2] for r in small}) > 100


PHRASES = "the bomb was yeah right kind of good good hand to mouth kiss of death so never bad".split()


def phrase_scoring(spark):
    valences = {"bomb": -2.2, "right": 0.5, "good": 1.9, "kind": 2.4, "mouth": 0.1, "kiss": 1.8, "death": -2.9, "bad": -2.5, "data warehouse": 3.0}
    return L.scoring_table(spark.createDataFrame(list(valences.items()), "term string, valence double")), valences


def published(words, valences):
    """Sum of the scores of lower-cased words without capitals and 'but', by the published steps one word after the other."""
    total = 0.0
    boosters = {w: L.BOOST for w in L.STRENGTHEN} | {w: -L.BOOST for w in L.WEAKEN}
    for i, w in enumerate(words):
        if w in boosters or words[i : i + 2] == ["kind", "of"] or w not in valences:
            continue
        score = valences[w]
        run = lambda first, n: " ".join(words[first : first + n]) if first + n <= len(words) else None  # noqa: E731, B023
        for back, damping in ((1, 1.0), (2, 0.95), (3, 0.9)):
            if i < back or words[i - back] in valences:
                continue
            step = boosters.get(words[i - back], 0.0)
            score += (-step if score < 0 else step) * damping
            so = back > 1 and {"so", "this"} & set(words[i - back + 1 : i])
            if words[i - back] == "never" and so:
                score *= {2: 1.5, 3: 1.25}[back]
            elif words[i - back] in L.NEGATE:
                score *= -0.74
            if back == 3:
                for idiom in (run(i - 1, 2), run(i - 2, 3), run(i - 2, 2), run(i - 3, 3), run(i - 3, 2)):
                    if idiom in L.IDIOMS:
                        score = L.IDIOMS[idiom]
                        break
                score = L.IDIOMS.get(run(i, 2), score)
                score = L.IDIOMS.get(run(i, 3), score)
                score += sum(boosters.get(run(*at), 0.0) for at in ((i - 3, 3), (i - 3, 2), (i - 2, 2)))
        total += score
    return total


def test_phrases_are_scored(spark):
    scoring, valences = phrase_scoring(spark)
    cases = {
        "we all think it is the bomb": 0.6124, "the bomb": -0.4939, "it was kind of good then": 0.3832, "all were very kind to us": 0.5709,
        "they live from hand to mouth": -0.4588, "a data warehouse was here all day": 0.0,
    }
    df = spark.createDataFrame([(t,) for t in cases], "text string")
    assert dict(rows(L.score_text(df, "text", "text", scoring), "text", "compound")) == cases
    draw = random.Random(7)
    texts = sorted({" ".join(draw.choice(PHRASES) for _ in range(draw.randint(0, 12))) for _ in range(400)})
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    small = rows(L.score_text(df, "text", "text", scoring))
    assert small == rows(L.score_text(df, "text", "text", scoring, max_rows=0))
    for text, compound, *_ in small:
        total = published(text.split(), valences)
        assert compound == pytest.approx(total / (total * total + 15) ** 0.5, abs=1e-4), text


def test_phrases_need_no_column_in_the_table(spark):
    scoring, _ = phrase_scoring(spark)
    df = spark.createDataFrame([("we all think it is the bomb",)], "text string")
    plain = scoring.drop("idiom")
    assert [L.score_text(df, "text", "text", plain, max_rows=n).first()["compound"] for n in (0, 100)] == [-0.4939] * 2


MODIFIED = "good good! Bad very really really not never no it is a and fine !good! (fine)! ! !! slightly ... so".split()


def polarity_scoring(spark):
    """(polarity, subjectivity, intensity) by word; those with an intensity are modifiers."""
    cells = {
        "good": (0.7, 0.6, None), "bad": (-0.7, 0.67, None), "very": (0.2, 0.3, 1.3), "really": (0.2, 0.2, 1.5), "fine": (0.42, 0.5, None),
        "slightly": (-0.17, 0.17, 0.5), "no": (-0.1, 0.4, None), "so": (0.0, 0.1, 0.0),
    }
    polarity = spark.createDataFrame([(w, *c) for w, c in cells.items()], "term string, polarity double, subjectivity double, intensity double")
    return L.scoring_table(spark.createDataFrame([("good", 1.9)], "term string, valence double"), polarity), cells


def assessed(text, cells):
    """Polarity and subjectivity word after word, marks apart, as the library's loop has them."""
    found, modifier, negation = [], None, None
    tokens = []
    for raw in text.lower().split(" "):
        left = raw.lstrip(wordsums.MARKS)
        bare = left.rstrip(wordsums.MARKS)
        tokens += [*raw[: len(raw) - len(left)], *([bare] if len(bare) > 1 else []), *left[len(bare):]]
    for w in tokens:
        if w in cells:
            p, s, own = cells[w]
            if modifier is None:
                found.append({"p": p, "s": s, "i": own if own is not None else 1.0, "n": 1})
            else:
                last = found[-1]
                last["p"], last["s"] = (max(-1.0, min(x * last["i"], 1.0)) for x in (p, s))
                last["i"] = own if own is not None else 1.0
            if negation is not None:
                found[-1]["i"] = 1.0 / found[-1]["i"] if found[-1]["i"] else 0.0
                found[-1]["n"] = -1
            modifier = w if own is not None else None
            negation = w if w in ("no", "not", "never") else None
            continue
        if w in ("no", "not", "never"):
            negation = w
        elif negation and len(w) > 1:
            negation = None
        if negation is not None and modifier is not None and modifier.endswith("ly"):
            found[-1]["n"], negation = -1, None
        elif modifier and len(w) > 2:
            modifier = None
        if w == "!" and found:
            found[-1]["p"] = max(-1.0, min(found[-1]["p"] * 1.25, 1.0))
    mean = lambda x: sum(x) / (len(x) or 1)
    return mean([x["p"] * (-0.5 if x["n"] < 0 else 1) for x in found]), mean([x["s"] for x in found])


def test_polarities_of_a_table_with_intensities(spark):
    scoring, cells = polarity_scoring(spark)
    cases = {
        "good": 0.7, "very good": 0.91, "not good": -0.35, "really not good": -0.5, "very not good": (0.2 - 0.35) / 2, "good!": 0.875,
        "not and good": 0.7, "really is good": 1.0, "really and good": 0.45, "good, bad": 0.0, "and it": 0.0, "": 0.0,
    }
    df = spark.createDataFrame([(t,) for t in cases], "text string")
    found = dict(rows(L.score_text(df, "text", "text", scoring), "text", "polarity"))
    assert found == {t: pytest.approx(p) for t, p in cases.items()}
    draw = random.Random(11)
    texts = sorted({" ".join(draw.choice(MODIFIED) for _ in range(draw.randint(0, 14))) for _ in range(600)})
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    near = lambda x: pytest.approx(x, abs=1e-9)
    for n in (100_000, 0):
        found = {t: r for t, *r in rows(L.score_text(df, "text", "text", scoring, max_rows=n), "text", "polarity", "subjectivity")}
        assert found == {t: [*map(near, assessed(" ".join(t.split()), cells))] for t in texts}


def test_words_are_scored_without_an_expression_per_word(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    scored = L.score_text(df, "id", "text", scoring(spark), ["spark"])
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan and "filter(" not in plan


def test_text_is_split_once_for_all_its_names(spark):
    df = spark.createDataFrame([("1", "Spark is good. spark and Flink! Flink is bad"), ("2", "none"), ("3", None)], "post_id string, full_text string")
    found = S.tech_sentiments(df, [("spark", "Spark"), ("flink", "Flink")], scoring(spark))
    assert rows(found, "post_id", "tech_name", "context") == [
        ("1", "Flink", "spark and Flink! Flink is bad"), ("1", "Spark", "Spark is good. spark and Flink!"),
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and "explode" not in plan


def test_names_are_scored_with_their_phrases_and_set_apart(spark):
    scoring, _ = phrase_scoring(spark)
    df = spark.createDataFrame([("1", "goodFlink was there. We all think Flink is the bomb."), ("2", "none")], "post_id string, full_text string")
    found = S.tech_sentiments(df, [("flink", "flink")], scoring)
    assert rows(found, "post_id", "context") == [("1", "goodFlink was there. We all think Flink is the bomb.")]
    alone = S.tech_sentiments(df, [("flink", "flink")], scoring, [])
    total = [3.0 + 1.9, 3.0]
    assert [r.first()["score"] for r in (found, alone)] == [pytest.approx(0.7 * x / (x * x + 15) ** 0.5, abs=1e-4) for x in total]


def test_names_of_a_text_have_their_mean(spark):
    data = [
        ("1", "Spark is good. Flink is bad. Hive"), ("1", "Spark is bad"), (None, "Flink is good"), (None, "Flink is bad"), ("2", "none"), ("3", None),
        ("1", "Spark is bad"),
    ]
    df = spark.createDataFrame(data, "post_id string, full_text string")
    terms = [(t, t) for t in ("spark", "flink", "hive")]
    found = S.tech_sentiments_with_mean(df, terms, scoring(spark))
    good, bad = (0.7 * (v / (v * v + 15) ** 0.5) + 0.3 * p for v, p in ((1.9, 0.7), (-2.5, -0.7)))
    near = lambda x: None if x is None else pytest.approx(x, abs=1e-4)
    mean = (good + bad) / 3
    expected = [
        ("1", "flink", "Flink is bad.", bad, mean), ("1", "hive", "Hive", 0.0, mean), ("1", "spark", "Spark is bad", bad, bad),
        ("1", "spark", "Spark is bad", bad, bad), ("1", "spark", "Spark is good.", good, mean), ("2", None, None, None, 0.0), ("3", None, None, None, 0.0),
        (None, "flink", "Flink is bad", bad, bad), (None, "flink", "Flink is good", good, good),
    ]
    assert rows(found) == [(*r[:3], near(r[3]), near(r[4])) for r in expected]
    assert rows(found.where("tech_name is not null").drop("avg_tech_sentiment")) == rows(S.tech_sentiments(df, terms, scoring(spark)))
    kept = S.tech_sentiments_with_mean(df, terms, scoring(spark), kept=F.length)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "length(" in plan.split("Window", 1)[1] and kept.where("context is null").count() == 2


def test_null_names_of_mentions_are_scored_on_the_whole_text(spark):
    posts = spark.createDataFrame([("1", "t", "Good. Bad", None), ("2", "t", None, None)], "post_id string, title string, text string, created_date timestamp")
    analysis = spark.createDataFrame([("1", ["bad", None]), ("2", ["x"]), ("1", [])], "post_id string, tech_mentioned array<string>")
    found = S.mention_sentiments(posts, analysis, scoring(spark))
    assert rows(found, "post_id", "tech_name", "context") == [("1", "bad", "Bad"), ("1", None, "t Good. Bad"), ("2", "x", "")]


def test_fuzzy_texts_become_strings_in_parts(spark, monkeypatch):
    seen = []
    plain = fuzzy.best_in_dictionaries
    monkeypatch.setattr(fuzzy, "best_in_dictionaries", lambda texts, *rest: seen.append(len(texts)) or plain(texts, *rest))
    monkeypatch.setattr(fuzzy, "CHUNK", 40)
    made = {}
    monkeypatch.setattr(fuzzy.F, "arrow_udf", lambda kind: lambda f: made.setdefault("f", f) and F.udf(f, kind))
    fuzzy.fuzzy_dictionaries(F.col("text"), {"tech": [("spark", "Spark")], "skills": [("python", "Python")]})
    texts = ["spark and pyton", None, "", "x" * 100, "sparks", "flink"] * 3
    found = made["f"](pa.array(texts, pa.string())).to_pylist()
    assert [(r["tech"], r["skills"]) for r in found] == [(["Spark"], ["Python"]), ([], []), ([], []), ([], []), (["Spark"], []), ([], [])] * 3
    assert len(seen) > 3 and sum(seen) == len(texts)


def test_letters_beyond_ascii_have_the_same_case_as_in_spark(spark):
    words = ["ΑΣ", "ΑΣ.", "ΣΑ.Β", "İZMIR", "STRAẞE", "straße", "Aƛ", "AꟜ", "ɤ", "ŉA", "ǰ", "ﬁne", "ÉTÉ", "Aᾳ", "good", "BAD"]
    texts = [" ".join([w, "good", "BAD"]) for w in words] + [" ".join(words)]
    cells = [(w, 1.0 + i) for i, w in enumerate(r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.lower("w")).collect())]
    table = L.scoring_table(spark.createDataFrame(cells, "term string, valence double"))
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    small = rows(L.score_text(df, "id", "text", table))
    assert small == rows(L.score_text(df, "id", "text", table, max_rows=0))


def test_texts_cross_to_python_once(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    plan = L.score_text(df, "id", "text", scoring(spark), ["spark"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "lower(" not in plan and "upper(" not in plan


def test_extremes_read_the_scores_once(spark):
    scored = spark.createDataFrame([("a", f"p{i}", s) for i, s in enumerate([0.9, 0.9, 0.2, 0.1, 0.05, -0.05, -0.3, -0.3, -0.8])] + [(None, "q", 0.5)], "tech_name string, post_id string, score double")
    found = S.tech_sentiment_extremes(scored, 2)
    assert rows(found, "tech_name", "kind", "place", "post_id") == [
        ("a", "negative", 1, "p8"), ("a", "negative", 2, "p6"), ("a", "positive", 1, "p0"), ("a", "positive", 2, "p1"), (None, "positive", 1, "q"),
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_the_summary_of_trends_is_found_once(spark):
    seen = spark.sparkContext.accumulator(0)
    mark = F.udf(lambda x: seen.add(1) or x, "double").asNondeterministic()
    summary = spark.createDataFrame([("a", 0.5), ("b", -0.5)], "tech_name string, avg_sentiment double").withColumn("avg_sentiment", mark("avg_sentiment"))
    summary = summary.where("avg_sentiment is not null")
    trends = spark.createDataFrame([("a", 1, None), ("c", 2, 0.25)], "tech_name string, week int, sentiment_avg double")
    assert rows(S.refresh_trend_sentiment(trends, summary)) == [("a", 1, 0.5), ("c", 2, 0.25)]
    assert seen.value == 2
