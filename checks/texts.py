"""Text features, lexicon sentiment and the incremental jobs over documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import adapters as A
from checks.sql import (
    BANDS, COMMENT_RECORDS, SKILL_PAIRS, TERM_PAIRS, TEXT_MENTIONS, TEXT_RECORDS, TRADE, WORDS, clean, grams, markup_free,
    mentions_of, r6, scored, sentences, text_mentions, tokens, top_counted, values, dictionary_pairs, fuzzy as fuzzy_steps,
)
from threadloom.functions import fuzzy, lexicon as L, text as X
from threadloom.operators import features as F1, sentiment as S
from threadloom.operators.merge import merge_columns
from threadloom.sizing import cut_lineage
from threadloom.sources import dictionaries as D


def pages_and_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = A.load(spark, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("post_id"), "text")
    pages = A.load(spark, sf, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("post_id"), F.col("html").alias("text"))
    return docs.unionByName(pages)


BOTH = """both_texts AS (SELECT 'd' || doc_id AS post_id, text FROM documents
  UNION ALL SELECT 'p' || page_id, html FROM pages)"""
TOKENS = f"{BOTH}, tokens AS (SELECT post_id, {tokens('text')} AS t FROM both_texts)"


def full_text(spark, sf):
    posts = A.text_records(spark, sf)
    body = F.when(F.col("lang") == "de", "").when(F.col("lang") == "fr", None).otherwise(F.col("text"))
    full = X.full_text(F.col("title"), body)
    return posts.select("id", F.length(full).cast("bigint").alias("n_chars"), A.digest(full).alias("full_md5"))


FULL_TEXT = f"""WITH {TEXT_RECORDS}, f AS (
  SELECT id, CASE WHEN lang IN ('de', 'fr') THEN title ELSE title || ' ' || text END AS x FROM text_records)
SELECT id, length(x) AS n_chars, md5(x) AS full_md5 FROM f"""


def clean_tokens_text(spark, sf):
    rows = pages_and_documents(spark, sf)
    return rows.select("post_id", A.digest(X.strip_markup(F.col("text"))).alias("clean_md5"))


CLEAN_TOKENS = f"WITH {BOTH} SELECT post_id, md5({markup_free('text')}) AS clean_md5 FROM both_texts"


def _tokens(spark, sf, lemmas: bool = False) -> DataFrame:
    table = spark.createDataFrame(list(A.LEMMAS.items()), "form string, lemma string") if lemmas else None
    return F1.with_tokens(pages_and_documents(spark, sf), "post_id", "text", table)


def _token_list(rows: DataFrame) -> DataFrame:
    return rows.select("post_id", F.size("tokens").cast("bigint").alias("n"), A.digest(A.joined("tokens")).alias("tokens_md5"))


def tokenise(spark, sf):
    return _token_list(_tokens(spark, sf))


TOKENISE = f"WITH {TOKENS} SELECT post_id, len(t) AS n, md5(array_to_string(t, '|')) AS tokens_md5 FROM tokens"


def lemmatise(spark, sf):
    return _token_list(_tokens(spark, sf, lemmas=True))


_LEMMA = "list_transform(t, lambda w: CASE w " + " ".join(f"WHEN '{f}' THEN '{to}'" for f, to in A.LEMMAS.items()) + " ELSE w END)"
LEMMATISE = f"""WITH {TOKENS}, l AS (SELECT post_id, {_LEMMA} AS t FROM tokens)
SELECT post_id, len(t) AS n, md5(array_to_string(t, '|')) AS tokens_md5 FROM l"""


def word_counts(spark, sf):
    rows = _tokens(spark, sf)
    return rows.select(
        "post_id", F.size("tokens").alias("word_count"), F.size(F.array_distinct("tokens")).alias("unique_words")
    )


WORD_COUNTS = f"""WITH {TOKENS} SELECT post_id, CAST(len(t) AS INTEGER) AS word_count,
  CAST(len(list_distinct(t)) AS INTEGER) AS unique_words FROM tokens"""


def ngrams(spark, sf):
    rows, t = _tokens(spark, sf), F.col("tokens")
    return rows.select(
        "post_id", A.digest(A.joined(X.ngrams(t, 2))).alias("two_md5"), A.digest(A.joined(X.ngrams(t, 3))).alias("three_md5")
    )


NGRAMS = f"""WITH {TOKENS} SELECT post_id, md5(array_to_string({grams('t', 2)}, '|')) AS two_md5,
  md5(array_to_string({grams('t', 3)}, '|')) AS three_md5 FROM tokens"""


def doc_topics(spark, sf):
    return F1.doc_topics(_tokens(spark, sf)).select("post_id", A.joined("topics").alias("topics"))


DOC_TOPICS = f"""WITH {TOKENS}, g AS (SELECT post_id, {grams('t', 2)} || {grams('t', 3)} AS items FROM tokens)
SELECT g.post_id, coalesce(top, '') AS topics FROM g LEFT JOIN ({top_counted('g', 'post_id', 'items')}) USING (post_id)"""


def doc_top_terms(spark, sf):
    rows = F1.doc_top_terms(_tokens(spark, sf))
    return rows.select("post_id", A.joined("top_terms").alias("top_terms"))


TOP_TERMS = f"""WITH {TOKENS}, g AS (SELECT post_id, t || {grams('t', 2)} || {grams('t', 3)} AS items FROM tokens)
SELECT g.post_id, coalesce(top, '') AS top_terms FROM g LEFT JOIN ({top_counted('g', 'post_id', 'items')}) USING (post_id)"""


def is_question(spark, sf):
    return A.page_posts(spark, sf).select("post_id", X.is_question(F.col("title")).alias("is_question"))


IS_QUESTION = "SELECT CAST(page_id AS VARCHAR) AS post_id, contains(url, '?') AS is_question FROM pages"



def fuzzy_tech_mentions(spark, sf):
    pairs = D.term_pairs(D.load_term_dictionary(spark, None, D.TECHNOLOGIES)) + TERM_PAIRS
    rows = pages_and_documents(spark, sf)
    found = rows.select("post_id", fuzzy.fuzzy_mentions(F.col("text"), pairs).alias("names"))
    return found.select("post_id", A.joined("names").alias("names"))


def fuzzy_skill_mentions(spark, sf):
    pairs = D.term_pairs(D.load_term_dictionary(spark, None, D.SKILLS)) + SKILL_PAIRS
    rows = pages_and_documents(spark, sf)
    found = rows.select("post_id", fuzzy.fuzzy_mentions(F.col("text"), pairs).alias("names"))
    return found.select("post_id", A.joined("names").alias("names"))


def _fuzzy_sql(pairs: list[tuple[str, str]]) -> str:
    return f"""WITH {BOTH}, lows AS (SELECT post_id, lower(text) AS low FROM both_texts), {fuzzy_steps('f_', 'lows', pairs)}
SELECT post_id, coalesce(names, '') AS names FROM both_texts LEFT JOIN f_names USING (post_id)"""


FUZZY_TECH = _fuzzy_sql(dictionary_pairs(D.TECHNOLOGIES) + TERM_PAIRS)
FUZZY_SKILLS = _fuzzy_sql(dictionary_pairs(D.SKILLS) + SKILL_PAIRS)


def exact_mentions(spark, sf):
    pairs = D.term_pairs(D.load_term_dictionary(spark, None, A.TEXT_TERMS, lower=True))
    rows = pages_and_documents(spark, sf)
    return rows.select("post_id", A.joined(X.exact_mentions(F.col("text"), pairs)).alias("names"))


EXACT = f"""WITH {BOTH} SELECT post_id, array_to_string({mentions_of('lower(text)', TERM_PAIRS)}, '|') AS names FROM both_texts"""


def _benchmark_words(spark, sf) -> list[tuple[str, str]]:
    """Every word of four letters or more of the benchmark, as a dictionary too large for the plan."""
    words = A.load(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{4,})"), 1)).alias("w"))
    return [(r.w, r.w) for r in words.distinct().orderBy("w").toLocalIterator()]


def exact_mentions_dictionary(spark, sf):
    names = X.exact_mentions(F.col("text"), _benchmark_words(spark, sf), plan_terms=0)
    found = pages_and_documents(spark, sf).select("post_id", names.alias("names"))
    return found.select("post_id", F.size("names").alias("n_names"), A.digest(A.joined("names")).alias("names_md5"))


EXACT_DICTIONARY = f"""WITH {BOTH}, words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{{4,}}')) AS w FROM benchmark),
found AS (SELECT post_id, w FROM both_texts JOIN words ON contains(lower(text), w))
SELECT post_id, CAST(count(w) AS INTEGER) AS n_names, md5(coalesce(string_agg(w, '|' ORDER BY w), '')) AS names_md5
FROM both_texts LEFT JOIN found USING (post_id) GROUP BY post_id"""


def clean_sentiment_automaton(spark, sf):
    rows = pages_and_documents(spark, sf)
    return rows.select("post_id", A.digest(X.clean_for_sentiment(F.col("text"), WORDS, plan_terms=0)).alias("clean_md5"))


def clean_sentiment_text(spark, sf):
    rows = pages_and_documents(spark, sf)
    return rows.select("post_id", A.digest(X.clean_for_sentiment(F.col("text"), WORDS)).alias("clean_md5"))


CLEAN_SENTIMENT = f"WITH {BOTH} SELECT post_id, md5({clean('text', WORDS)}) AS clean_md5 FROM both_texts"


def scoring(spark: SparkSession, valences: dict[str, float] | None = None, whole: bool = False) -> DataFrame:
    """The word lists; `whole` with phrases and intensities."""
    words = spark.createDataFrame(list((valences or A.TEXT_VALENCES).items()), "term string, valence double")
    modifiers = spark.createDataFrame(
        [(t, b, None) for t, b in A.TEXT_BOOSTERS.items()] + [(t, None, True) for t in A.TEXT_NEGATIONS],
        "term string, booster double, negation boolean",
    )
    if whole:
        rows = [(t, b, None) for t, b in A.TEXT_PHRASE_BOOSTERS.items()] + [(t, None, score) for t, score in A.TEXT_IDIOMS.items()]
        phrases = spark.createDataFrame(rows, "term string, booster double, idiom double")
        modifiers = modifiers.unionByName(phrases, allowMissingColumns=True)
    polarity = spark.createDataFrame(
        [(t, p, s, A.TEXT_INTENSITIES.get(t) if whole else None) for t, (p, s) in A.TEXT_POLARITIES.items()],
        "term string, polarity double, subjectivity double, intensity double",
    )
    return L.scoring_table(words, polarity, modifiers)


def _scored(spark, sf) -> DataFrame:
    return L.score_text(pages_and_documents(spark, sf), "post_id", "text", scoring(spark), WORDS)


_SCORED = f"WITH {BOTH}, src AS (SELECT post_id AS key, text AS txt FROM both_texts), {scored('src')}"


def valence_compound(spark, sf):
    return _scored(spark, sf).select("post_id", *[A.rounded(c).alias(c) for c in ("compound", "pos", "neg", "neu")])


VALENCE = f"""{_SCORED} SELECT key AS post_id, {r6('compound')} AS compound, {r6('pos')} AS pos, {r6('neg')} AS neg,
  {r6('neu')} AS neu FROM scored"""


def polarity_subjectivity(spark, sf):
    return _scored(spark, sf).select("post_id", *[A.rounded(c).alias(c) for c in ("polarity", "subjectivity")])


POLARITY = f"{_SCORED} SELECT key AS post_id, {r6('polarity')} AS polarity, {r6('subjectivity')} AS subjectivity FROM scored"


def ensemble_score(spark, sf):
    return _scored(spark, sf).select("post_id", A.rounded("ensemble_score").alias("ensemble_score"))


ENSEMBLE = f"{_SCORED} SELECT key AS post_id, {r6('ensemble')} AS ensemble_score FROM scored"


def polarity_class(spark, sf):
    return _scored(spark, sf).groupBy(X.polarity_class(F.col("ensemble_score")).alias("class")).agg(
        F.count("*").alias("posts")
    )


CLASS = f"""{_SCORED} SELECT CASE WHEN ensemble > 0.05 THEN 'positive' WHEN ensemble < -0.05 THEN 'negative' ELSE 'neutral' END
  AS class, count(*) AS posts FROM scored GROUP BY 1"""


def update_valence(spark, sf):
    own = spark.createDataFrame(list(A.TEXT_VALENCES.items()), "term string, valence double")
    changes = spark.createDataFrame([("the", -2.0), ("von", 1.5)], "term string, valence double")
    modifiers = scoring(spark).drop("valence")
    table = L.scoring_table(
        D.update_valences(own, changes),
        modifiers.select("term", "polarity", "subjectivity"),
        modifiers.select("term", "booster", "negation"),
    )
    rescored = L.score_text(pages_and_documents(spark, sf), "post_id", "text", table, WORDS)
    return rescored.select("post_id", A.rounded("ensemble_score").alias("ensemble_score"))


UPDATE_VALENCE = f"""WITH {BOTH}, src AS (SELECT post_id AS key, text AS txt FROM both_texts),
{scored('src', {**A.TEXT_VALENCES, 'the': -2.0, 'von': 1.5})}
SELECT key AS post_id, {r6('ensemble')} AS ensemble_score FROM scored"""


def sentence_split(spark, sf):
    s = X.sentences(F.col("text"))
    return pages_and_documents(spark, sf).select(
        "post_id", F.size(s).cast("bigint").alias("n"), A.digest(F.array_join(s, "~")).alias("split_md5")
    )


SENTENCES = f"""WITH {BOTH}, s AS (SELECT post_id, {sentences('text')} AS x FROM both_texts)
SELECT post_id, len(x) AS n, md5(array_to_string(x, '~')) AS split_md5 FROM s"""


def contextual_sentiment(spark, sf):
    rows = pages_and_documents(spark, sf)
    name = F.when(F.col("post_id").startswith("p"), F.lit(None)).otherwise("The")
    found = S.contextual_sentiment(rows.withColumn("tech_name", name), scoring(spark), WORDS, "text")
    return found.select("post_id", A.digest("context").alias("context_md5"), A.rounded("score").alias("score"))


CONTEXTUAL = f"""WITH {BOTH}, src AS (SELECT post_id AS key, CASE WHEN post_id LIKE 'p%' THEN text ELSE
  array_to_string(list_filter({sentences('text')}, lambda s: contains(lower(s), 'the')), ' ') END AS txt FROM both_texts),
{scored('src')}
SELECT key AS post_id, md5(txt) AS context_md5, {r6('ensemble')} AS score FROM src JOIN scored USING (key)"""


def _pairs_lower(spark) -> list[tuple[str, str]]:
    return D.term_pairs(D.load_term_dictionary(spark, None, A.TEXT_TERMS, lower=True))


def _full_posts(spark, sf) -> DataFrame:
    posts = A.text_posts(spark, sf)
    return posts.withColumn("full_text", X.full_text(F.col("title"), F.col("text")))


def tech_sentiment_per_doc(spark, sf):
    pairs = _pairs_lower(spark)
    found = S.tech_sentiments_with_mean(_full_posts(spark, sf), pairs, scoring(spark, whole=True), WORDS, kept=A.digest)
    return found.select(
        "post_id", "tech_name", F.col("context").alias("context_md5"), *[A.rounded(c).alias(c) for c in ("score", "avg_tech_sentiment")]
    )


PER_DOC = f"""WITH {text_mentions(whole=True)}, m AS (SELECT post_id, avg(score) AS a FROM tech_scores GROUP BY 1)
SELECT p.post_id, t.tech_name, md5(t.context) AS context_md5, {r6('t.score')} AS score, {r6('coalesce(a, 0.0)')} AS avg_tech_sentiment
FROM full_posts p LEFT JOIN tech_scores t ON t.post_id = p.post_id LEFT JOIN m ON m.post_id = p.post_id"""


def mean_tech_sentiment(spark, sf):
    rows = _full_posts(spark, sf)
    found = S.tech_sentiments(rows, _pairs_lower(spark), scoring(spark), WORDS)
    return S.mean_tech_sentiment(rows, found).select("post_id", A.rounded("avg_tech_sentiment").alias("avg_tech_sentiment"))


MEAN_TECH = f"""WITH {TEXT_MENTIONS}, m AS (SELECT post_id, avg(score) AS a FROM tech_scores GROUP BY 1)
SELECT p.post_id, {r6('coalesce(a, 0.0)')} AS avg_tech_sentiment FROM full_posts p LEFT JOIN m ON m.post_id = p.post_id"""


def sentiment_bucket(spark, sf):
    rows = A.trade_analysis(spark, sf)
    score = F.col("sentiment_score")
    return rows.groupBy(X.sentiment_band(score).alias("band"), X.sentiment_band_order(score).alias("band_order")).agg(
        F.count("*").alias("posts")
    )


BUCKET = f"""WITH {TRADE}, b AS (SELECT CASE WHEN sentiment_score < -0.5 THEN 1 WHEN sentiment_score < -0.1 THEN 2
  WHEN sentiment_score < 0.1 THEN 3 WHEN sentiment_score < 0.5 THEN 4 WHEN sentiment_score >= 0.5 THEN 5 END AS o FROM analysis)
SELECT {BANDS}[o] AS band, CAST(o AS INTEGER) AS band_order,
  count(*) AS posts FROM b GROUP BY o"""


def text_preview(spark, sf):
    rows = pages_and_documents(spark, sf)
    return rows.select(
        "post_id", X.preview(F.col("text"), 200).alias("long_preview"), X.preview(F.col("text"), 150).alias("short_preview")
    )


PREVIEW = f"""WITH {BOTH} SELECT post_id, CASE WHEN length(text) > 200 THEN substring(text, 1, 200) || '...' ELSE text END AS long_preview,
  CASE WHEN length(text) > 150 THEN substring(text, 1, 150) || '...' ELSE text END AS short_preview FROM both_texts"""


def permalink_url(spark, sf):
    return A.text_records(spark, sf).select("id", X.permalink_url(F.col("permalink")).alias("link"))


PERMALINK = f"""WITH {TEXT_RECORDS} SELECT id, CASE WHEN permalink <> '' THEN 'https://www.reddit.com' || permalink END AS link FROM text_records"""


def period_label(spark, sf):
    days = A.load(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return days.select("day", *[X.period_label(u, F.col("day")).alias(f"{u}_label") for u in ("day", "week", "month")])


LABEL = """SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%d/%m') AS day_label,
  strftime(o_orderdate, '%U/%Y') AS week_label, strftime(o_orderdate, '%m/%Y') AS month_label FROM orders"""


def _done(spark, sf) -> DataFrame:
    """Stored analysis: labelled documents have a word count, and a score only when rated good."""
    labels = A.load(spark, sf, "labels")
    return labels.select(
        F.col("doc_id").cast("string").alias("post_id"),
        F.lit(7).alias("word_count"),
        F.when(F.col("quality") == 1, 0.5).alias("sentiment_score"),
    )


def pending_keyword_posts(spark, sf):
    posts = A.text_posts(spark, sf)
    pending = F1.pending_keyword_posts(posts, _done(spark, sf)).select("post_id", F.lit("all").alias("part"))
    return pending.unionByName(
        F1.pending_keyword_posts(posts, _done(spark, sf), limit=25).select("post_id", F.lit("first").alias("part"))
    )


_NOT_LABELLED = "doc_id NOT IN (SELECT doc_id FROM labels)"
PENDING_KEYWORD = f"""SELECT CAST(doc_id AS VARCHAR) AS post_id, 'all' AS part FROM documents WHERE {_NOT_LABELLED}
UNION ALL (SELECT CAST(doc_id AS VARCHAR), 'first' FROM documents WHERE {_NOT_LABELLED} ORDER BY 1 LIMIT 25)"""


def pending_sentiment_posts(spark, sf):
    return F1.pending_sentiment_posts(A.text_posts(spark, sf), _done(spark, sf)).select("post_id")


PENDING_POSTS = """SELECT CAST(doc_id AS VARCHAR) AS post_id FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)"""


def pending_sentiment_comments(spark, sf):
    comments = A.text_comments(spark, sf)
    turns = A.load(spark, sf, "conversations")
    done = turns.select(
        F.concat_ws("_", "conv_id", "turn").alias("comment_id"), F.when(F.col("role") == "user", 0.1).alias("sentiment_score")
    )
    return F1.pending_sentiment_comments(comments, done).select("comment_id")


PENDING_COMMENTS = "SELECT conv_id || '_' || turn AS comment_id FROM conversations WHERE role <> 'user'"


def keyword_features(spark, sf):
    posts = A.text_posts(spark, sf)
    waiting = F1.pending_keyword_posts(posts, _done(spark, sf))
    fresh = F1.keyword_features(waiting, TERM_PAIRS, SKILL_PAIRS).drop("tech_mentioned", "skills_mentioned")
    stored = _done(spark, sf).withColumns(
        {
            "unique_words": F.lit(3),
            "is_question": F.lit(True),
            "topics": F.array(F.lit("old topic")),
            "processed_date": F.lit("2024-01-01").cast("timestamp"),
        }
    )
    merged = F1.save_analysis(stored, fresh, "post_id", F.lit("2024-03-01").cast("timestamp"))
    return merged.select(
        "post_id", "word_count", "unique_words", "is_question", A.joined("topics").alias("topics"),
        "sentiment_score", A.stamp("processed_date").alias("processed_date"),
    )


KEYWORD_FEATURES = f"""WITH {TEXT_RECORDS},
waiting AS (SELECT id AS post_id, title, {tokens("title || ' ' || text")} AS t FROM text_records WHERE {_NOT_LABELLED}),
g AS (SELECT post_id, {grams('t', 2)} || {grams('t', 3)} AS items FROM waiting),
topics AS ({top_counted('g', 'post_id', 'items')})
SELECT w.post_id, CAST(len(t) AS INTEGER) AS word_count, CAST(len(list_distinct(t)) AS INTEGER) AS unique_words,
  contains(title, '?') AS is_question, top AS topics, CAST(NULL AS DOUBLE) AS sentiment_score, '2024-03-01 00:00:00' AS processed_date
FROM waiting w LEFT JOIN topics USING (post_id)
UNION ALL SELECT CAST(doc_id AS VARCHAR), 7, 3, true, 'old topic', CASE WHEN quality = 1 THEN CAST(0.5 AS DOUBLE) END,
  '2024-01-01 00:00:00' FROM labels"""


def keyword_features_fuzzy(spark, sf):
    """All seven columns with the shipped dictionaries."""
    tech = D.term_pairs(D.load_term_dictionary(spark, None, D.TECHNOLOGIES))
    skills = D.term_pairs(D.load_term_dictionary(spark, None, D.SKILLS))
    rows = F1.keyword_features(A.text_posts(spark, sf), tech, skills)
    return rows.select(
        "post_id", "word_count", "unique_words", A.joined("tech_mentioned").alias("tech"),
        A.joined("skills_mentioned").alias("skills"), "is_question", A.joined("topics").alias("topics"),
    )


KEYWORD_FUZZY = f"""WITH {TEXT_RECORDS},
waiting AS MATERIALIZED (SELECT id AS post_id, title, {tokens("title || ' ' || text")} AS t FROM text_records),
g AS (SELECT post_id, {grams('t', 2)} || {grams('t', 3)} AS items FROM waiting),
topics AS ({top_counted('g', 'post_id', 'items')}),
lows AS (SELECT id AS post_id, lower(title || ' ' || text) AS low FROM text_records),
{fuzzy_steps('t_', 'lows', dictionary_pairs(D.TECHNOLOGIES))}, {fuzzy_steps('s_', 'lows', dictionary_pairs(D.SKILLS))}
SELECT w.post_id, CAST(len(t) AS INTEGER) AS word_count, CAST(len(list_distinct(t)) AS INTEGER) AS unique_words, x.names AS tech, y.names AS skills,
  contains(title, '?') AS is_question, top AS topics
FROM waiting w LEFT JOIN topics USING (post_id) LEFT JOIN t_names x ON x.post_id = w.post_id LEFT JOIN s_names y ON y.post_id = w.post_id"""


def post_sentiment(spark, sf):
    waiting = F1.pending_sentiment_posts(A.text_posts(spark, sf), _done(spark, sf))
    fresh = F1.post_sentiment(waiting, scoring(spark), WORDS)
    merged = merge_columns(_done(spark, sf), fresh, ["post_id"], ["sentiment_score"])
    return merged.select("post_id", "word_count", A.rounded("sentiment_score").alias("sentiment_score"))


POST_SENTIMENT = f"""WITH {TEXT_RECORDS},
src AS (SELECT id AS key, title || ' ' || text AS txt FROM text_records
  WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)),
{scored('src')}
SELECT r.id AS post_id, CASE WHEN l.doc_id IS NOT NULL THEN 7 END AS word_count,
  CASE WHEN l.quality = 1 THEN {r6('CAST(0.5 AS DOUBLE)')} ELSE {r6('ensemble')} END AS sentiment_score
FROM text_records r LEFT JOIN labels l USING (doc_id) LEFT JOIN scored s ON s.key = r.id"""


def comment_sentiment(spark, sf):
    rows = F1.comment_sentiment(A.text_comments(spark, sf), scoring(spark), WORDS)
    return rows.select("comment_id", A.rounded("sentiment_score").alias("sentiment_score"))


COMMENT_SENTIMENT = f"""WITH {COMMENT_RECORDS}, src AS (SELECT id AS key, body AS txt FROM comment_records),
{scored('src')} SELECT key AS comment_id, {r6('ensemble')} AS sentiment_score FROM scored"""


def _mention_sentiments(spark, sf) -> DataFrame:
    posts = A.text_posts(spark, sf)
    full = X.full_text(F.col("title"), F.col("text"))
    # The analysis is a stored table; as a plan, each filter on its names would look for them again.
    analysis = cut_lineage(posts.select("post_id", X.exact_mentions(full, TERM_PAIRS).alias("tech_mentioned")), "analysis")
    return S.mention_sentiments(posts, analysis, scoring(spark), WORDS)


_SUMMARY = """summary AS (SELECT tech_name, count(*) AS post_count, avg(score) AS avg_sentiment,
  count(*) FILTER (score > 0.05) AS positive_count, count(*) FILTER (score < -0.05) AS negative_count,
  count(*) FILTER (score BETWEEN -0.05 AND 0.05) AS neutral_count FROM tech_scores GROUP BY 1)"""


def tech_sentiment_summary(spark, sf):
    rows = S.tech_sentiment_summary(_mention_sentiments(spark, sf))
    exact = ["tech_name", "post_count", "positive_count", "negative_count", "neutral_count"]
    return rows.select(
        *exact, *[A.rounded(c).alias(c) for c in ("avg_sentiment", "positive_share", "negative_share", "neutral_share")]
    )


SUMMARY = f"""WITH {TEXT_MENTIONS}, {_SUMMARY}
SELECT tech_name, post_count, positive_count, negative_count, neutral_count, {r6('avg_sentiment')} AS avg_sentiment,
  {r6('positive_count / post_count')} AS positive_share, {r6('negative_count / post_count')} AS negative_share,
  {r6('neutral_count / post_count')} AS neutral_share FROM summary"""


def tech_sentiment_thirds(spark, sf):
    scored_rows = cut_lineage(_mention_sentiments(spark, sf).drop("context"), "mention-sentiments")
    rows = S.tech_sentiment_thirds(scored_rows)
    return rows.select("tech_name", *[A.rounded(c).alias(c) for c in ("early", "mid", "recent")])


THIRDS = f"""WITH {TEXT_MENTIONS}, p AS (SELECT tech_name, score, count(*) OVER (PARTITION BY tech_name) AS n,
  row_number() OVER (PARTITION BY tech_name ORDER BY created_date, md5(post_id), post_id) AS rn FROM tech_scores)
SELECT tech_name, {r6('avg(score) FILTER (rn <= n // 3)')} AS early,
  {r6('avg(score) FILTER (rn > n // 3 AND rn <= 2 * (n // 3))')} AS mid,
  {r6('avg(score) FILTER (rn > 2 * (n // 3))')} AS recent FROM p WHERE n >= 3 GROUP BY 1"""


def tech_sentiment_extremes(spark, sf):
    rows = S.tech_sentiment_extremes(_mention_sentiments(spark, sf))
    return rows.select("tech_name", "kind", "place", "post_id", A.rounded("score").alias("score"))


EXTREMES = f"""WITH {TEXT_MENTIONS}
SELECT * FROM (SELECT tech_name, 'positive' AS kind, CAST(row_number() OVER (PARTITION BY tech_name ORDER BY score DESC, post_id) AS INTEGER) AS place,
  post_id, {r6('score')} AS score FROM tech_scores WHERE score > 0.05) WHERE place <= 3
UNION ALL
SELECT * FROM (SELECT tech_name, 'negative' AS kind, CAST(row_number() OVER (PARTITION BY tech_name ORDER BY score, post_id) AS INTEGER) AS place,
  post_id, {r6('score')} AS score FROM tech_scores WHERE score < -0.05) WHERE place <= 3"""


def refresh_trend_sentiment(spark, sf):
    # Read twice, for the weeks and for the summary.
    scored_rows = cut_lineage(_mention_sentiments(spark, sf).drop("context"), "mention-sentiments")
    week = X.period_start("week", F.col("created_date"))
    weekly = scored_rows.groupBy("tech_name", week.alias("week_start")).agg(
        F.count("*").alias("mention_count"), F.lit(None).cast("double").alias("sentiment_avg")
    )
    kept = S.tech_sentiment_summary(scored_rows).where("tech_name != 'und'")
    rows = S.refresh_trend_sentiment(weekly, kept)
    return rows.select("tech_name", "week_start", "mention_count", A.rounded("sentiment_avg").alias("sentiment_avg"))


REFRESH = f"""WITH {TEXT_MENTIONS}, {_SUMMARY}
SELECT t.tech_name, CAST(date_trunc('week', created_date) AS DATE) AS week_start, count(*) AS mention_count,
  {r6("CASE WHEN t.tech_name <> 'und' THEN any_value(s.avg_sentiment) END")} AS sentiment_avg
FROM tech_scores t JOIN summary s USING (tech_name) GROUP BY 1, 2"""

COMPARED = ["with", "the", "und", "les"]


def compare_tech_sentiment(spark, sf):
    summary = S.tech_sentiment_summary(_mention_sentiments(spark, sf))
    rows = S.compare_tech_sentiment(summary, COMPARED)
    return rows.select("tech_name_1", "tech_name_2", A.rounded("difference").alias("difference"))


_NAMED = values(list(enumerate(COMPARED)), "position, tech_name")
COMPARE = f"""WITH {TEXT_MENTIONS}, {_SUMMARY}, compared AS (SELECT * FROM summary JOIN {_NAMED} n USING (tech_name))
SELECT a.tech_name AS tech_name_1, b.tech_name AS tech_name_2, {r6('a.avg_sentiment - b.avg_sentiment')} AS difference
FROM compared a JOIN compared b ON a.position < b.position"""


def sentiment_ranking(spark, sf):
    summary = S.tech_sentiment_summary(_mention_sentiments(spark, sf))
    return S.sentiment_ranking(summary, COMPARED).select("tech_name", "rank", "post_count")


RANKING = f"""WITH {TEXT_MENTIONS}, {_SUMMARY}
SELECT tech_name, CAST(rank() OVER (ORDER BY avg_sentiment DESC) AS INTEGER) AS rank, post_count
FROM summary JOIN {_NAMED} n USING (tech_name)"""

QUERIES = {
    "full_text": (full_text, FULL_TEXT),
    "clean_tokens_text": (clean_tokens_text, CLEAN_TOKENS),
    "tokenise": (tokenise, TOKENISE),
    "lemmatise": (lemmatise, LEMMATISE),
    "word_counts": (word_counts, WORD_COUNTS),
    "ngrams": (ngrams, NGRAMS),
    "doc_topics": (doc_topics, DOC_TOPICS),
    "doc_top_terms": (doc_top_terms, TOP_TERMS),
    "is_question": (is_question, IS_QUESTION),
    "fuzzy_tech_mentions": (fuzzy_tech_mentions, FUZZY_TECH),
    "fuzzy_skill_mentions": (fuzzy_skill_mentions, FUZZY_SKILLS),
    "exact_mentions": (exact_mentions, EXACT),
    "exact_mentions_dictionary": (exact_mentions_dictionary, EXACT_DICTIONARY),
    "clean_sentiment_automaton": (clean_sentiment_automaton, CLEAN_SENTIMENT),
    "clean_sentiment_text": (clean_sentiment_text, CLEAN_SENTIMENT),
    "valence_compound": (valence_compound, VALENCE),
    "polarity_subjectivity": (polarity_subjectivity, POLARITY),
    "ensemble_score": (ensemble_score, ENSEMBLE),
    "sentence_split": (sentence_split, SENTENCES),
    "contextual_sentiment": (contextual_sentiment, CONTEXTUAL),
    "tech_sentiment_per_doc": (tech_sentiment_per_doc, PER_DOC),
    "mean_tech_sentiment": (mean_tech_sentiment, MEAN_TECH),
    "polarity_class": (polarity_class, CLASS),
    "sentiment_bucket": (sentiment_bucket, BUCKET),
    "text_preview": (text_preview, PREVIEW),
    "permalink_url": (permalink_url, PERMALINK),
    "period_label": (period_label, LABEL),
    "update_valence": (update_valence, UPDATE_VALENCE),
    "pending_keyword_posts": (pending_keyword_posts, PENDING_KEYWORD),
    "pending_sentiment_posts": (pending_sentiment_posts, PENDING_POSTS),
    "pending_sentiment_comments": (pending_sentiment_comments, PENDING_COMMENTS),
    "keyword_features": (keyword_features, KEYWORD_FEATURES),
    "keyword_features_fuzzy": (keyword_features_fuzzy, KEYWORD_FUZZY),
    "post_sentiment": (post_sentiment, POST_SENTIMENT),
    "comment_sentiment": (comment_sentiment, COMMENT_SENTIMENT),
    "tech_sentiment_summary": (tech_sentiment_summary, SUMMARY),
    "tech_sentiment_thirds": (tech_sentiment_thirds, THIRDS),
    "tech_sentiment_extremes": (tech_sentiment_extremes, EXTREMES),
    "refresh_trend_sentiment": (refresh_trend_sentiment, REFRESH),
    "compare_tech_sentiment": (compare_tech_sentiment, COMPARE),
    "sentiment_ranking": (sentiment_ranking, RANKING),
}
