"""Text features of posts, the posts still waiting for them, and the analysis jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.functions.fuzzy import fuzzy_dictionaries
from threadloom.functions.lexicon import score_text
from threadloom.functions.lookup import lookup_tokens
from threadloom.functions.runs import top_runs
from threadloom.functions import text as X
from threadloom.operators.merge import merge_columns

FEATURES = ["word_count", "unique_words", "tech_mentioned", "skills_mentioned", "is_question", "topics"]


def with_tokens(
    rows: DataFrame, key: str, text: str, lemmas: DataFrame | None = None, stop_words: list[str] | None = None
) -> DataFrame:
    """Add `tokens`: cleaned, without stop words, each replaced by its lemma where the table has one."""
    out = rows.withColumn("tokens", X.tokenise(X.strip_markup(F.col(text)), stop_words))
    return out if lemmas is None else lemmatise(out, key, lemmas)


def lemmatise(rows: DataFrame, key: str, lemmas: DataFrame) -> DataFrame:
    found = lookup_tokens(rows, key, "tokens", lemmas, "form", "_lemmas")
    replaced = F.zip_with("tokens", "_lemmas", lambda token, hit: F.coalesce(hit["lemma"], token))
    return found.withColumn("tokens", replaced).drop("_lemmas")


def doc_topics(rows: DataFrame, k: int = 10) -> DataFrame:
    """Add `topics`: the k most frequent runs of two or three tokens; ties to the earlier, pairs before triples."""
    return rows.withColumn("topics", top_runs(F.col("tokens"), (2, 3), k))


def doc_top_terms(rows: DataFrame, k: int = 10) -> DataFrame:
    return rows.withColumn("top_terms", top_runs(F.col("tokens"), (1, 2, 3), k))


def pending_keyword_posts(posts: DataFrame, analysis: DataFrame, limit: int | None = None) -> DataFrame:
    """Posts without keyword features; a row that holds only a sentiment score still counts as waiting."""
    done = analysis.where(F.col("word_count").isNotNull()).select("post_id")
    waiting = posts.join(done, "post_id", "left_anti")
    return waiting if limit is None else waiting.orderBy("post_id").limit(limit)


def pending_sentiment_posts(posts: DataFrame, analysis: DataFrame, limit: int | None = None) -> DataFrame:
    done = analysis.where(F.col("sentiment_score").isNotNull()).select("post_id")
    waiting = posts.join(done, "post_id", "left_anti")
    return waiting if limit is None else waiting.orderBy("post_id").limit(limit)


def pending_sentiment_comments(comments: DataFrame, analysis: DataFrame, limit: int | None = None) -> DataFrame:
    done = analysis.where(F.col("sentiment_score").isNotNull()).select("comment_id")
    waiting = comments.join(done, "comment_id", "left_anti")
    return waiting if limit is None else waiting.orderBy("comment_id").limit(limit)


def keyword_features(
    posts: DataFrame,
    technologies: list[tuple[str, str]],
    skills: list[tuple[str, str]],
    lemmas: DataFrame | None = None,
    fuzzy_limit: int | None = 5,
) -> DataFrame:
    """post_id and FEATURES of each post; empty arrays become NULL. For one post, filter the posts."""
    full = posts.select("post_id", "title", X.full_text(F.col("title"), F.col("text")).alias("full_text"))
    rows = doc_topics(with_tokens(full, "post_id", "full_text", lemmas))
    named = fuzzy_dictionaries(F.col("full_text"), {"tech": technologies, "skills": skills}, limit=fuzzy_limit)
    return rows.withColumn("named", named).select(
        "post_id",
        F.size("tokens").alias("word_count"),
        F.size(F.array_distinct("tokens")).alias("unique_words"),
        X.null_if_empty(F.col("named.tech")).alias("tech_mentioned"),
        X.null_if_empty(F.col("named.skills")).alias("skills_mentioned"),
        X.is_question(F.col("title")).alias("is_question"),
        X.null_if_empty(F.col("topics")).alias("topics"),
    )


def post_sentiment(posts: DataFrame, scoring: DataFrame, single_words: list[str] | None = None) -> DataFrame:
    full = posts.select("post_id", X.full_text(F.col("title"), F.col("text")).alias("full_text"))
    scored = score_text(full, "post_id", "full_text", scoring, single_words)
    return scored.select("post_id", F.col("ensemble_score").alias("sentiment_score"))


def comment_sentiment(comments: DataFrame, scoring: DataFrame, single_words: list[str] | None = None) -> DataFrame:
    scored = score_text(comments.select("comment_id", "body"), "comment_id", "body", scoring, single_words)
    return scored.select("comment_id", F.col("ensemble_score").alias("sentiment_score"))


def save_analysis(stored: DataFrame, fresh: DataFrame, key: str, now: Column | None = None) -> DataFrame:
    """Write the columns of `fresh` over the stored analysis rows and stamp them as processed."""
    stamped = fresh.withColumn("processed_date", now if now is not None else F.current_timestamp())
    return merge_columns(stored, stamped, [key], [c for c in stamped.columns if c != key])
